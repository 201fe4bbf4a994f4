"""Reading lists: signals, diverse selection, categories and the whole guide."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import selection as sel
from corpuslens.plans import reading_guide as guide
from registry.core import query
from registry.q_search import bm25_sql
from registry.q_text import clean_sql, sentences_sql
from registry.views import AS_OF

CUES = {
    "METHODOLOGY": {"the ": 0.9, "und ": 0.8},
    "LIMITATION": {"que ": 0.95, "with ": 0.75},
    "CONTRIBUTION": {"les ": 0.85, "ing": 0.5},
    "EVALUATION": {"is ": 0.9, "mit ": 0.8},
}


def as_of():
    return F.lit(AS_OF).cast("date")


# Every document is a candidate of its source, its relevance taken from its length.
CANDIDATES = """, cand0 as (select source as query_id, texts.*, scores.pagerank_score,
    cast(1 + length(abstract) % 97 as double) as es_score from texts join scores using (paper_id)), cand as (from cand0)"""

SIGNALS = f""", dist as (select *, case when topic_cluster_id <> -1 then sqrt(
      pow(umap_x - avg(umap_x) over (partition by query_id, topic_cluster_id), 2)
      + pow(umap_y - avg(umap_y) over (partition by query_id, topic_cluster_id), 2)) end as distance from cand),
    ext as (select query_id, max(es_score) as top_es, max(pagerank_score) as top_pr, max(distance) as far,
      min(distance) as near from dist group by 1),
    signals as (select dist.*, es_score / top_es as relevance,
      (pagerank_score - 0.15e0) / case when top_pr > 0.15e0 then top_pr - 0.15e0 else 1 end as influence,
      case when submitted_date is null then 0 when submitted_date > date '{AS_OF}' then 1
        else exp(-(date '{AS_OF}' - submitted_date) / 365.0e0) end as recency,
      coalesce((far - distance) / case when far > near then far - near else 1 end, 0) as representativeness
      from dist join ext using (query_id))"""


def select_sql(n: int, w=(0.35, 0.25, 0.15, 0.15, 0.10)) -> str:
    total = sum(w)
    r, i, c, p, d = (repr(x / total) + "e0" for x in w)
    return f""", based as (select *, round(relevance * {r} + influence * {i} + recency * {c} + representativeness * {p}, 9)
      as base from signals),
    counted as (select *, row_number() over (partition by query_id, topic_cluster_id order by base desc, paper_id) as k
      from based),
    totals as (select *, case when topic_cluster_id <> -1 then 1.0e0 / k else 0 end as diversity from counted),
    composed as (select *, round(base + {d} * diversity, 9) as composite_score from totals),
    chosen as (select * from (select *, row_number() over (partition by query_id order by composite_score desc, paper_id)
      as rank from composed) where rank <= {n})"""


CATEGORIES = """, pts as (select *, 0.7e0 * influence + 0.3e0 * least(1, ln(1 + coalesce(citation_count, 0)) / 10) as f,
      0.7e0 * recency + 0.3e0 * relevance as e, case when topic_cluster_id <> -1 and row_number() over (
      partition by query_id, topic_cluster_id order by rank) = 1 then 1.0e0 else 0 end as c from chosen),
    assigned as (select *, case when greatest(f, representativeness, e, c) <= 0.5 then null
      when f = greatest(f, representativeness, e, c) then 'foundational'
      when representativeness = greatest(f, representativeness, e, c) then 'representative'
      when e = greatest(f, representativeness, e, c) then 'emerging' else 'contrasting' end as category from pts)"""


def candidates(v):
    return v.texts.join(v.text_scores, "paper_id").withColumns({
        "query_id": F.col("source"), "es_score": (F.length("abstract") % 97 + 1).cast("double"),
    })


def rounded(*names, digits=6):
    return [F.round(n, digits).alias(n) for n in names]


@query("texts", "text_scores", sql=f"""{CANDIDATES}{SIGNALS} select query_id, paper_id, round(relevance, 6) as relevance,
    round(influence, 6) as influence, round(recency, 6) as recency, round(representativeness, 6) as representativeness
    from signals""")
def score_signals(v):
    return sel.score_signals(candidates(v), as_of()).select(
        "query_id", "paper_id", *rounded("relevance", "influence", "recency", "representativeness")
    )


@query("texts", "text_scores", sql=f"""{CANDIDATES}{SIGNALS}{select_sql(20)} select query_id, paper_id, rank,
    round(diversity, 6) as diversity, round(composite_score, 6) as composite_score from chosen""")
def select_diverse(v):
    return sel.select_diverse(sel.score_signals(candidates(v), as_of())).select(
        "query_id", "paper_id", "rank", *rounded("diversity", "composite_score")
    )


@query("texts", "text_scores", sql=f"""{CANDIDATES}{SIGNALS}{select_sql(10, (0.35, 0.25, 2.0, 0.15, 0.10))}
    select query_id, paper_id, rank from chosen""")
def select_by_weights(v):
    """Only one weight is given; the others keep their defaults and all are scaled to one."""
    return sel.select_diverse(
        sel.score_signals(candidates(v), as_of()), 10, {"recency": 2.0}
    ).select("query_id", "paper_id", "rank")


@query("texts", "text_scores", sql=f"""{CANDIDATES}{SIGNALS}{select_sql(20)}, d as (select *, greatest(relevance, influence,
    recency, representativeness, diversity) as g from chosen) select query_id, paper_id,
    case when rank = 1 then 'Top match — ' else '' end || case
    when relevance = g then 'Highly relevant to your query and central to ' || topic_cluster
    when influence = g then printf('Widely cited foundational work in %s (citation score: %.2f)', topic_cluster, influence)
    when recency = g then 'Recent emerging approach in ' || topic_cluster || ' published '
      || coalesce(cast(submitted_date as varchar), 'recently')
    when representativeness = g then 'Representative of the ' || topic_cluster || ' cluster'
    else 'Provides a distinct perspective not covered by other selected papers' end as reason from d""")
def selection_reasons(v):
    chosen = sel.select_diverse(sel.score_signals(candidates(v), as_of()))
    return chosen.select("query_id", "paper_id", sel.selection_reason().alias("reason"))


@query("texts", "text_scores", sql=f"""{CANDIDATES}{SIGNALS}{select_sql(20)}{CATEGORIES} select query_id, paper_id, rank,
    category, place as category_place from (select *, row_number() over (partition by query_id, category order by rank) as place
    from assigned where category is not null) where place <= 3""")
def reading_categories(v):
    chosen = sel.select_diverse(sel.score_signals(candidates(v), as_of()))
    return sel.cap_per_category(sel.assign_categories(chosen), 3).select(
        "query_id", "paper_id", "rank", "category", "category_place"
    )


def classes_sql(text: str = "sentence") -> str:
    """Best cue of a sentence: the strongest, then the first class."""
    cases = sorted(
        ((-c, place, name, phrase) for place, (name, cues) in enumerate(CUES.items()) for phrase, c in cues.items()),
    )
    label = " ".join(f"when contains(lower({text}), '{p}') then '{n}'" for _, _, n, p in cases)
    score = " ".join(f"when contains(lower({text}), '{p}') then {-c}e0" for c, _, _, p in cases)
    return f"case {label} else 'OTHER' end as label, case {score} else 0 end as confidence"


SENTENCES = f""", cleaned as (select paper_id, {clean_sql('abstract', False)} as t from texts),
    sents as (select paper_id, unnest({sentences_sql('t')}) as sentence,
      generate_subscripts({sentences_sql('t')}, 1) - 1 as pos from cleaned),
    classed as (select *, {classes_sql()} from sents),
    top as (select * from (select *, row_number() over (partition by paper_id, label order by confidence desc, pos) as place
      from classed where label <> 'OTHER' and confidence >= 0.75) where place <= 5)"""


@query("texts", sql=f"{SENTENCES} select label, confidence, count(*) as sentences from classed group by 1, 2")
def classify_sentences(v):
    rows = v.texts.select("paper_id", "abstract", F.lit(None).cast("string").alias("full_text"))
    classed = sel.classify_with_cues(sel.paper_sentences(rows), CUES)
    return classed.groupBy("label", "confidence").agg(F.count("*").alias("sentences"))


@query("texts", sql=f"""{SENTENCES} select paper_id, pos, case when length(sentence) % 3 = 0 then 'METHODOLOGY' else 'OTHER' end as label,
    length(sentence) % 10 / 10 as confidence from sents""")
def classify_with_own_model(v):
    """A user's classifier, loaded once per task: here by the length of a sentence."""
    def load():
        return lambda sentences: [("METHODOLOGY" if len(s) % 3 == 0 else "OTHER", len(s) % 10 / 10) for s in sentences]

    rows = v.texts.select("paper_id", "abstract", F.lit(None).cast("string").alias("full_text"))
    return sel.classify_with_model(sel.paper_sentences(rows), load).select("paper_id", "pos", "label", "confidence")


@query("texts", sql=f"{SENTENCES} select paper_id, label, place, sentence from top")
def top_sentences(v):
    rows = v.texts.select("paper_id", "abstract", F.lit(None).cast("string").alias("full_text"))
    classed = sel.classify_with_cues(sel.paper_sentences(rows), CUES)
    return sel.top_sentences(classed).select("paper_id", "label", "place", "sentence")


LISTS = " , ".join(
    f"coalesce(string_agg(sentence, '|' order by place) filter (where label = '{label}'), '') as {name}"
    for label, name in (("METHODOLOGY", "methodological_details"), ("LIMITATION", "limitations"),
                        ("CONTRIBUTION", "contributions"), ("EVALUATION", "evaluation_context"))
)


@query("texts", sql=f"{SENTENCES} select paper_id, {LISTS} from texts left join top using (paper_id) group by 1")
def merge_annotations(v):
    rows = v.texts.select("paper_id", "abstract", F.lit(None).cast("string").alias("full_text"))
    notes = sel.annotations(sel.top_sentences(sel.classify_with_cues(sel.paper_sentences(rows), CUES)))
    merged = sel.merge_annotations(v.texts.select("paper_id"), notes)
    return merged.select("paper_id", *[
        F.array_join(n, "|").alias(n)
        for n in ("methodological_details", "limitations", "contributions", "evaluation_context")
    ])


@query("texts", "text_scores", "queries", sql=bm25_sql(
    {"title": 1.0, "abstract": 1.0, "topic_cluster": 1.0}, ("methods", "datasets", "tasks")
) + """, cand as (select r.query_id, r.score as es_score, texts.*, scores.pagerank_score from ranked r
    join texts on texts.paper_id = r.doc join scores on scores.paper_id = r.doc where place <= 200)"""
    + SIGNALS + select_sql(20) + CATEGORIES + SENTENCES + f""", notes as (select paper_id, {LISTS} from top group by 1)
    select query_id, paper_id, rank, category, coalesce(limitations, '') as limitations,
    coalesce(methodological_details, '') as methodological_details, case category
    when 'foundational' then printf('Widely cited foundational work in %s with %d citations and high influence score (%.2f)',
      topic_cluster, coalesce(citation_count, 0), influence)
    when 'representative' then printf('Central to the %s cluster — closely aligned with the core research direction '
      || '(representativeness: %.2f)', topic_cluster, representativeness)
    when 'emerging' then printf('Recent work in %s published %s with a strong recency signal (%.2f)', topic_cluster,
      coalesce(cast(submitted_date as varchar), 'recently'), recency)
    else 'Offers a distinct perspective from a different research cluster — broadens coverage beyond ' || topic_cluster
    end as category_reason, true as has_fulltext
    from (select *, row_number() over (partition by query_id, category order by rank) as place from assigned
    where category is not null) a left join notes using (paper_id) where place <= 10""")
def reading_guide(v):
    """Every benchmark passage gets its reading guide, in one plan."""
    found = guide.reading_guide(
        v.texts, v.text_scores, v.fulltext, v.queries, as_of(), stem=False,
        classify=lambda s: sel.classify_with_cues(s, CUES),
    )
    return found.select(
        "query_id", "paper_id", "rank", "category", F.array_join("limitations", "|").alias("limitations"),
        F.array_join("methodological_details", "|").alias("methodological_details"), "category_reason", "has_fulltext",
    )


@query("texts", "text_scores", sql=f"""select paper_id, case when submitted_date is null then 0
    when submitted_date > date '{AS_OF}' then 1 else round(exp(-(date '{AS_OF}' - submitted_date) / 365.0e0), 6) end as recency
    from texts""")
def recency_decay(v):
    return v.texts.select("paper_id", F.round(sel.recency(F.col("submitted_date"), as_of()), 6).alias("recency"))
