"""Listings, lookups, citations, idea evidence and limitation themes."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import catalogue as cat
from corpuslens.operators import citations as cit
from corpuslens.operators import influence, search, themes
from corpuslens.operators import trends as tr
from registry.core import query

def score():
    return F.round("pagerank_score", 6).alias("pagerank_score")


@query("papers", "scores", sql="""select paper_id, round(pagerank_score, 6) as pagerank_score, citation_count
    from papers left join scores using (paper_id)""")
def papers_with_scores(v):
    return cat.with_scores(v.papers, v.scores).select("paper_id", score(), "citation_count")


@query("papers", "scores", sql="""select paper_id, round(coalesce(pagerank_score, 0.15), 6) as pagerank_score
    from papers left join (select * from scores where pagerank_score > 0.5) s using (paper_id)""")
def score_or_floor(v):
    known = v.scores.filter("pagerank_score > 0.5")
    return cat.score_or_floor(v.papers, known).select("paper_id", score())


@query("papers", "scores", sql="""select paper_id, title, citation_count, round(pagerank_score, 6) as pagerank_score
    from papers left join scores using (paper_id)
    order by citation_count desc nulls last, paper_id limit 20 offset 40""")
def list_papers(v):
    return cat.list_papers(v.papers, v.scores, offset=40).select("paper_id", "title", "citation_count", score())


@query("papers", "scores", sql="""select paper_id, submitted_date, source from papers where source = 's2orc'
    and primary_category = '1-URGENT' order by submitted_date asc nulls first, paper_id limit 100""")
def list_papers_oldest(v):
    page = cat.list_papers(
        v.papers, v.scores, category="1-URGENT", source="s2orc", sort_by="submitted_date", order="asc", limit=100
    )
    return page.select("paper_id", "submitted_date", "source")


@query("papers", "scores", sql="""select paper_id, citation_count, round(pagerank_score, 6) as pagerank_score
    from papers join scores using (paper_id) where primary_category = '2-HIGH'
    order by scores.pagerank_score desc, paper_id limit 10""")
def top_influential(v):
    return cat.top_influential(v.papers, v.scores, "2-HIGH").select("paper_id", "citation_count", score())


@query("papers", "scores", sql="""(select 'influence' as mode, paper_id from papers join scores using (paper_id)
    order by pagerank_score desc nulls last, paper_id limit 10)
    union all (select 'citations', paper_id from papers order by citation_count desc nulls last, paper_id limit 10)
    union all (select 'recency', paper_id from papers order by submitted_date desc nulls last, paper_id limit 10)""")
def top_by_mode(v):
    parts = [
        cat.top_by_mode(v.papers, v.scores, mode).select(F.lit(mode).alias("mode"), "paper_id")
        for mode in cat.SORT_MODES
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("papers", sql="select paper_id, title from papers where paper_id > '500' order by paper_id limit 1000")
def page_after(v):
    return cat.page_after(v.papers, "500").select("paper_id", "title")


@query("texts", sql="""select paper_id, primary_category from texts
    where contains(title, 'en der') or contains(abstract, 'en der')""")
def substring_search(v):
    return cat.substring_search(v.texts, "en der").select("paper_id", "primary_category")


@query("texts", sql="""select paper_id, primary_category from texts
    where contains(lower(title), 'the 100%') or contains(lower(abstract), 'the or')""")
def substring_search_ignoring_case(v):
    """Per cent signs are ordinary characters."""
    found = cat.substring_search(v.texts, "THE OR", ignore_case=True)
    none = cat.substring_search(v.texts, "THE 100%", ("title",), ignore_case=True)
    return found.unionByName(none).distinct().select("paper_id", "primary_category")


@query("papers", "scores", sql="""select paper_id, round(pagerank_score, 6) as pagerank_score, umap_x from papers
    left join scores using (paper_id) where umap_x is not null and umap_y is not null
    and submitted_date between date '1996-01-01' and date '1998-12-31' and primary_category = '3-MEDIUM'
    and coalesce(scores.pagerank_score, 0) >= 0.6""")
def landscape(v):
    return cat.landscape(
        v.papers, v.scores, "3-MEDIUM", "1996-01-01", "1998-12-31", 0.6, limit=None
    ).select("paper_id", score(), "umap_x")


@query("papers", sql="""select paper_id, round((umap_x - x0) / (x1 - x0) * 660 + 20, 6) as view_x,
    round((umap_y - y0) / (y1 - y0) * 410 + 20, 6) as view_y from papers, (select min(umap_x) as x0, max(umap_x) as x1,
    min(umap_y) as y0, max(umap_y) as y1 from papers) where umap_x is not null and umap_y is not null""")
def viewport(v):
    return cat.viewport(v.papers.select("paper_id", "umap_x", "umap_y")).select(
        "paper_id", F.round("view_x", 6).alias("view_x"), F.round("view_y", 6).alias("view_y")
    )


@query("papers", sql="""select topic_cluster_id, min(paper_id) as first_paper, min(topic_cluster) as topic_name
    from papers where topic_cluster_id <> -1 group by 1 order by 2 limit 8""")
def legend(v):
    return cat.legend(v.papers)


@query("texts", sql="""select paper_id, topic_cluster_id from texts where umap_x is not null
    and list_has_any(string_split_regex(lower(title || ' ' || abstract), '[^\\p{L}\\p{N}]+'), ['thorsh', 'ereinen'])""")
def landscape_restricted_to_hits(v):
    hits = search.search(v.texts, search.one_query(v.spark, "thorsh ereinen"), k=None, stem=False)
    return cat.restrict_to(cat.landscape(v.texts, v.text_scores, limit=None), hits).select(
        "paper_id", "topic_cluster_id"
    )


@query("papers", sql="""select paper_id from papers where not exists (
    select 1 from lineitem where cast(l_partkey as varchar) = paper_id)""")
def unmatched_ids(v):
    cited = v.table("lineitem").select(F.col("l_partkey").cast("string").alias("paper_id"))
    return cat.unmatched(v.papers, cited)


@query("scores", sql="""select paper_id, round(pagerank_score, 6) as pagerank_score from scores
    where paper_id in (select cast(p_partkey as varchar) from part)""")
def lookup_by_ids(v):
    asked = v.table("part").select(F.col("p_partkey").cast("string").alias("paper_id"))
    return cat.lookup(v.scores, asked).select("paper_id", score())


@query(sql="""with asked as (select cast(o_orderkey as varchar) as paper_id from orders),
    bodies as (select cast(doc_id as varchar) as paper_id, text from documents where doc_id % 2 = 0),
    other as (select cast(doc_id as varchar) as paper_id, text from documents where doc_id % 2 = 1)
    select paper_id, length(coalesce(b.text, o.text)) as chars, coalesce(b.text, o.text) is not null as has_fulltext
    from asked left join bodies b using (paper_id) left join other o using (paper_id)""")
def fetch_fulltext(v):
    """Bodies of even documents are found by their key, of odd ones by the preprint id."""
    bodies = v.table("documents").selectExpr(
        "case when doc_id % 2 = 0 then cast(doc_id as string) else concat('c', cast(doc_id as string)) end as paper_id",
        "case when doc_id % 2 = 1 then cast(doc_id as string) end as arxiv_id", "text as full_text",
    )
    found = cat.fetch_fulltext(v.papers.select("paper_id"), bodies)
    return found.select("paper_id", F.length("full_text").alias("chars"), "has_fulltext")


@query("papers", "fulltext", sql="""select paper_id, title, length(full_text) as text_length,
    len(lines) as section_count from papers join fulltext using (paper_id)""")
def fulltext_overview(v):
    return cat.fulltext_overview(v.papers, v.fulltext)


@query("papers", sql="select paper_id, array_to_string(methods, '|') as methods from papers where len(methods) > 0")
def papers_with_entities(v):
    return cat.with_entities(v.papers).select("paper_id", F.array_join("methods", "|").alias("methods"))


@query("papers", "edges", "scores", "trends", sql="""select (select count(*) from papers) as total_papers,
    (select count(distinct primary_category) from papers) as total_categories,
    (select min(submitted_date) from papers) as earliest_paper, (select max(submitted_date) from papers) as latest_paper,
    (select count(*) from papers where len(methods) > 0) as ner_papers, (select count(*) from edges) as total_edges,
    (select count(*) from scores) as scored_papers, (select round(max(pagerank_score), 2) from scores) as max_pagerank,
    (select round(avg(pagerank_score), 2) from scores) as avg_pagerank,
    (select count(distinct year_month) from trends where topic_cluster is not null) as months_covered,
    (select count(distinct topic_cluster) from trends) as topic_count""")
def corpus_stats(v):
    return cat.corpus_stats(v.papers, v.edges, v.scores, v.trends)


@query("papers", sql="""select topic_cluster_id, topic_cluster, count(*) as paper_count,
    round(avg(umap_x), 6) as centroid_x, round(avg(umap_y), 6) as centroid_y from papers
    where topic_cluster_id <> -1 group by 1, 2 order by 3 desc, 1 limit 100""")
def topic_clusters(v):
    return cat.topic_clusters(v.papers).withColumns({
        "centroid_x": F.round("centroid_x", 6), "centroid_y": F.round("centroid_y", 6),
    })


@query("papers", sql="""select topic_cluster as entity, count(*) as paper_count from papers
    where topic_cluster <> '' group by 1 order by 2 desc, 1 limit 7""")
def trending_topics(v):
    return cat.trending_topics(v.papers, 7)


@query("papers", sql="""select entity, paper_count, cast(round(100.0 * paper_count / max(paper_count) over ()) as int) as pct
    from (select topic_cluster as entity, count(*) as paper_count from papers group by 1 order by 2 desc, 1 limit 7)""")
def share_of_top(v):
    return tr.share_of_top(cat.trending_topics(v.papers, 7))


@query("papers", "edges", "scores", sql="""select request_id, f.paper_id, q.title,
    round(s.pagerank_score, 6) as pagerank_score from (
      select p.paper_id as request_id, e.citing_id as paper_id from papers p join edges e on e.cited_id = p.paper_id
      union select p.paper_id, e.citing_id from papers p join edges e on e.cited_id = p.s2_paper_id) f
    left join papers q on q.paper_id = f.paper_id left join scores s on s.paper_id = f.paper_id""")
def cited_by(v):
    """For every paper, all that cite it."""
    return cit.cited_by(v.papers, v.edges, v.papers, v.scores, limit=None).select(
        "request_id", "paper_id", "title", score()
    )


@query("papers", "edges", "scores", sql="""select request_id, f.paper_id, q.title,
    round(s.pagerank_score, 6) as pagerank_score from (
      select e.citing_id as request_id, p.paper_id from papers p join edges e on e.cited_id = p.paper_id
      union select e.citing_id, p.paper_id from papers p join edges e on e.cited_id = p.s2_paper_id) f
    join papers q on q.paper_id = f.paper_id left join scores s on s.paper_id = f.paper_id""")
def references(v):
    return cit.references(v.papers, v.edges, v.papers, v.scores, limit=None).select(
        "request_id", "paper_id", "title", score()
    )


@query("papers", "edges", "scores", sql="""select request_id, direction, paper_id from (
    select *, row_number() over (partition by request_id, direction order by paper_id) as rn from (
      select p.paper_id as request_id, 'cited_by' as direction, e.citing_id as paper_id
        from papers p join edges e on e.cited_id = p.paper_id
      union select p.paper_id, 'cited_by', e.citing_id from papers p join edges e on e.cited_id = p.s2_paper_id
      union all select request_id, 'references', paper_id from (
        select e.citing_id as request_id, p.paper_id from papers p join edges e on e.cited_id = p.paper_id
        union select e.citing_id, p.paper_id from papers p join edges e on e.cited_id = p.s2_paper_id)))
    where rn <= 5""")
def neighbourhood(v):
    return cit.neighbourhood(v.papers, v.edges, v.papers, v.scores, limit=5).select(
        "request_id", "direction", "paper_id"
    )


@query("papers", "edges", "scores", sql="""select p.paper_id, p.title, round(s.pagerank_score, 6) as pagerank_score,
    coalesce(c.n, 0) as cited_by_count, coalesce(r.n, 0) as references_count from papers p
    left join scores s using (paper_id) left join (select cited_id, count(*) as n from edges group by 1) c
    on c.cited_id = p.paper_id left join (select citing_id, count(*) as n from edges group by 1) r
    on r.citing_id = p.paper_id""")
def paper_detail(v):
    return cit.paper_detail(v.papers, v.papers, v.scores, v.edges).select(
        "paper_id", "title", score(), "cited_by_count", "references_count"
    )


@query("papers", "edges", sql="""select cited_id as paper_id, 'cited_by' as direction, citing_id as other_id from edges
    where cited_id in (select paper_id from papers) union all select citing_id, 'references', cited_id from edges
    where citing_id in (select paper_id from papers)""")
def paper_links(v):
    return cit.paper_links(v.papers, v.edges)


@query("edges", sql="""select citing_id, cited_id from edges where citing_id = '7' or cited_id = '7'
    order by 1, 2 limit 200""")
def incident_edges(v):
    return cit.incident_edges(v.edges, "7", 200)


@query("edges", sql="select citing_id, cited_id from edges order by 1, 2 limit 50")
def first_edges(v):
    return cit.incident_edges(v.edges)


@query("edges", sql="select cited_id, count(*) as edge_citation_count from edges group by 1")
def in_degree(v):
    return influence.in_degree(v.edges)


@query("edges", sql="""select count(*) as edges, count(*) filter (where regexp_matches(citing_id, '^\\d+$')
    and regexp_matches(cited_id, '^\\d+$')) as resolvable, round(count(*) filter (where
    regexp_matches(citing_id, '^\\d+$') and regexp_matches(cited_id, '^\\d+$')) / count(*), 6) as share from edges""")
def edge_resolvability(v):
    return influence.resolvability(v.edges, r"^\d+$").withColumn("share", F.round("share", 6))


@query("scores", sql="select paper_id, round(pagerank_score, 6) as pagerank_score from scores")
def influence_scores(v):
    return v.scores.select("paper_id", score())


@query("scores", sql="""select round(avg(pagerank_score), 6) as avg_score, round(max(pagerank_score), 6) as max_score,
    round(min(pagerank_score), 6) as min_score, round(stddev_samp(pagerank_score), 6) as stddev_score,
    count(*) as total, count(*) filter (where pagerank_score > 0.15) as above_floor,
    round(100.0 * count(*) filter (where pagerank_score > 0.15) / count(*), 4) as above_floor_pct from scores""")
def score_summary(v):
    return influence.score_summary(v.scores).select(
        *[F.round(c, 6).alias(c) for c in ("avg_score", "max_score", "min_score", "stddev_score")],
        "total", "above_floor", F.round("above_floor_pct", 4).alias("above_floor_pct"),
    )


def _rounds(n: int) -> str:
    """The loop written out: one set of CTEs per round."""
    parts = ["r0 as materialized (select id, degree, 1.0e0 as rank from base)"]
    for i in range(1, n + 1):
        parts.append(f"""r{i} as materialized (select b.id, b.degree, 0.15e0 + 0.85e0 * (coalesce(x.got, 0) +
            (select coalesce(sum(rank), 0) from r{i - 1} where degree = 0) / (select count(*) from base)) as rank
            from base b left join (select l.dst, sum(r.rank / r.degree) as got from links l
            join r{i - 1} r on r.id = l.src group by 1) x on x.dst = b.id)""")
    return ", ".join(parts)


LINKS = """, names as (select id, arg_min(node, form) as node from (select paper_id as id, paper_id as node, 0 as form
      from papers union all select s2_paper_id, paper_id, 1 from papers) group by 1),
    links as materialized (select distinct a.node as src, b.node as dst from edges e join names a on a.id = e.citing_id
      join names b on b.id = e.cited_id where a.node <> b.node),
    base as materialized (select p.paper_id as id, coalesce(d.n, 0) as degree from papers p
      left join (select src, count(*) as n from links group by 1) d on d.src = p.paper_id), """


@query("papers", "edges", sql=f"""{LINKS} {_rounds(10)} select id as paper_id, round(rank, 5) as pagerank from r10""")
def pagerank(v):
    links = influence.resolve_edges(v.edges, v.papers)
    nodes = v.papers.select(F.col("paper_id").alias("id"))
    return influence.pagerank(nodes, links).withColumn("pagerank", F.round("pagerank", 5))


@query("papers", "edges", sql=f"""{LINKS} {_rounds(10)} select id as paper_id, round(rank, 5) as pagerank from r10""")
def pagerank_spread(v):
    """Links of every source with more than two of them lie in several buckets."""
    links = influence.resolve_edges(v.edges, v.papers)
    nodes = v.papers.select(F.col("paper_id").alias("id"))
    return influence.pagerank(nodes, links, links_per_bucket=2).withColumn("pagerank", F.round("pagerank", 5))


@query("papers", "edges", sql=f"{LINKS.rstrip().rstrip(',')} select src, dst from links")
def resolve_edges(v):
    return influence.resolve_edges(v.edges, v.papers)


SUPPORT, CAUTION = ("the", "zzz"), ("and", "with")
THEMES = {"one": ("the", "und"), "two": ("with", "que"), "three": ("of and", "mit")}
CUES = ("the", "der", "las")

EVIDENCE = """, ev as (select paper_id, primary_category, coalesce(nullif(trim(topic_cluster), ''), 'Unknown') as topic,
    scores.pagerank_score, submitted_date, lower(abstract) as low, abstract from texts left join scores using (paper_id)
    where contains(lower(title), 'ent') or contains(lower(abstract), 'ent'))"""
SENTENCES = """string_split(regexp_replace({t}, '([.!?])\\s+', '\\1' || chr(31), 'g'), chr(31))"""
SNIPPET = (
    "list_filter(list_transform(" + SENTENCES.format(t="abstract") + ", lambda s: trim(s, ' ')), lambda s: length(s) >= 30 and ("
    + " or ".join(f"contains(lower(s), '{c}')" for c in CUES) + "))[1]"
)


def evidence(v, limit):
    return themes.idea_evidence(
        v.texts, v.text_scores, "ENT", limit=limit, support=SUPPORT, caution=CAUTION, limitation=CUES
    )


@query("texts", "text_scores", sql=f"""{EVIDENCE} select paper_id, topic as topic_cluster,
    contains(low, 'the') as supports, contains(low, 'and') or contains(low, 'with') as cautions,
    substr({SNIPPET}, 1, 280) as limitation_snippet from ev
    order by coalesce(pagerank_score, 0) desc, submitted_date desc nulls last, paper_id limit 20""")
def idea_evidence(v):
    return evidence(v, 20).select("paper_id", "topic_cluster", "supports", "cautions", "limitation_snippet")


@query("texts", "text_scores", sql=f"""{EVIDENCE} select count(*) as evidence_papers,
    count(*) filter (where contains(low, 'the')) as supporting_signals,
    count(*) filter (where contains(low, 'and') or contains(low, 'with')) as cautionary_signals,
    round(count(*) filter (where contains(low, 'the')) / greatest(count(*), 1), 3) as support_ratio from ev""")
def idea_summary(v):
    return themes.idea_summary(evidence(v, None))


@query("texts", "text_scores", sql=f"""{EVIDENCE} select topic as topic_cluster, count(*) as paper_count from ev
    group by 1 order by 2 desc, 1 limit 6""")
def idea_topics(v):
    return themes.idea_topics(evidence(v, None))


def _any(words) -> str:
    return "(" + " or ".join(f"contains(low, '{w}')" for w in words) + ")"


THEME_SQL = ", low as (select *, lower(abstract) as low from texts where length(trim(abstract)) > 0), hits as (" + " union all ".join(
    f"select '{name}' as theme, paper_id, submitted_date, topic_cluster, abstract from low where {_any(words)}"
    for name, words in THEMES.items()
) + ")"


@query("texts", sql=f"{THEME_SQL} select theme, count(*) as papers from hits group by 1")
def limitation_themes(v):
    return themes.limitation_themes(themes.newest_abstracts(v.texts, None), THEMES)


@query("texts", sql=f"""{THEME_SQL} select theme, paper_id, topic_cluster, substr({SNIPPET}, 1, 280) as snippet, place
    from (select *, row_number() over (partition by theme order by submitted_date desc nulls last, paper_id) as place
    from hits) where place <= 3""")
def theme_examples(v):
    return themes.theme_examples(themes.newest_abstracts(v.texts, None), THEMES, CUES).select(
        "theme", "paper_id", "topic_cluster", "snippet", "place"
    )


@query("texts", sql=f"""{THEME_SQL} select count(*) as scanned_papers,
    count(*) filter (where {" or ".join(_any(w) for w in THEMES.values())}) as papers_with_limitations,
    round(count(*) filter (where {" or ".join(_any(w) for w in THEMES.values())}) / greatest(count(*), 1), 3)
    as coverage_ratio from low""")
def theme_coverage(v):
    return themes.theme_coverage(themes.newest_abstracts(v.texts, None), THEMES)


@query("texts", sql="""select paper_id, submitted_date from texts where length(trim(abstract)) > 0
    order by submitted_date desc nulls last, paper_id limit 250""")
def newest_abstracts(v):
    return themes.newest_abstracts(v.texts).select("paper_id", "submitted_date")


@query("papers", sql="""select coalesce(strftime(submitted_date, '%Y-%m'), 'Unknown') as year_month, count(*) as papers
    from papers group by 1""")
def months_logged(v):
    return tr.months_logged(v.papers)


@query("papers", sql="""select coalesce(strftime(submitted_date, '%Y-%m'), 'Unknown') as year_month, count(*) as papers,
    string_agg(paper_id, ' ' order by submitted_date desc, paper_id) as paper_ids from (select * from papers
    order by submitted_date desc nulls last, paper_id limit 25 offset 50) group by 1""")
def ingestion_log(v):
    return tr.ingestion_log(v.papers, page=2)
