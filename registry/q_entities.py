"""Entities: spans, dictionary mentions, indexes and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import entities as en
from registry.core import query
from registry.q_text import clean_sql, sentences_sql, words_sql

SPANS = """, marked as (select *, label <> 'O' and (label like 'B-%' or coalesce(prev, 'O') = 'O'
      or substr(prev, 3) <> substr(label, 3)) as st from (select *, lag(label) over (partition by paper_id order by pos) as prev
      from tokens)),
    numbered as (select *, max(case when st then pos end) over (partition by paper_id order by pos) as span from marked),
    spans as (select paper_id, span, arg_min(substr(label, 3), pos) as label,
      trim(regexp_replace(regexp_replace(string_agg(token, ' ' order by pos), ' ##', '', 'g'), '^##', ''), ' ') as text,
      avg(score) as score, count(*) as tokens, min("start") as "start", max("end") as "end"
      from numbered where label <> 'O' group by 1, 2)"""


@query("tokens", sql=f"""{SPANS} select paper_id, span, label, text, round(score, 6) as score, tokens, "start", "end" from spans""")
def decode_spans(v):
    return en.decode_spans(v.tokens).withColumn("score", F.round("score", 6))


@query("tokens", sql=f"""{SPANS} select paper_id, text as entity_text, case label when 'ORG' then 'METHOD' else 'TASK' end
    as entity_type, round(score, 6) as confidence, "start" as char_start from spans
    where label in ('ORG', 'MISC') and score >= 0.8 - 1e-12""")
def map_entities(v):
    spans = en.decode_spans(v.tokens).withColumn("score", F.round("score", 12))
    return en.map_entities(spans).select(
        "paper_id", "entity_text", "entity_type", F.round("confidence", 6).alias("confidence"), "char_start"
    )


GRAMS = f""", cleaned as (select cast(doc_id as varchar) as paper_id, {clean_sql('text', False)} as t from documents),
    ready as (select paper_id, array_to_string({sentences_sql('t')}, ' ') as text from cleaned),
    w as (select paper_id, {words_sql('text', False)} as w from ready where length(text) >= 50),
    p as (select paper_id, w, unnest(range(0, len(w))) as pos from w),
    grams as (select paper_id, pos, n, array_to_string(w[pos + 1:pos + n], ' ') as term from p,
      (select unnest([1, 2]) as n) where pos + n <= len(w)),
    gaz as (select term, case length(term) % 3 when 0 then 'DATASET' when 1 then 'METHOD' else 'TASK' end as entity_type
      from (select distinct array_to_string(b[i:i + 1], ' ') as term from (select {words_sql('text', False)} as b,
      unnest(range(1, len({words_sql('text', False)}))) as i from benchmark)
      union select distinct b[1] from (select {words_sql('text', False)} as b from benchmark) where len(b) > 0)),
    m as (select * from grams join gaz using (term)),
    cover as (select *, unnest(range(pos, pos + n)) as spot from m),
    win as (select *, row_number() over (partition by paper_id, spot order by n desc, pos) as rn from cover),
    kept as (select paper_id, pos, n, term, entity_type from win where rn = 1 group by all having count(*) = n)"""


def gazetteer(v):
    """Word pairs and first words of every benchmark passage."""
    b = v.table("benchmark").select(en.tx.words(F.col("text")).alias("b")).filter(F.size("b") > 0)
    pairs = b.filter(F.size("b") > 1).select(F.explode(F.transform(
        F.sequence(F.lit(1), F.size("b") - 1), lambda i: F.array_join(F.slice("b", i, 2), " ")
    )).alias("term"))
    terms = pairs.unionAll(b.select(F.get("b", F.lit(0)))).distinct()
    kind = F.when(F.length("term") % 3 == 0, "DATASET").when(F.length("term") % 3 == 1, "METHOD").otherwise("TASK")
    return terms.withColumn("entity_type", kind)


@query(sql="with x as (select 1)" + GRAMS + """ select paper_id, term as entity_text, entity_type, pos as char_start,
    pos + n as char_end from kept""")
def tag_with_dictionary(v):
    texts = v.table("documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.col("text").alias("abstract"))
    ready = en.prepare_for_tagging(texts)
    return en.tag_with_dictionary(ready, gazetteer(v), 2).select(
        "paper_id", "entity_text", "entity_type", "char_start", "char_end"
    )


def load_length_tagger():
    """A stand-in for a model: long words are organisations."""

    def predict(texts):
        return [
            [
                {"token": w, "label": "B-ORG" if len(w) > 9 else "O", "score": 0.9, "start": i, "end": i + 1}
                for i, w in enumerate(t.split(" "))
            ]
            for t in texts
        ]

    return predict


@query(sql=f"""with cleaned as (select cast(doc_id as varchar) as paper_id, {clean_sql('text', False)} as t from documents),
    ready as (select paper_id, array_to_string({sentences_sql('t')}, ' ') as text from cleaned),
    w as (select paper_id, unnest(string_split(text, ' ')) as word from ready where length(text) >= 50)
    select paper_id, count(*) filter (where length(word) > 9) as method_count, 0 as dataset_count, 0 as task_count
    from w group by 1 having count(*) filter (where length(word) > 9) > 0""")
def tag_with_model(v):
    texts = v.table("documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.col("text").alias("abstract"))
    predictions = en.tag_with_model(en.prepare_for_tagging(texts), load_length_tagger)
    return en.entity_counts(en.map_entities(en.decode_spans(predictions)))


@query("mentions", sql="select entity, paper_id, count(*) as mentions from mentions group by 1, 2")
def entity_postings(v):
    return en.entity_postings(v.mentions)


@query("mentions", sql="""select entity, first(entity_type order by paper_id, char_start, entity_type) as entity_type,
    count(distinct paper_id) as paper_count, count(*) as total_mentions from mentions group by 1""")
def entity_index(v):
    return en.entity_index(v.mentions)


@query("mentions", sql="select entity_type, entity, count(*) as mentions from mentions group by 1, 2")
def entity_frequency(v):
    return en.entity_frequency(v.mentions)


@query("papers", "mentions", sql="""select count(*) as total_entity_mentions, count(distinct (entity_type, entity)) as unique_entities,
    count(distinct entity) filter (where entity_type = 'METHOD') as unique_method,
    count(distinct entity) filter (where entity_type = 'DATASET') as unique_dataset,
    count(distinct entity) filter (where entity_type = 'TASK') as unique_task,
    (select count(*) from papers) as total_papers, count(distinct paper_id) as papers_with_entities,
    round(count(*) / (select count(*) from papers), 6) as avg_entities_per_paper from mentions""")
def entity_summary(v):
    return en.entity_summary(v.papers, v.mentions).withColumn(
        "avg_entities_per_paper", F.round("avg_entities_per_paper", 6)
    )


@query("mentions", sql="""select paper_id, count(*) filter (where entity_type = 'METHOD') as method_count,
    count(*) filter (where entity_type = 'DATASET') as dataset_count,
    count(*) filter (where entity_type = 'TASK') as task_count from mentions group by 1""")
def entity_counts(v):
    return en.entity_counts(v.mentions)


@query("mentions", sql="""select paper_id, coalesce(string_agg(entity, '|' order by entity) filter (where entity_type = 'METHOD'), '') as methods,
    coalesce(string_agg(entity, '|' order by entity) filter (where entity_type = 'DATASET'), '') as datasets,
    coalesce(string_agg(entity, '|' order by entity) filter (where entity_type = 'TASK'), '') as tasks
    from (select distinct paper_id, entity_type, entity from mentions) group by 1""")
def entity_arrays(v):
    return en.entity_arrays(v.mentions).select(
        "paper_id", *[F.array_join(c, "|").alias(c) for c in ("methods", "datasets", "tasks")]
    )


@query("papers", sql="""select entity, count(*) as paper_count from (select distinct paper_id, unnest(tasks) as entity from papers)
    where entity <> 'the' group by 1 order by 2 desc, 1 limit 15""")
def trending_entities(v):
    """The stop term that every paper carries stays out."""
    return en.trending_entities(v.papers, "task", 15)


@query("papers", sql="""select ingest_year_month as year_month, count(*) as paper_count from papers
    where list_contains(datasets, 'data7') group by 1""")
def entity_timeline(v):
    return en.entity_timeline(v.papers, "data7", "dataset")


@query("papers", sql="""select entity, ingest_year_month as year_month, count(*) as paper_count from (
    select paper_id, ingest_year_month, unnest(list_distinct(methods)) as entity from papers)
    where entity in ('F', 'O', 'm1-URGENT') and ingest_year_month between '1996-01' and '1999-12' group by 1, 2""")
def entity_adoption(v):
    return en.adoption(v.papers, ["F", "O", "m1-URGENT"], "method", "1996-01", "1999-12")
