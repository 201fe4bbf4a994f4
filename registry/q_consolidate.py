"""Consolidation, counts and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import identifiers as ids
from corpuslens.operators import catalogue, consolidate
from corpuslens.sources import readers
from registry.core import query
from registry.views import Views

SOURCES_SQL = """with u as (
    select cast(doc_id as varchar) as paper_id, 1 as rk, 'arxiv' as source, split_part(text, chr(10), 1) as title,
      text as abstract, lang as primary_category, cast(null as int) as citation_count,
      '2024-01-0' || cast(1 + doc_id % 9 as varchar) as submitted_date, '2024-03' as ingested_at from documents
    union all select cast(o_orderkey as varchar), 2, 's2orc', concat('b: ', o_orderpriority),
      case when o_orderkey % 9 = 0 then o_orderstatus end, null, cast(o_custkey as int),
      cast(cast(o_orderdate as date) as varchar), '2024-02' from orders
    union all select cast(p_partkey as varchar), 3, 'openalex', p_name, null, p_brand, p_size,
      cast(1990 + p_size as varchar), '2024-04' from part),
    merged as (select paper_id, arg_min(title, rk) filter (where title is not null) as title,
      arg_min(abstract, rk) filter (where abstract is not null) as abstract,
      arg_min(primary_category, rk) filter (where primary_category is not null) as primary_category,
      arg_min(source, rk) as source, max(citation_count) as citation_count,
      arg_min(submitted_date, rk) as submitted_date, min(ingested_at) as ingested_at from u group by 1)"""


def sources(v: Views):
    a = readers.unify(v.table("documents").selectExpr(
        "cast(doc_id as string) as paper_id", "split_part(text, '\\n', 1) as title", "text as abstract",
        "lang as primary_category", "concat('2024-01-0', cast(1 + doc_id % 9 as string)) as submitted_date",
        "'2024-03' as ingested_at",
    ), "arxiv")
    b = readers.unify(v.table("orders").selectExpr(
        "cast(o_orderkey as string) as paper_id", "concat('b: ', o_orderpriority) as title",
        "case when o_orderkey % 9 = 0 then o_orderstatus end as abstract", "cast(o_custkey as int) as citation_count",
        "cast(cast(o_orderdate as date) as string) as submitted_date", "'2024-02' as ingested_at",
    ), "s2orc")
    c = readers.unify(v.table("part").selectExpr(
        "cast(p_partkey as string) as paper_id", "p_name as title", "p_brand as primary_category",
        "p_size as citation_count", "cast(1990 + p_size as string) as submitted_date", "'2024-04' as ingested_at",
    ), "openalex")
    return a, b, c


@query(sql=f"{SOURCES_SQL} select * from merged")
def merge_sources(v):
    return consolidate.merge_sources(*sources(v)).select(
        "paper_id", "title", "abstract", "primary_category", "source", "citation_count", "submitted_date", "ingested_at"
    )


@query(sql=f"""{SOURCES_SQL}, d as (select *, case when length(submitted_date) = 4
    then make_date(cast(submitted_date as int), 1, 1) else cast(submitted_date as date) end as day from merged)
    select paper_id, day as submitted_date, coalesce(strftime(day, '%Y-%m'), 'unknown') as ingest_year_month,
    cast(null as int) as topic_cluster_id from d""")
def curate_papers(v):
    return consolidate.curate(consolidate.merge_sources(*sources(v))).select(
        "paper_id", "submitted_date", "ingest_year_month", "topic_cluster_id"
    )


@query("raw_edges", sql="select citing_id, cited_id, min(source) as source from raw_edges group by 1, 2")
def dedup_edges(v):
    return consolidate.dedup_edges(v.raw_edges)


@query(sql="""select paper_id, source, title from (
    select *, row_number() over (partition by paper_id order by rk, seq) as rn from (
      select cast(l_orderkey as varchar) as paper_id, l_returnflag as source, cast(l_partkey as varchar) as title,
      case l_returnflag when 'N' then 0 when 'R' then 1 else 99 end as rk,
      concat(lpad(cast(l_partkey as varchar), 9, '0'), lpad(cast(l_suppkey as varchar), 9, '0')) as seq from lineitem)
    ) where rn = 1""")
def dedup_by_source(v):
    rows = v.table("lineitem").selectExpr(
        "cast(l_orderkey as string) as paper_id", "l_returnflag as source", "cast(l_partkey as string) as title",
        "concat(lpad(cast(l_partkey as string), 9, '0'), lpad(cast(l_suppkey as string), 9, '0')) as seq",
    )
    return consolidate.dedup_by_source(rows, F.col("seq"), ("N", "R")).select("paper_id", "source", "title")


@query(sql="""select paper_id, full_text, ingested_at from (select *, row_number() over (partition by paper_id
    order by length(full_text) desc, ingested_at desc, md5(full_text)) as rn from (
    select cast(conv_id as varchar) as paper_id, text as full_text, concat('2024-01-0', cast(turn as varchar)) as ingested_at
    from conversations)) where rn = 1""")
def longest_fulltext(v):
    rows = v.table("conversations").selectExpr(
        "cast(conv_id as string) as paper_id", "text as full_text",
        "concat('2024-01-0', cast(turn as string)) as ingested_at",
    )
    return consolidate.longest_fulltext(rows)


@query("texts", sql="select paper_id, length(trim(abstract, ' ')) as chars from texts where length(trim(abstract, ' ')) >= 100")
def minimum_length(v):
    return consolidate.long_enough(v.texts).select("paper_id", F.length(F.trim("abstract")).alias("chars"))


@query("texts", sql="""select length(trim(coalesce(title, ''), ' ')) < 50 as skip_ner, count(*) as papers
    from texts group by 1""")
def skip_short_texts(v):
    return consolidate.skip_flag(v.texts, "title").groupBy("skip_ner").agg(F.count("*").alias("papers"))


@query("papers", sql="select count(*) as papers, count(*) >= 50 as enough from papers")
def corpus_size_check(v):
    return consolidate.corpus_size_check(v.papers)


@query("papers", sql="""select primary_category, paper_id, place from (select *, row_number() over (
    partition by primary_category order by submitted_date desc, paper_id) as place from papers
    where submitted_date >= date '2001-08-01' - 365) where place <= 100""")
def lookback_newest(v):
    return consolidate.lookback(v.papers, F.lit("2001-08-01").cast("date"), 365, 100).select(
        "primary_category", "paper_id", "place"
    )


@query("papers", sql="""select source, count(*) as papers, count(topic_cluster) as with_topic,
    count(*) filter (where topic_cluster_id = -1) as outliers, count(methods) as with_methods from papers group by 1""")
def source_mix(v):
    return consolidate.source_mix(v.papers)


@query("texts", sql="""select source, count(*) as papers, count(l.doc_id) as labelled,
    round(count(l.doc_id) / count(*), 4) as coverage from texts
    left join (select distinct cast(doc_id as varchar) as doc_id from labels) l on l.doc_id = paper_id group by 1""")
def label_coverage(v):
    labels = v.table("labels").select(F.col("doc_id").cast("string").alias("paper_id"))
    return catalogue.label_coverage(v.texts, labels)


@query("landed", sql="select category, date, count(*) as papers from landed group by 1, 2")
def ingest_summary(v):
    return consolidate.ingest_summary(v.landed, "category", "date")


@query("landed", sql="select distinct paper_id from landed where date = date '2024-01-15'")
def todays_new_ids(v):
    return consolidate.new_ids(v.landed, F.lit("2024-01-15").cast("date"))


@query("papers", "edges", sql="""select 'papers' as table_name, count(*) as rows from papers
    union all select 'citation_edges', count(*) from edges union all select 'documents', count(*) from documents
    union all select 'pages', count(*) from pages""")
def table_counts(v):
    return consolidate.table_counts({
        "papers": v.papers, "citation_edges": v.edges, "documents": v.table("documents"), "pages": v.table("pages"),
    })


@query("papers", sql="""select ingest_year_month, count(*) as papers, count(submitted_date) as dated
    from papers group by 1""")
def month_partitions(v):
    month = ids.month_partition(F.col("submitted_date"))
    return v.papers.groupBy(month.alias("ingest_year_month")).agg(
        F.count("*").alias("papers"), F.count("submitted_date").alias("dated")
    )
