"""The given tables seen as corpus entities: once as DataFrames, once as SQL for the check.

Every view covers its whole table. Where a rule sets a value to NULL or picks a kind, no row is lost.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens import session
from corpuslens.operators import entities, influence
from corpuslens.operators import trends as tr

AS_OF = "2024-06-30"


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return session.working_path(self.spark, name)

    @cached_property
    def papers(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as paper_id",
            "concat('order ', cast(o_orderkey as string)) as title",
            "concat('placed by ', cast(o_custkey as string), ' as ', o_orderpriority) as abstract",
            "array(concat('customer ', cast(o_custkey as string))) as authors",
            "case when o_orderkey % 17 = 3 then null else cast(o_orderdate as date) end as submitted_date",
            "cast(o_orderdate as date) as updated_date",
            "o_orderpriority as primary_category",
            "array(o_orderpriority, o_orderstatus) as categories",
            "case when o_orderkey % 7 = 0 then null else cast(o_orderkey * 31 % 500 as int) end as citation_count",
            "cast(o_custkey % 97 as int) as reference_count",
            "cast(null as int) as influential_citation_count",
            "case when o_custkey % 13 = 12 then -1 else cast(o_custkey % 13 as int) end as topic_cluster_id",
            "case when o_custkey % 13 = 12 then 'outlier' "
            "else concat('topic_', cast(o_custkey % 13 as string)) end as topic_cluster",
            "case when o_orderkey % 11 = 5 then null else cast(o_orderkey * 37 % 1000 as double) / 100 end as umap_x",
            "cast(o_custkey * 53 % 1000 as double) / 100 as umap_y",
            "case when o_orderkey % 5 = 1 then null else array(o_orderstatus, concat('m', o_orderpriority)) end as methods",
            "array(concat('data', cast(o_custkey % 29 as string))) as datasets",
            "array('the', concat('task ', cast(o_orderkey % 31 as string))) as tasks",
            "case o_orderstatus when 'F' then 'arxiv' when 'O' then 's2orc' else 'openalex' end as source",
            "o_orderdate as ingested_at",
            "concat('s', cast(o_orderkey as string)) as s2_paper_id",
            "case when o_orderkey % 17 = 3 then 'unknown' else date_format(o_orderdate, 'yyyy-MM') end "
            "as ingest_year_month",
        )

    @cached_property
    def raw_edges(self) -> DataFrame:
        """With repeats; every other line cites by the alternate id."""
        return self.table("lineitem").selectExpr(
            "cast(l_orderkey as string) as citing_id",
            "concat(case when l_linenumber % 2 = 0 then 's' else '' end, cast(l_partkey as string)) as cited_id",
            "l_returnflag as source",
        )

    @cached_property
    def edges(self) -> DataFrame:
        """Dealt by the citing paper, whose list is short; joins on it need no further shuffle."""
        return self.raw_edges.repartition("citing_id").groupBy("citing_id", "cited_id").agg(F.min("source").alias("source"))

    @cached_property
    def scores(self) -> DataFrame:
        return influence.influence_scores(self.papers)

    @cached_property
    def trends(self) -> DataFrame:
        return tr.trends(tr.dated_papers(self.papers, self.scores, self.edges))

    @cached_property
    def texts(self) -> DataFrame:
        """Documents as papers: the first line is the title, the whole text the abstract."""
        return self.table("documents").selectExpr(
            "cast(doc_id as string) as paper_id",
            "split_part(text, '\\n', 1) as title",
            "text as abstract",
            "lang as primary_category",
            "source",
            "cast(n_chars % 500 as int) as citation_count",
            "case when doc_id % 12 = 11 then -1 else cast(doc_id % 12 as int) end as topic_cluster_id",
            "case when doc_id % 12 = 11 then 'outlier' else concat('topic ', cast(doc_id % 12 as string)) end "
            "as topic_cluster",
            "case when doc_id % 19 = 4 then null else cast(doc_id * 37 % 1000 as double) / 100 end as umap_x",
            "cast(n_chars * 53 % 1000 as double) / 100 as umap_y",
            f"case when doc_id % 23 = 9 then null "
            f"else date_sub(date '{AS_OF}', cast(doc_id * 7 % 1500 as int) - 20) end as submitted_date",
            "array(source) as methods",
            "array(lang) as datasets",
            "array(concat(lang, ' ', source)) as tasks",
        )

    @cached_property
    def text_scores(self) -> DataFrame:
        return influence.influence_scores(self.texts)

    @cached_property
    def queries(self) -> DataFrame:
        """Every benchmark passage is a query."""
        return self.table("benchmark").selectExpr("cast(item_id as string) as query_id", "text")

    @cached_property
    def fulltext(self) -> DataFrame:
        """Documents as bodies; each line is a section headed by its first word."""
        return self.table("documents").selectExpr(
            "cast(doc_id as string) as paper_id",
            "cast(null as string) as arxiv_id",
            "cast(doc_id as string) as corpusid",
            "text as full_text",
            "transform(split(text, '\\n'), l -> named_struct('heading', split_part(l, ' ', 1), 'text', l)) as sections",
            "cast(null as string) as doi",
            "concat('2024-0', cast(1 + doc_id % 9 as string), '-15T23:59:59.5') as ingested_at",
        )

    @cached_property
    def tokens(self) -> DataFrame:
        """Every blank-separated word as a token with a label by its length."""
        words = self.table("documents").select(
            F.col("doc_id").cast("string").alias("paper_id"), F.posexplode(F.split("text", " ")).alias("pos", "word")
        )
        return words.selectExpr(
            "paper_id", "pos",
            "concat(case when length(word) % 5 = 4 then '##' else '' end, word) as token",
            "case length(word) % 7 when 0 then 'B-ORG' when 1 then 'I-ORG' when 2 then 'O' when 3 then 'I-MISC' "
            "when 4 then 'B-MISC' when 5 then 'I-ORG' else 'B-PER' end as label",
            "cast(100 - length(word) % 9 * 5 as double) / 100 as score",
            "pos * 10 as start", "pos * 10 + 9 as end",
        )

    @cached_property
    def mentions(self) -> DataFrame:
        parts = self.table("part").selectExpr("p_partkey", "p_name", "p_size")
        return self.table("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
            "cast(l_orderkey as string) as paper_id",
            "case when l_linenumber % 2 = 0 then concat(' ', upper(p_name), '.') else p_name end as entity_text",
            "case p_size % 3 when 0 then 'METHOD' when 1 then 'DATASET' else 'TASK' end as entity_type",
            "1 - l_discount as confidence",
            "l_linenumber as char_start", "l_linenumber + 5 as char_end",
        )

    @cached_property
    def paper_entities(self) -> DataFrame:
        """Papers with the entity arrays of their mentions."""
        arrays = entities.entity_arrays(self.mentions)
        return self.papers.drop("methods", "datasets", "tasks").join(arrays, "paper_id", "left")

    @cached_property
    def landed(self) -> DataFrame:
        return self.table("events").selectExpr(
            "cast(user_id as string) as paper_id", "event_type as category", "cast(ts as date) as date"
        )

    @cached_property
    def points(self) -> DataFrame:
        """Two components of each vector as coordinates."""
        return self.table("embeddings").selectExpr(
            "cast(vec_id as string) as paper_id", "cast(embedding[0] as double) as umap_x",
            "cast(embedding[1] as double) as umap_y", "label",
        )


# The same views for the checking engine.
SQL = {
    "papers": """papers as (select cast(o_orderkey as varchar) as paper_id,
        concat('order ', cast(o_orderkey as varchar)) as title,
        concat('placed by ', cast(o_custkey as varchar), ' as ', o_orderpriority) as abstract,
        case when o_orderkey % 17 = 3 then null else cast(o_orderdate as date) end as submitted_date,
        o_orderpriority as primary_category,
        case when o_orderkey % 7 = 0 then null else cast(o_orderkey * 31 % 500 as int) end as citation_count,
        cast(o_custkey % 97 as int) as reference_count,
        case when o_custkey % 13 = 12 then -1 else cast(o_custkey % 13 as int) end as topic_cluster_id,
        case when o_custkey % 13 = 12 then 'outlier'
             else concat('topic_', cast(o_custkey % 13 as varchar)) end as topic_cluster,
        case when o_orderkey % 11 = 5 then null
             else cast(o_orderkey * 37 % 1000 as double) / 100 end as umap_x,
        cast(o_custkey * 53 % 1000 as double) / 100 as umap_y,
        case when o_orderkey % 5 = 1 then null else [o_orderstatus, concat('m', o_orderpriority)] end as methods,
        [concat('data', cast(o_custkey % 29 as varchar))] as datasets,
        ['the', concat('task ', cast(o_orderkey % 31 as varchar))] as tasks,
        case o_orderstatus when 'F' then 'arxiv' when 'O' then 's2orc' else 'openalex' end as source,
        o_orderdate as ingested_at,
        concat('s', cast(o_orderkey as varchar)) as s2_paper_id,
        case when o_orderkey % 17 = 3 then 'unknown' else strftime(o_orderdate, '%Y-%m') end as ingest_year_month
        from orders)""",
    "raw_edges": """raw_edges as (select cast(l_orderkey as varchar) as citing_id,
        concat(case when l_linenumber % 2 = 0 then 's' else '' end, cast(l_partkey as varchar)) as cited_id,
        l_returnflag as source from lineitem)""",
    "edges": """edges as (select citing_id, cited_id, min(source) as source from raw_edges group by 1, 2)""",
    "scores": """logs as (select paper_id, ln(1 + coalesce(citation_count, 0)) as lg from papers),
        scores as (select paper_id, 0.15e0 + 0.85e0 * ((lg - lo) / case when hi > lo then hi - lo else 1 end)
        as pagerank_score from logs, (select min(lg) as lo, max(lg) as hi from logs))""",
    "dated": """dated as (select p.paper_id, primary_category, topic_cluster, topic_cluster_id,
        strftime(submitted_date, '%Y-%m') as year_month, pagerank_score,
        cast(coalesce(e.n, citation_count) as double) as citation_count
        from papers p left join scores using (paper_id)
        left join (select cited_id, count(*) as n from edges group by 1) e on e.cited_id = p.paper_id
        where submitted_date is not null)""",
    "trends": """trends as (select 'category' as grain, primary_category, cast(null as varchar) as topic_cluster,
        cast(null as int) as topic_cluster_id, year_month, count(*) as paper_count,
        avg(citation_count) as avg_citation_count, avg(pagerank_score) as avg_pagerank from dated group by 2, 5
        union all select 'topic', primary_category, topic_cluster, topic_cluster_id, year_month, count(*),
        avg(citation_count), avg(pagerank_score) from dated where topic_cluster is not null group by 2, 3, 4, 5)""",
    "texts": f"""texts as (select cast(doc_id as varchar) as paper_id, split_part(text, chr(10), 1) as title,
        text as abstract, lang as primary_category, source, cast(n_chars % 500 as int) as citation_count,
        case when doc_id % 12 = 11 then -1 else cast(doc_id % 12 as int) end as topic_cluster_id,
        case when doc_id % 12 = 11 then 'outlier'
             else concat('topic ', cast(doc_id % 12 as varchar)) end as topic_cluster,
        case when doc_id % 19 = 4 then null else cast(doc_id * 37 % 1000 as double) / 100 end as umap_x,
        cast(n_chars * 53 % 1000 as double) / 100 as umap_y,
        case when doc_id % 23 = 9 then null
             else date '{AS_OF}' - (cast(doc_id * 7 % 1500 as int) - 20) end as submitted_date,
        [source] as methods, [lang] as datasets, [concat(lang, ' ', source)] as tasks from documents)""",
    "text_scores": """logs as (select paper_id, ln(1 + coalesce(citation_count, 0)) as lg from texts),
        scores as (select paper_id, 0.15e0 + 0.85e0 * ((lg - lo) / case when hi > lo then hi - lo else 1 end)
        as pagerank_score from logs, (select min(lg) as lo, max(lg) as hi from logs))""",
    "queries": """queries as (select cast(item_id as varchar) as query_id, text from benchmark)""",
    "fulltext": """fulltext as (select cast(doc_id as varchar) as paper_id, text as full_text,
        string_split(text, chr(10)) as lines,
        concat('2024-0', cast(1 + doc_id % 9 as varchar), '-15T23:59:59.5') as ingested_at from documents)""",
    "tokens": """split as (select cast(doc_id as varchar) as paper_id, string_split(text, ' ') as w from documents),
        spread as (select paper_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as pos from split),
        tokens as (select paper_id, pos,
        concat(case when length(word) % 5 = 4 then '##' else '' end, word) as token,
        case length(word) % 7 when 0 then 'B-ORG' when 1 then 'I-ORG' when 2 then 'O' when 3 then 'I-MISC'
             when 4 then 'B-MISC' when 5 then 'I-ORG' else 'B-PER' end as label,
        cast(100 - length(word) % 9 * 5 as double) / 100 as score, pos * 10 as "start", pos * 10 + 9 as "end"
        from spread)""",
    "mentions": """mentions as (select cast(l_orderkey as varchar) as paper_id,
        case when l_linenumber % 2 = 0 then concat(' ', upper(p_name), '.') else p_name end as entity_text,
        case p_size % 3 when 0 then 'METHOD' when 1 then 'DATASET' else 'TASK' end as entity_type,
        l_linenumber as char_start, trim(trim(lower(case when l_linenumber % 2 = 0
        then concat(' ', upper(p_name), '.') else p_name end)), '.') as entity
        from lineitem join part on l_partkey = p_partkey)""",
    "landed": """landed as (select cast(user_id as varchar) as paper_id, event_type as category,
        cast(ts as date) as date from events)""",
    "points": """points as (select cast(vec_id as varchar) as paper_id, cast(embedding[1] as double) as umap_x,
        cast(embedding[2] as double) as umap_y, label from embeddings)""",
}

NEEDS = {
    "edges": ["raw_edges"],
    "scores": ["papers"],
    "dated": ["papers", "scores", "edges"],
    "trends": ["dated"],
    "text_scores": ["texts"],
}


def cte(*names: str) -> str:
    """WITH clause of the views and all that they need, each once and in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "with recursive " + ", ".join(SQL[n] for n in order)
