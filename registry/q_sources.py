"""Readers, normalisers and writers, on files that Spark writes from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuslens.functions import identifiers as ids
from corpuslens.operators import consolidate, entities
from corpuslens.sources import normalise, readers, writers
from registry.core import query
from registry.views import Views

NOW = "2024-06-30T12:00:00"


def raw_a(v: Views):
    return v.table("documents").selectExpr(
        "cast(doc_id as string) as paper_id", "'arxiv' as source", "split_part(text, '\\n', 1) as title",
        "text as abstract", "array(lang, source) as authors",
        "case when doc_id % 10 = 1 then '2023' when doc_id % 10 = 2 then 'soon' "
        "else cast(date_add(date '2023-01-01', cast(doc_id % 600 as int)) as string) end as submitted_date",
        "lang as primary_category", "array(lang) as all_categories", f"'{NOW}' as ingested_at",
    )


def raw_b(v: Views):
    """Metadata, edges and bodies in one folder, as the corpus source delivers them."""
    meta = v.table("orders").selectExpr(
        "cast(o_orderkey as string) as paper_id", "concat('order ', o_orderpriority) as title",
        "cast(o_orderdate as string) as date", "array(o_orderpriority) as categories",
        "cast(o_custkey % 50 as int) as citation_count", f"'{NOW}' as ingested_at",
    )
    edges = v.table("lineitem").selectExpr(
        "cast(l_orderkey as string) as citing_id", "cast(l_partkey as string) as cited_id",
    )
    bodies = v.table("documents").selectExpr(
        "case when doc_id % 2 = 0 then concat('2401.', cast(10000 + doc_id as string)) "
        "else cast(doc_id as string) end as paper_id",
        "text as full_text", f"'{NOW}' as ingested_at",
    )
    return meta.unionByName(edges, allowMissingColumns=True).unionByName(bodies, allowMissingColumns=True)


def raw_c(v: Views):
    return v.table("part").selectExpr(
        "cast(p_partkey as string) as paper_id", "p_name as title", "cast(1990 + p_size % 30 as string) as publication_date",
        "p_size as cited_by_count", "array(named_struct('name', p_brand, 'orcid', p_type)) as authors",
        "array(named_struct('name', p_type, 'score', 0.5D), named_struct('name', p_brand, 'score', 0.25D)) as concepts",
        f"'{NOW}' as ingested_at",
    )


def as_files(v: Views, df, name: str, **options) -> str:
    path = v.scratch(name)
    df.write.options(**options).json(path)
    return path


@query(sql="""select cast(doc_id as varchar) as paper_id, split_part(text, chr(10), 1) as title, text as abstract,
    lang || '|' || source as authors, lang as categories, 'arxiv' as source, cast(null as int) as citation_count,
    case when doc_id % 10 = 1 then '2023' when doc_id % 10 = 2 then 'soon'
         else cast(date '2023-01-01' + cast(doc_id % 600 as int) as varchar) end as submitted_date
    from documents""")
def read_source_a(v):
    df = readers.read_source_a(v.spark, as_files(v, raw_a(v), "raw_a"))
    return df.select(
        "paper_id", "title", "abstract", F.array_join("authors", "|").alias("authors"),
        F.array_join("categories", "|").alias("categories"), "source", "citation_count", "submitted_date",
    )


@query(sql="""select cast(o_orderkey as varchar) as paper_id, o_orderpriority as title, o_orderstatus as authors,
    case when o_orderkey % 4 = 3 then null else cast(o_custkey as int) end as citation_count from orders""")
def read_oddly_typed(v):
    """Counts with decimals, in quotes or as words, and authors as a list, a lone name or the JSON text of a list."""
    lines = v.table("orders").select(F.concat(
        F.lit('{"paper_id":'), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(
            F.concat(F.lit('"'), F.col("o_orderkey").cast("string"), F.lit('"'))
        ),
        F.lit(',"title":"'), "o_orderpriority",
        F.expr("""case o_orderkey % 4 when 0 then concat('","citation_count":', o_custkey, '.0') when 1 then concat('","citation_count":"', o_custkey, '"')
            when 2 then concat('","citation_count":', o_custkey) else '","citation_count":"many"' end"""),
        F.expr("""case o_orderkey % 3 when 0 then concat(',"authors":"', o_orderstatus, '"}') when 1 then concat(',"authors":["', o_orderstatus, '"]}')
            else concat(',"authors":"[\\\\"', o_orderstatus, '\\\\"]"}') end"""),
    ).alias("value"))
    path = v.scratch("odd")
    lines.write.text(path)
    return readers.read_source_b(v.spark, path).select(
        "paper_id", "title", F.array_join("authors", "|").alias("authors"), "citation_count"
    )


@query(sql="""select cast(o_orderkey as varchar) as paper_id, concat('order ', o_orderpriority) as title,
    o_orderpriority as categories, 's2orc' as source, cast(o_custkey % 50 as int) as citation_count from orders""")
def read_source_b(v):
    df = readers.read_source_b(v.spark, as_files(v, raw_b(v), "raw_b"))
    return df.select(
        "paper_id", "title", F.array_join("categories", "|").alias("categories"), "source", "citation_count"
    )


@query(sql="""select cast(p_partkey as varchar) as paper_id, p_name as title, p_brand as authors,
    p_type || '|' || p_brand as categories, cast(1990 + p_size % 30 as varchar) as submitted_date,
    p_size as citation_count, 'openalex' as source from part""")
def read_source_c(v):
    df = readers.read_source_c(v.spark, as_files(v, raw_c(v), "raw_c"))
    return df.select(
        "paper_id", "title", F.array_join("authors", "|").alias("authors"),
        F.array_join("categories", "|").alias("categories"), "submitted_date", "citation_count", "source",
    )


@query(sql="""select distinct cast(l_orderkey as varchar) as citing_id, cast(l_partkey as varchar) as cited_id,
    's2orc' as source from lineitem""")
def read_edges(v):
    return consolidate.dedup_edges(readers.read_edges(v.spark, as_files(v, raw_b(v), "raw_b")))


@query(sql="""select case when doc_id % 2 = 0 then concat('2401.', cast(10000 + doc_id as varchar)) end as arxiv_id,
    case when doc_id % 2 = 1 then cast(doc_id as varchar)
         when 10000 + doc_id > 999999 then concat('2401.', cast(10000 + doc_id as varchar)) end as corpusid,
    text as full_text from documents""")
def read_fulltext(v):
    df = readers.read_fulltext(v.spark, as_files(v, raw_b(v), "raw_b"))
    return df.select("arxiv_id", "corpusid", "full_text")


@query(sql="select cast(sum((c > 0)::int) as bigint) as good_lines, cast(sum((c = 0)::int) as bigint) as bad_lines "
           "from (select doc_id % 10 as c from documents)")
def malformed_lines(v):
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("paper_id"), "text"))
    broken = F.when(F.col("doc_id") % 10 == 0, F.regexp_replace(line, r"^\{", "")).otherwise(line)
    path = v.scratch("lines")
    v.table("documents").select(broken.alias("value")).write.text(path)
    found = readers.malformed_report(v.spark, path, "paper_id string, text string")
    return found.agg(F.sum("good_lines").alias("good_lines"), F.sum("bad_lines").alias("bad_lines"))


@query(sql="select lang, count(*) as records, cast(sum(length(text)) as bigint) as chars from documents group by lang")
def read_shard_gzip(v):
    path = as_files(v, v.table("documents").select("doc_id", "lang", "text"), "shard", compression="gzip")
    rows = readers.read_shard(v.spark, path, "doc_id bigint, lang string, text string")
    return rows.groupBy("lang").agg(F.count("*").alias("records"), F.sum(F.length("text")).alias("chars"))


@query(sql="""select cast(o_orderkey as varchar) as paper_id, cast(o_custkey % 13 as int) as topic_cluster_id,
    concat('topic_', cast(o_custkey % 13 as varchar)) as topic_cluster from orders""")
def read_topic_assignments(v):
    """Two folders of different depth hold the same records; each paper comes out once."""
    rows = v.table("orders").selectExpr(
        "cast(o_orderkey as string) as paper_id", "cast(o_custkey % 13 as int) as topic_cluster_id",
        "concat('topic_', cast(o_custkey % 13 as string)) as topic_cluster",
    )
    base = v.scratch("topics")
    rows.write.json(f"{base}/2024-06-30/spark_merge")
    rows.write.json(f"{base}/2024-06-30/spark_merge/2024-06-30")
    return readers.read_topic_assignments(v.spark, base).select("paper_id", "topic_cluster_id", "topic_cluster")


@query(sql="""select cast(o_orderkey as varchar) as paper_id, o_orderstatus || '|' || o_orderpriority as methods,
    cast(null as varchar) as datasets from orders""")
def read_entity_rows(v):
    rows = v.table("orders").selectExpr(
        "cast(o_orderkey as string) as paper_id", "array(o_orderstatus, o_orderpriority) as methods"
    )
    base = v.scratch("ner")
    rows.write.json(f"{base}/2024-06-30")
    rows.write.json(f"{base}/2024-06-30/2024-06-30")
    return readers.read_entities(v.spark, base).select(
        "paper_id", F.array_join("methods", "|").alias("methods"), F.array_join("datasets", "|").alias("datasets")
    )


@query(sql="""select event_id, event_type as category, cast(ts as date) as date from events
    where cast(ts as date) between date '2024-01-05' and date '2024-01-20' and event_type <> 'error'""")
def landing_date_range(v):
    rows = v.table("events").selectExpr(
        "event_id", "'arxiv' as source", "event_type as category", "cast(ts as date) as date"
    )
    base = v.scratch("landing")
    writers.write_raw(rows, base)
    found = readers.read_landing(
        v.spark, base, "event_id bigint", "2024-01-05", "2024-01-20",
        skip=("error",),
    )
    return found.select("event_id", "category", "date")


@query(sql="""select event_id, event_type, date '2024-03-01' + cast(event_id % 4 as int) as day from events
    where event_id % 3 <> 0 and event_id % 4 between 1 and 2""")
def landing_day_folders(v):
    """Folders source/category/day, of which the days outside the range and one category are never opened."""
    base, events = v.scratch("folders"), v.table("events").select("event_id", "event_type")
    for day in range(4):
        for kind, rest in (("edges", (0,)), ("papers", (1, 2))):
            part = events.filter((F.col("event_id") % 4 == day) & (F.col("event_id") % 3).isin(*rest))
            part.write.json(f"{base}/s2orc/{kind}/2024-03-0{1 + day}")
    found = readers.read_day_folders(v.spark, base, "event_id bigint, event_type string", "s2orc", "2024-03-02", "2024-03-03")
    return found.select("event_id", "event_type", "day")


@query(sql="""select cast(doc_id as varchar) as paper_id, trim(text, ' ') as abstract, trim(split_part(text, chr(10), 1), ' ') as title,
    lang || '|' || source as authors, '2024-01-' || lpad(cast(1 + doc_id % 28 as varchar), 2, '0') as submitted_date,
    case when doc_id % 3 = 0 then '' else concat('p/', cast(doc_id as varchar)) end as pdf_url from documents""")
def normalise_preprints(v):
    raw = v.table("documents").selectExpr(
        "concat(cast(doc_id as string), 'v', cast(1 + doc_id % 12 as string)) as short_id",
        "split_part(text, '\\n', 1) as title", "text as summary",
        "array(named_struct('name', lang), named_struct('name', source)) as authors",
        "cast(make_date(2024, 1, cast(1 + doc_id % 28 as int)) as timestamp) as published",
        "cast(make_date(2024, 2, 1) as timestamp) as updated", "lang as primary_category",
        "array(lang) as categories",
        "array(named_struct('title', 'doi', 'href', 'd'), named_struct('title', case when doc_id % 3 = 0 then 'html' "
        "else 'pdf' end, 'href', concat('p/', cast(doc_id as string)))) as links",
        "source as entry_id", "lang as queried_category",
    )
    return normalise.normalise_a(raw, F.lit(NOW)).select(
        "paper_id", "abstract", "title", F.array_join("authors", "|").alias("authors"), "submitted_date", "pdf_url"
    )


def result_b(v: Views):
    return v.table("orders").selectExpr(
        "case when o_orderkey % 3 = 0 then map('ArXiv', concat('24', cast(o_orderkey as string), 'v2')) "
        "when o_orderkey % 3 = 1 then map('DOI', concat('10/', cast(o_orderkey as string)), 'arxiv', '') end "
        "as externalIds",
        "case when o_orderkey % 4 = 1 then cast(o_orderkey as string) end as corpusId",
        "case when o_orderkey % 2 = 1 then concat('x', cast(o_orderkey as string)) end as paperId",
        "concat(' ', o_orderpriority, ' ') as title", "cast(null as string) as abstract",
        "array(named_struct('name', o_orderstatus), named_struct('name', '')) as authors",
        "case when o_orderkey % 5 = 0 then cast(cast(o_orderdate as date) as string) end as publicationDate",
        "date_format(o_orderdate, 'yyyy') as year",
        "case when o_custkey % 2 = 0 then 'venue' else '' end as venue",
        "named_struct('name', o_orderpriority) as publicationVenue",
        "array(o_orderstatus, '', o_orderpriority) as fieldsOfStudy",
        "cast(o_custkey as int) as citationCount", "cast(null as int) as referenceCount",
        "cast(null as boolean) as isOpenAccess", "named_struct('url', cast(null as string)) as openAccessPdf",
        "cast(null as string) as full_text",
        "case when o_custkey % 3 = 0 then array(named_struct('paperId', cast(o_custkey as string), 'corpusId', 'c'), "
        "named_struct('paperId', '', 'corpusId', concat('c', cast(o_custkey as string)))) end as references",
        "array(named_struct('paperId', cast(o_custkey as string), 'corpusId', cast(null as string))) as citations",
    )


B_ID = """coalesce(case when o_orderkey % 3 = 0 then concat('24', cast(o_orderkey as varchar)) end,
    case when o_orderkey % 4 = 1 then cast(o_orderkey as varchar) end,
    case when o_orderkey % 2 = 1 then concat('x', cast(o_orderkey as varchar)) end)"""


@query(sql=f"""select {B_ID} as paper_id, o_orderpriority as title, o_orderstatus as authors,
    case when o_orderkey % 5 = 0 then cast(cast(o_orderdate as date) as varchar) else strftime(o_orderdate, '%Y') end as date,
    case when o_custkey % 2 = 0 then 'venue' else o_orderpriority end as venue,
    o_orderstatus || '|' || o_orderpriority as categories, cast(o_custkey as int) as citation_count,
    0 as reference_count, false as is_open_access,
    case when o_orderkey % 3 = 1 then concat('10/', cast(o_orderkey as varchar)) else '' end as doi
    from orders where {B_ID} is not null""")
def normalise_corpus_records(v):
    return normalise.normalise_b(result_b(v), F.lit(NOW)).select(
        "paper_id", "title", F.array_join("authors", "|").alias("authors"), "date", "venue",
        F.array_join("categories", "|").alias("categories"), "citation_count", "reference_count",
        "is_open_access", "doi",
    )


@query(sql=f"""with r as (select {B_ID} as me, o_custkey from orders), u as (
    select me as citing_id, unnest([cast(o_custkey as varchar), concat('c', cast(o_custkey as varchar))]) as cited_id
    from r where o_custkey % 3 = 0
    union all select cast(o_custkey as varchar), me from r where o_custkey % 3 <> 0)
    select citing_id, cited_id, count(*) as n from u where citing_id <> cited_id
    group by 1, 2""")
def extract_edges(v):
    return normalise.extract_edges(result_b(v), F.lit(NOW)).groupBy("citing_id", "cited_id").agg(
        F.count("*").alias("n")
    )


@query(sql="""select cast(p_partkey as varchar) as paper_id, p_brand || ',' || p_type || ',' || p_name as authors,
    case when p_size % 2 = 0 then p_type || '=0.75|' || p_brand || '=0.5'
         else p_brand || '=0.5|' || p_type || '=0.25' end as concepts,
    p_size as cited_by_count, p_size % 2 = 0 as is_open_access, '' as doi from part""")
def normalise_supplementary(v):
    raw = v.table("part").selectExpr(
        "cast(p_partkey as string) as requested_id", "p_name as id", "cast(null as string) as doi",
        "p_name as title", "'2020-01-01' as publication_date", "2020 as publication_year",
        "p_size as cited_by_count",
        "array(named_struct('author', named_struct('display_name', p_brand, 'orcid', cast(null as string)), "
        "'institutions', array(named_struct('display_name', p_type, 'country_code', p_name), "
        "named_struct('display_name', 'second', 'country_code', 'zz')))) as authorships",
        "array(named_struct('display_name', p_brand, 'score', 0.5D), named_struct('display_name', p_type, 'score', "
        "case when p_size % 2 = 0 then 0.75D else 0.25D end)) as concepts",
        "named_struct('is_oa', p_size % 2 = 0, 'oa_url', cast(null as string)) as open_access",
    )
    out = normalise.normalise_c(raw, F.lit(NOW))
    author = F.get("authors", F.lit(0))
    return out.select(
        "paper_id",
        F.concat_ws(",", author["name"], author["institution_name"], author["institution_country"]).alias("authors"),
        F.array_join(
            F.transform("concepts", lambda c: F.concat(c["name"], F.lit("="), c["score"].cast("string"))), "|"
        ).alias("concepts"),
        "cited_by_count", "is_open_access", "doi",
    )


def bulk(v: Views):
    """Documents as bulk records: the first line is the title, the halves of the text are sections."""
    return v.table("documents").selectExpr(
        "doc_id as corpusid",
        "map('ArXiv', case when doc_id % 2 = 0 then concat('24', cast(doc_id as string)) end) as externalids",
        "named_struct('text', text, 'annotations', map("
        "'title', concat('[{\"start\":0,\"end\":', cast(length(split_part(text, '\\n', 1)) as string), '}]'), "
        "'abstract', concat('[{\"start\":\"0\",\"end\":\"', cast(length(text) as string), '\"},"
        "{\"start\":\"5\",\"end\":\"99999999\"}]'), "
        "'authorfirstname', '[{\"start\":\"4\",\"end\":\"6\"},{\"start\":0,\"end\":2}]', "
        "'authorlastname', '[{\"start\":2,\"end\":4}]', "
        "'sectionheader', concat('[{\"start\":', cast(length(text) div 2 as string), ',\"end\":', "
        "cast(length(text) div 2 + 1 as string), '},{\"start\":0,\"end\":1}]'))) as content",
        "cast(null as string) as publicationdate", "'2020' as year", "cast(null as string) as venue",
        "array(lang) as fieldsofstudy", "cast(n_chars as int) as citationcount", "cast(null as int) as referencecount",
    )


@query(sql="""with d as (select doc_id, text, length(text) as n, length(text) // 2 as h,
    split_part(text, chr(10), 1) as first_line from documents)
    select cast(doc_id as varchar) as corpus_id, trim(first_line, ' ') as title, trim(text, ' ') as abstract,
    trim(substr(text, 1, 1), ' ') as heading_1, trim(substr(text, 2, h - 1), ' ') as body_1,
    trim(substr(text, h + 1, 1), ' ') as heading_2, trim(substr(text, h + 2), ' ') as body_2 from d""")
def reshape_bulk(v):
    out = normalise.reshape_bulk(bulk(v))
    one, two = F.get("sections", F.lit(0)), F.get("sections", F.lit(1))
    return out.select(
        F.col("corpusId").alias("corpus_id"), "title", "abstract",
        one["heading"].alias("heading_1"), one["text"].alias("body_1"),
        two["heading"].alias("heading_2"), two["text"].alias("body_2"),
    )


@query(sql="""with d as (select doc_id, trim(substr(text, 1, 2), ' ') as a, trim(substr(text, 5, 2), ' ') as b,
    trim(substr(text, 3, 2), ' ') as l from documents),
    f as (select doc_id, l, list_filter([a, b], lambda x: x <> '') as fs, list_filter([l], lambda x: x <> '') as ls from d)
    select case when doc_id % 2 = 0 then concat('24', cast(doc_id as varchar)) else cast(doc_id as varchar) end as paper_id,
    array_to_string(list_filter([case when len(fs) > 0 and len(ls) > 0 then fs[1] || ' ' || ls[1]
        when len(fs) > 0 then fs[1] when len(ls) > 0 then ls[1] end, fs[2]], lambda x: x is not null), '|') as authors
    from f""")
def bulk_author_names(v):
    out = normalise.normalise_b(normalise.reshape_bulk(bulk(v)), F.lit(NOW))
    return out.select("paper_id", F.array_join("authors", "|").alias("authors"))


@query(sql="""with p as (select p_partkey, 1 + p_size % 4 as f, p_size % 3 as l from part)
    select p_partkey, array_to_string(list_transform(range(1, greatest(f, l) + 1),
    lambda i: case when i <= least(f, l) then concat('f', i, ' l', i) when i <= f then concat('f', i)
    else concat('l', i) end), '|') as names from p""")
def pair_author_names(v):
    def names(letter, n):
        return F.when(
            n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit(letter), i.cast("string")))
        ).otherwise(F.array().cast("array<string>"))

    first = names("f", F.col("p_size") % 4 + 1)
    last = names("l", F.col("p_size") % 3)
    paired = normalise.pair_author_names(first, last, F.array(F.lit("whole")))
    return v.table("part").select("p_partkey", F.array_join(paired, "|").alias("names"))


@query(sql="""select cast(doc_id as varchar) as paper_id, lang as title, text as full_text,
    cast(doc_id as varchar) as corpusid from documents""")
def split_fulltext(v):
    records = v.table("documents").selectExpr(
        "cast(doc_id as string) as paper_id", "lang as title", "text as full_text", "'' as doi", f"'{NOW}' as ingested_at"
    )
    meta, bodies = normalise.split_fulltext(records)
    return meta.select("paper_id", "title").join(bodies.select("paper_id", "full_text", "corpusid"), "paper_id")


ID_SQL = """case when o_custkey % 3 = 0 then concat(cast(2000 + o_custkey % 100 as varchar), '.', cast(10000 + o_orderkey % 90000 as varchar))
    when o_custkey % 3 = 1 then concat(cast(2000 + o_custkey % 100 as varchar), '.', cast(10000 + o_orderkey % 90000 as varchar), 'v3')
    else cast(o_orderkey as varchar) end"""


@query(sql=f"""with r as (select o_orderkey, o_custkey % 3 as k, {ID_SQL} as id from orders)
    select o_orderkey, case when k = 0 then id end as arxiv_id, case when k <> 0 then id end as corpusid,
    case when k = 2 then id else concat('ArXiv:', id) end as lookup_id,
    case when k = 1 then replace(id, 'v3', '') else id end as short_id from r""")
def classify_ids(v):
    rows = v.table("orders").selectExpr("o_orderkey", ID_SQL.replace("varchar", "string") + " as id")
    key = F.col("id")
    return rows.select(
        "o_orderkey", ids.preprint_id(key).alias("arxiv_id"), ids.corpus_id(key).alias("corpusid"),
        ids.lookup_id(key).alias("lookup_id"), ids.strip_version(key).alias("short_id"),
    )


@query(sql="""select cast(p.p_partkey as varchar) as paper_id, o.o_orderpriority as title
    from part p join orders o on o.o_orderkey = p.p_partkey""")
def enrich_by_id(v):
    """Every part asks for its metadata; records without an id keep the requested one."""
    asked = v.table("part").select(F.col("p_partkey").cast("string").alias("paper_id"))
    meta = v.table("orders").selectExpr(
        "cast(o_orderkey as string) as lookup_id",
        "case when o_orderkey % 2 = 0 then '' else cast(o_orderkey as string) end as paper_id", "o_orderpriority as title",
    )
    return normalise.enrich_by_id(asked, meta)


def tables(v: Views) -> str:
    """A database of its own in the shared folder, with the curated tables."""
    database = f"corpus_{uuid.uuid4().hex}"
    writers.create_tables(v.spark, database, v.scratch("tables"))
    return database


@query("papers", sql="""select paper_id, case when ingest_year_month = '1996-03' then 'changed' else title end as title,
    ingest_year_month from papers""")
def write_papers(v):
    """All months are written, then one again: it is replaced and the others stay."""
    table = f"{tables(v)}.papers"
    writers.write_papers(v.papers, table)
    month = v.papers.filter("ingest_year_month = '1996-03'").withColumn("title", F.lit("changed"))
    writers.write_papers(month, table)
    return v.spark.table(table).select("paper_id", "title", "ingest_year_month")


@query("edges", sql="select citing_id, cited_id, source from edges")
def write_edges(v):
    table = f"{tables(v)}.citation_edges"
    writers.write_flat(v.edges, table)
    return v.spark.table(table)


@query("papers", "mentions", sql="""select paper_id, title, ingest_year_month,
    (select string_agg(entity, '|' order by entity) from (select distinct entity from mentions m
     where m.paper_id = papers.paper_id and entity_type = 'METHOD')) as methods from papers""")
def rewrite_table(v):
    """Entity arrays go into the papers table, which is read and replaced."""
    table = f"{tables(v)}.papers"
    writers.write_papers(v.papers, table)
    arrays = entities.entity_arrays(v.mentions)
    writers.rewrite_table(
        v.spark, table,
        lambda df: writers.replace_columns(df, arrays, "paper_id", ["methods", "datasets", "tasks"]),
    )
    return v.spark.table(table).select(
        "paper_id", "title", "ingest_year_month", F.nullif(F.array_join("methods", "|"), F.lit("")).alias("methods")
    )


@query("papers", sql="""select paper_id, title, strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') as ingested_at,
    array_to_string(datasets, '|') as datasets from papers""")
def export_search_docs(v):
    path = v.scratch("docs")
    writers.write_docs(writers.export_search_docs(v.papers), path)
    docs = v.spark.read.schema("paper_id string, title string, ingested_at string, datasets array<string>").json(path)
    return docs.withColumn("datasets", F.array_join("datasets", "|"))


@query("papers", sql="select paper_id, topic_cluster from papers where ingest_year_month = '1996-03'")
def export_search_docs_month(v):
    return writers.export_search_docs(v.papers, "1996-03").select("paper_id", "topic_cluster")


@query("fulltext", sql="""select paper_id, len(lines) as section_count, '2024-03-15T23:59:59' as ingested_at
    from fulltext where ingested_at like '2024-03-15%'""")
def export_fulltext_docs_day(v):
    """The last half second of a day belongs to that day."""
    return writers.export_fulltext_docs(v.fulltext, "2024-03-15").select(
        "paper_id", F.size("sections").alias("section_count"), "ingested_at"
    )


@query("papers", sql="""select 'run_b' as run_id, paper_id, topic_cluster_id from papers
    union all select 'run_a', paper_id, topic_cluster_id + 100 from papers""")
def saved_runs(v):
    """Two runs side by side, the first one saved twice."""
    base = v.scratch("runs")
    rows = v.papers.select("paper_id", "topic_cluster_id")
    writers.save_run(rows, base, "run_a")
    writers.save_run(rows, base, "run_b")
    writers.save_run(rows.withColumn("topic_cluster_id", F.col("topic_cluster_id") + 100), base, "run_a")
    found = [
        writers.load_run(v.spark, base, r).select(F.lit(r).alias("run_id"), "paper_id", "topic_cluster_id")
        for r in writers.list_runs(v.spark, base)
    ]
    return found[0].unionAll(found[1])


@query(sql="""select cast(doc_id as varchar) as paper_id, cast(length(text) as bigint) as chars,
    cast(len(string_split(text, ' ')) as bigint) as words from documents""")
def embedding_store(v):
    """A first run stores the vectors of all texts; the second reads them without encoding any."""
    texts = v.table("documents").select(F.col("doc_id").cast("string").alias("paper_id"), "text")
    path = v.scratch("vectors")

    def encode(df):
        return df.withColumn("embedding", F.array(F.length("text"), F.size(F.split("text", " "))))

    def refuse(df):
        wrong = F.raise_error(F.lit("a stored text was encoded again"))
        return df.withColumn("embedding", F.array(wrong.cast("float")))

    writers.embedding_store(texts, path, "lengths", 2, encode)
    again = writers.embedding_store(texts, path, "lengths", 2, refuse)
    return again.select(
        "paper_id", F.col("embedding")[0].cast("bigint").alias("chars"), F.col("embedding")[1].cast("bigint").alias("words")
    )
