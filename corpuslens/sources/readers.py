"""Landing-zone readers. Every reader states its schema, so no inference pass runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens import schemas
from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import identifiers as ids

UNIFIED = (
    "paper_id", "title", "abstract", "authors", "submitted_date", "updated_date",
    "primary_category", "categories", "citation_count", "reference_count",
    "influential_citation_count", "source", "ingested_at", "s2_paper_id",
)
_TYPES = {
    "authors": "array<string>", "categories": "array<string>", "citation_count": "int",
    "reference_count": "int", "influential_citation_count": "int",
}


def _typed(name: str, kind: T.DataType) -> Column:
    """A field, read as text, in its type. What cannot be converted is NULL, and the record stays.

    Numbers may be quoted or have decimals; a list may be the JSON text of a list or a lone value; items of a list of records
    that are plain values become records with that value first.
    """
    text = F.col(name)
    if isinstance(kind, T.StringType):
        value = text
    elif isinstance(kind, (T.IntegerType, T.LongType)):
        value = F.coalesce(text.try_cast(kind), F.floor(text.try_cast("double")).try_cast(kind))
    elif isinstance(kind, T.ArrayType):
        items = F.from_json(text, "array<string>")
        if isinstance(kind.elementType, T.StringType):
            value = F.when(F.startswith(F.ltrim(text), F.lit("[")), items).when(text != "", F.array(text))
        else:
            first = kind.elementType.fields[0].name if isinstance(kind.elementType, T.StructType) else None

            def item(x: Column) -> Column:
                record = F.from_json(x, kind.elementType)
                if first is None:
                    return record
                lone = F.from_json(F.to_json(F.struct(x.alias(first))), kind.elementType)
                return F.when(F.startswith(F.ltrim(x), F.lit("{")), record).otherwise(lone)

            nested = isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType))
            value = F.transform(items, item) if nested else F.transform(items, lambda x: x.try_cast(kind.elementType))
    elif isinstance(kind, (T.StructType, T.MapType)):
        value = F.from_json(text, kind)
    else:
        value = text.try_cast(kind)
    return value.alias(name)


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    """Fields of each line's record; a malformed line, which is no JSON record, keeps its text in one column.

    Parsing is an expression here, not part of the file source, because the source refuses plans
    that only need to know which lines are malformed, such as a count. Fields are read as text and then converted one by
    one, so a field of another type costs its own value and not the record.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    fields = T.StructType.fromDDL(schema).fields
    record = F.from_json("value", schemas.with_corrupt(", ".join(f"`{f.name}` string" for f in fields)), options)
    kept = lines.filter(F.trim("value") != "")
    others = [c for c in lines.columns if c != "value"]
    return kept.select(*others, F.inline(F.array(record))).select(
        *others, *[_typed(f.name, f.dataType) for f in fields], schemas.CORRUPT
    )


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """JSON lines, plain or gzip (by suffix), from folders of any depth."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    return _parsed(lines, schema)


def well_formed(df: DataFrame) -> DataFrame:
    return df.filter(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)


def malformed_report(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """Good and bad lines of each file."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    rows = _parsed(lines.select("value", F.col("_metadata.file_name").alias("file_name")), schema).select(
        "file_name", F.col(schemas.CORRUPT).isNotNull().alias("bad")
    )
    return rows.groupBy("file_name").agg(
        F.count_if(~F.col("bad")).alias("good_lines"), F.count_if("bad").alias("bad_lines")
    )


def read_shard(
    spark: SparkSession, path: str, schema: str, max_records: int | None = None
) -> DataFrame:
    """One bulk shard, optionally its first `max_records` well-formed records."""
    rows = well_formed(read_jsonl(spark, path, schema))
    return rows if max_records is None else rows.limit(max_records)


def unify(df: DataFrame, source: str, **renamed) -> DataFrame:
    """Project a source onto the unified columns; what it lacks becomes a typed NULL."""

    def column(name: str):
        if name == "source":
            value = F.lit(source)
        elif name in renamed:
            value = renamed[name]
        elif name in df.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        return value.cast(_TYPES.get(name, "string")).alias(name)

    return df.select(*[column(name) for name in UNIFIED])


def unify_a(raw: DataFrame, source: str = fixed.SOURCES[0]) -> DataFrame:
    return unify(raw, source, categories=F.col("all_categories"))


def record_kind(raw: DataFrame) -> DataFrame:
    """Tag every record of the corpus source, so that one scan serves all three outputs."""
    has_text = F.coalesce(F.col("full_text"), F.lit("")) != ""
    return raw.withColumn(
        "kind",
        F.when(F.col("citing_id").isNotNull(), "edge")
        .when(F.col("full_text").isNotNull() & F.col("title").isNull(), "fulltext")
        .otherwise("metadata"),
    ).withColumn("has_text", has_text & F.col("citing_id").isNull())


def unify_b(raw: DataFrame, source: str = fixed.SOURCES[1]) -> DataFrame:
    kept = record_kind(raw).filter(F.col("kind") == "metadata")
    return unify(kept, source, submitted_date=F.col("date"))


def unify_c(raw: DataFrame, source: str = fixed.SOURCES[2]) -> DataFrame:
    return unify(
        raw,
        source,
        submitted_date=F.col("publication_date"),
        citation_count=F.col("cited_by_count"),
        authors=F.transform("authors", lambda a: a["name"]),
        categories=F.transform("concepts", lambda c: c["name"]),
    )


def unify_edges(raw: DataFrame, source: str = fixed.SOURCES[1]) -> DataFrame:
    return raw.filter(F.col("citing_id").isNotNull() & F.col("cited_id").isNotNull()).select(
        "citing_id", "cited_id", F.lit(source).alias("source")
    )


def unify_fulltext(raw: DataFrame) -> DataFrame:
    return record_kind(raw).filter("has_text").select(
        "paper_id",
        ids.preprint_id(F.col("paper_id")).alias("arxiv_id"),
        ids.corpus_id(F.col("paper_id")).alias("corpusid"),
        "full_text", "sections", "doi", "ingested_at",
    )


def read_source_a(spark: SparkSession, paths) -> DataFrame:
    return unify_a(well_formed(read_jsonl(spark, paths, schemas.RAW_A)))


def read_raw_b(spark: SparkSession, paths) -> DataFrame:
    return well_formed(read_jsonl(spark, paths, schemas.RAW_B))


def read_source_b(spark: SparkSession, paths) -> DataFrame:
    return unify_b(read_raw_b(spark, paths))


def read_source_c(spark: SparkSession, paths) -> DataFrame:
    return unify_c(well_formed(read_jsonl(spark, paths, schemas.RAW_C)))


def read_edges(spark: SparkSession, paths) -> DataFrame:
    return unify_edges(read_raw_b(spark, paths))


def read_fulltext(spark: SparkSession, paths) -> DataFrame:
    return unify_fulltext(read_raw_b(spark, paths))


def _one_per_paper(df: DataFrame) -> DataFrame:
    """The greatest record of each paper by its JSON text: a fixed rule, whatever the file order."""
    best = F.max_by(F.struct(*df.columns), F.to_json(F.struct(*df.columns)))
    return df.groupBy(F.col("paper_id").alias("_key")).agg(best.alias("row")).select("row.*")


def read_topic_assignments(spark: SparkSession, paths) -> DataFrame:
    """Topic rows from folders of any depth, one per paper."""
    rows = well_formed(read_jsonl(spark, paths, schemas.TOPIC_ROWS))
    return _one_per_paper(
        rows.filter(F.col("paper_id").isNotNull() & F.col("topic_cluster_id").isNotNull())
    )


def read_entities(spark: SparkSession, paths) -> DataFrame:
    """Entity arrays from folders of any depth, one row per paper."""
    rows = well_formed(read_jsonl(spark, paths, schemas.ENTITY_ROWS))
    return _one_per_paper(rows.filter(F.col("paper_id").isNotNull()))


def landing_paths(
    spark: SparkSession, base: str, source: str, date_from: str | None = None, date_to: str | None = None,
    skip: Sequence[str] = fixed.NON_PAPER_CATEGORIES,
) -> list[str]:
    """Day folders `base/source/category/day` inside the range. Only folder names are listed."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{source}/*/*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    kept = []
    for status in found:
        path = status.getPath()
        category, day = path.getParent().getName(), path.getName()
        inside = (date_from is None or day >= date_from) and (date_to is None or day <= date_to)
        if status.isDirectory() and category not in skip and inside:
            kept.append(path.toString())
    return sorted(kept)


#: source/category/day/file at the end of a path.
_DAY_FILE = r"/([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})/[^/]+$"


def read_day_folders(
    spark: SparkSession, base: str, schema: str, source: str | None = None, date_from: str | None = None,
    date_to: str | None = None, skip: Sequence[str] = fixed.NON_PAPER_CATEGORIES,
) -> DataFrame:
    """Records below `base/source/category/day` folders, with `source_dir`, `category` and `day` from the path.

    The three are expressions of each file's path in the plan, so filters on them, here or by the caller, choose the files
    before any is opened. Files elsewhere are left out.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(base)
    path = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract(path, _DAY_FILE, i)
    rows = lines.filter(F.regexp_like(path, F.lit(_DAY_FILE)) & ~part(2).isin(list(skip)))
    if source is not None:
        rows = rows.filter(part(1) == source)
    if date_from is not None:
        rows = rows.filter(part(3) >= date_from)
    if date_to is not None:
        rows = rows.filter(part(3) <= date_to)
    return well_formed(_parsed(
        rows.select("value", part(1).alias("source_dir"), part(2).alias("category"), part(3).cast("date").alias("day")), schema
    ))


def read_landing(
    spark: SparkSession, base: str, schema: str, date_from: str | None = None,
    date_to: str | None = None, skip: Sequence[str] = fixed.NON_PAPER_CATEGORIES,
) -> DataFrame:
    """Records below `source=/category=/date=` folders; Spark prunes the folders by these filters.

    The three partition columns come from the folders and are not part of `schema`.
    """
    rows = spark.read.option("basePath", base).text(base)
    rows = rows.filter(~F.col("category").isin(list(skip)))
    if date_from is not None:
        rows = rows.filter(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        rows = rows.filter(F.col("date") <= F.lit(date_to).cast("date"))
    return well_formed(_parsed(rows, schema))
