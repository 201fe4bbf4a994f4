"""Records of the three services, brought to the landing schemas by expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import identifiers as ids
from corpuslens.functions.text import unfold

_SPAN = "array<struct<start: string, end: string>>"


def _text(column: Column) -> Column:
    return F.trim(F.coalesce(column, F.lit("")))


def _named(value: Column, field: str) -> Column:
    """A value that some records give plainly and others as the JSON text of an object with it."""
    return F.when(F.startswith(F.ltrim(value), F.lit("{")), F.get_json_object(value, f"$.{field}")).otherwise(value)


def normalise_a(raw: DataFrame, ingested_at: Column, source: str = fixed.SOURCES[0]) -> DataFrame:
    """Preprint results: short id without version, ISO days, the link titled pdf."""
    pdf = F.get(F.filter("links", lambda x: x["title"] == "pdf"), F.lit(0))
    return raw.select(
        ids.strip_version(F.col("short_id")).alias("paper_id"),
        F.lit(source).alias("source"),
        F.trim("title").alias("title"),
        F.trim("summary").alias("abstract"),
        F.transform("authors", lambda a: a["name"]).alias("authors"),
        F.date_format("published", "yyyy-MM-dd").alias("submitted_date"),
        F.date_format("updated", "yyyy-MM-dd").alias("updated_date"),
        "primary_category",
        F.col("categories").alias("all_categories"),
        F.coalesce(pdf["href"], F.lit("")).alias("pdf_url"),
        F.col("entry_id").alias("arxiv_url"),
        "queried_category",
        ingested_at.alias("ingested_at"),
    )


def _external(name: str) -> Column:
    """An external id, whatever the case of its key."""
    lowered = F.transform_keys(
        F.map_filter("externalIds", lambda k, v: F.coalesce(v, F.lit("")) != ""), lambda k, v: F.lower(k)
    )
    return F.try_element_at(lowered, F.lit(name))


def _preferred_id() -> Column:
    return F.coalesce(
        ids.strip_version(_external("arxiv")),
        ids.non_empty(F.col("corpusId")),
        ids.non_empty(F.col("paperId")),
    )


def normalise_b(raw: DataFrame, ingested_at: Column, source: str = fixed.SOURCES[1]) -> DataFrame:
    """Citation-corpus records. Rows without any id are dropped."""
    rows = raw.withColumn("paper_id", _preferred_id()).filter(ids.valid_key(F.col("paper_id")))
    return rows.select(
        "paper_id",
        F.lit(source).alias("source"),
        F.coalesce("paperId", F.lit("")).alias("s2_paper_id"),
        _text(F.col("title")).alias("title"),
        _text(F.col("abstract")).alias("abstract"),
        F.coalesce(
            F.filter(
                F.transform("authors", lambda a: a["name"]), lambda n: F.coalesce(n, F.lit("")) != ""
            ),
            F.array().cast("array<string>"),
        ).alias("authors"),
        F.coalesce(
            ids.non_empty(F.col("publicationDate")), ids.non_empty(F.col("year"))
        ).alias("date"),
        F.coalesce(
            ids.non_empty(_named(F.col("venue"), "name")), F.col("publicationVenue.name"), F.lit("")
        ).alias("venue"),
        F.coalesce(
            F.filter(
                F.transform("fieldsOfStudy", lambda f: _named(f, "category")), lambda f: F.coalesce(f, F.lit("")) != ""
            ),
            F.array().cast("array<string>"),
        ).alias("categories"),
        F.coalesce("citationCount", F.lit(0)).alias("citation_count"),
        F.coalesce("referenceCount", F.lit(0)).alias("reference_count"),
        F.coalesce("isOpenAccess", F.lit(False)).alias("is_open_access"),
        F.coalesce("openAccessPdf.url", F.lit("")).alias("open_pdf"),
        F.coalesce(_external("doi"), F.lit("")).alias("doi"),
        ingested_at.alias("ingested_at"),
        ids.non_empty(F.col("full_text")).alias("full_text"),
        *([F.col("sections")] if "sections" in rows.columns else []),
    )


def _spans(annotation: Column, text: Column) -> Column:
    """Valid spans of one annotation. Offsets may be strings or numbers."""
    parsed = F.transform(
        F.from_json(annotation, _SPAN),
        lambda s: F.struct(s["start"].try_cast("int").alias("start"), s["end"].try_cast("int").alias("end")),
    )
    return F.filter(
        F.coalesce(parsed, F.array().cast("array<struct<start: int, end: int>>")),
        lambda s: s["start"].isNotNull() & s["end"].isNotNull(),
    )


def _inside(span: Column, text: Column) -> Column:
    return (span["start"] >= 0) & (span["start"] < span["end"]) & (span["end"] <= F.length(text))


def _cut(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def _slices(annotation: Column, text: Column) -> Column:
    kept = F.filter(_spans(annotation, text), lambda s: _inside(s, text))
    return F.transform(kept, lambda s: _cut(text, s["start"], s["end"]))


def _names(annotation: Column, text: Column) -> Column:
    """Trimmed, non-empty names in the order of their offsets."""
    kept = F.array_sort(F.filter(_spans(annotation, text), lambda s: _inside(s, text)))
    return F.filter(
        F.transform(kept, lambda s: F.trim(_cut(text, s["start"], s["end"]))), lambda n: n != ""
    )


def pair_author_names(first: Column, last: Column, whole: Column) -> Column:
    """The i-th first name with the i-th last name, then the leftovers of the longer list.

    Only when both lists are empty the `whole` names are taken.
    """
    n = F.least(F.size(first), F.size(last))
    zipped = F.arrays_zip(F.slice(first, F.lit(1), n).alias("f"), F.slice(last, F.lit(1), n).alias("l"))
    pairs = F.transform(zipped, lambda p: F.concat_ws(" ", p["f"], p["l"]))

    def rest(names: Column) -> Column:
        return F.slice(names, n + 1, F.greatest(F.size(names) - n, F.lit(0)))

    return F.when(
        F.size(first) + F.size(last) > 0, F.concat(pairs, rest(first), rest(last))
    ).otherwise(whole)


def _sections(header: Column, text: Column) -> Column:
    """Each header with the text up to the next header."""
    ordered = F.array_sort(_spans(header, text))

    def section(span: Column, i: Column) -> Column:
        following = F.get(ordered, i + 1)["start"]
        stop = F.greatest(F.coalesce(following, F.length(text)), span["end"])
        return F.struct(
            _inside(span, text).alias("ok"),
            F.trim(_cut(text, span["start"], span["end"])).alias("heading"),
            F.trim(_cut(text, span["end"], stop)).alias("text"),
        )

    kept = F.filter(
        F.transform(ordered, section), lambda s: s["ok"] & ((s["heading"] != "") | (s["text"] != ""))
    )
    return F.transform(kept, lambda s: F.struct(s["heading"].alias("heading"), s["text"].alias("text")))


def reshape_bulk(raw: DataFrame) -> DataFrame:
    """Bulk records, whose fields are offsets into one text, in the shape of `normalise_b`."""
    text = F.coalesce("content.text", F.lit(""))

    def note(name: str) -> Column:
        return F.try_element_at(F.col("content.annotations"), F.lit(name))

    header = F.coalesce(ids.non_empty(note("sectionheader")), note("section_header"))
    prepared = raw.select(
        "*",
        text.alias("_text"),
        _names(note("authorfirstname"), text).alias("_first"),
        _names(note("authorlastname"), text).alias("_last"),
        F.filter(
            F.transform(_slices(note("author"), text), lambda n: F.trim(n)), lambda n: n != ""
        ).alias("_whole"),
    )
    names = pair_author_names(F.col("_first"), F.col("_last"), F.col("_whole"))
    key = F.col("corpusid").cast("string")
    return prepared.select(
        F.col("externalids").alias("externalIds"),
        key.alias("corpusId"),
        key.alias("paperId"),
        F.trim(F.array_join(_slices(note("title"), F.col("_text")), " ")).alias("title"),
        F.trim(F.array_join(_slices(note("abstract"), F.col("_text")), " ")).alias("abstract"),
        F.transform(names, lambda n: F.struct(n.alias("name"))).alias("authors"),
        F.col("publicationdate").alias("publicationDate"),
        "year",
        F.coalesce("venue", F.lit("")).alias("venue"),
        F.lit(None).cast("struct<name: string>").alias("publicationVenue"),
        F.col("fieldsofstudy").alias("fieldsOfStudy"),
        F.col("citationcount").alias("citationCount"),
        F.col("referencecount").alias("referenceCount"),
        F.lit(True).alias("isOpenAccess"),
        F.struct(F.lit("").alias("url")).alias("openAccessPdf"),
        F.col("_text").alias("full_text"),
        _sections(header, F.col("_text")).alias("sections"),
    )


def extract_edges(raw: DataFrame, ingested_at: Column) -> DataFrame:
    """Citation edges of raw corpus records, before normalisation.

    References go out from the record. Where there is none usable, the papers that cite the record
    are taken, with the record as target.
    """
    rows = raw.withColumn("me", _preferred_id()).filter(ids.valid_key(F.col("me")))

    def others(name: str) -> Column:
        found = F.transform(
            name, lambda r: F.coalesce(ids.non_empty(r["paperId"]), ids.non_empty(r["corpusId"]))
        )
        kept = F.filter(found, lambda x: x.isNotNull() & (x != F.col("me")))
        return F.coalesce(kept, F.array().cast("array<string>"))

    rows = rows.select("me", others("references").alias("out"), others("citations").alias("in"))
    chosen = F.when(F.size("out") > 0, F.col("out")).otherwise(F.col("in"))
    linked = unfold(rows, chosen, "other", "me", (F.size("out") > 0).alias("outgoing"))
    return linked.select(
        F.when(F.col("outgoing"), F.col("me")).otherwise(F.col("other")).alias("citing_id"),
        F.when(F.col("outgoing"), F.col("other")).otherwise(F.col("me")).alias("cited_id"),
        ingested_at.alias("ingested_at"),
    )


def normalise_c(raw: DataFrame, ingested_at: Column, source: str = fixed.SOURCES[2]) -> DataFrame:
    """Supplementary records: authors with their first institution, concepts by falling score."""

    def text(column: Column) -> Column:
        return F.coalesce(column, F.lit(""))

    def author(a: Column) -> Column:
        place = F.get(a["institutions"], F.lit(0))
        return F.struct(
            text(a["author"]["display_name"]).alias("name"),
            text(a["author"]["orcid"]).alias("orcid"),
            text(place["display_name"]).alias("institution_name"),
            text(place["country_code"]).alias("institution_country"),
        )

    scored = F.transform(
        F.coalesce("concepts", F.array().cast("array<struct<display_name: string, score: double>>")),
        lambda c, i: F.struct(
            (-F.coalesce(c["score"], F.lit(0.0))).alias("falling"),
            i.alias("i"),
            F.struct(
                text(c["display_name"]).alias("name"), F.coalesce(c["score"], F.lit(0.0)).alias("score")
            ).alias("concept"),
        ),
    )
    return raw.select(
        F.col("requested_id").alias("paper_id"),
        F.lit(source).alias("source"),
        text(F.col("id")).alias("openalex_id"),
        text(F.col("doi")).alias("doi"),
        _text(F.col("title")).alias("title"),
        text(F.col("publication_date")).alias("publication_date"),
        "publication_year",
        F.coalesce("cited_by_count", F.lit(0)).alias("cited_by_count"),
        F.coalesce(
            F.transform("authorships", author),
            F.array().cast(
                "array<struct<name: string, orcid: string, institution_name: string, "
                "institution_country: string>>"
            ),
        ).alias("authors"),
        F.transform(F.array_sort(scored), lambda s: s["concept"]).alias("concepts"),
        F.coalesce("open_access.is_oa", F.lit(False)).alias("is_open_access"),
        text(F.col("open_access.oa_url")).alias("oa_url"),
        ingested_at.alias("ingested_at"),
    )


def split_fulltext(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata without bodies, and the bodies with their secondary keys."""
    sections = (
        F.col("sections") if "sections" in records.columns
        else F.lit(None).cast("array<struct<heading: string, text: string>>")
    )
    bodies = records.filter(ids.valid_key(F.col("full_text"))).select(
        "paper_id",
        ids.preprint_id(F.col("paper_id")).alias("arxiv_id"),
        ids.corpus_id(F.col("paper_id")).alias("corpusid"),
        "full_text",
        sections.alias("sections"),
        "doi", "ingested_at",
    )
    return records.drop("full_text", "sections"), bodies


def enrich_by_id(requested: DataFrame, metadata: DataFrame) -> DataFrame:
    """Requested ids with their metadata; ids without a record drop out, records without id keep
    the requested one. `metadata.lookup_id` holds the form that a batch lookup answers to."""
    asked = requested.select(
        F.col("paper_id").alias("requested_id"), ids.lookup_id(F.col("paper_id")).alias("lookup_id")
    )
    return (
        asked.join(metadata, "lookup_id", "inner")
        .withColumn("paper_id", F.coalesce(ids.non_empty(F.col("paper_id")), F.col("requested_id")))
        .drop("requested_id", "lookup_id")
    )
