"""Explicit schemas: a field that a record lacks reads as a typed NULL."""

from __future__ import annotations

CORRUPT = "_corrupt_record"


def _struct(*fields: str) -> str:
    """DDL text of a schema, which needs no running session."""
    return ", ".join(fields)


def with_corrupt(schema: str) -> str:
    """The same schema plus the column that keeps malformed lines."""
    return f"{schema}, {CORRUPT} string"


RAW_A = _struct(
    "paper_id string", "source string", "title string", "abstract string", "authors array<string>",
    "submitted_date string", "updated_date string", "primary_category string",
    "all_categories array<string>", "pdf_url string", "arxiv_url string", "queried_category string",
    "ingested_at string",
)

SECTIONS = "array<struct<heading: string, text: string>>"

# One schema for every record kind found below the corpus source: metadata, edges and full text.
RAW_B = _struct(
    "paper_id string", "source string", "s2_paper_id string", "title string", "abstract string",
    "authors array<string>", "date string", "venue string", "categories array<string>",
    "citation_count int", "reference_count int", "is_open_access boolean", "open_pdf string",
    "doi string", "ingested_at string", "full_text string", f"sections {SECTIONS}",
    "citing_id string", "cited_id string",
)

RAW_C = _struct(
    "paper_id string", "source string", "openalex_id string", "doi string", "title string",
    "abstract string", "publication_date string", "publication_year int", "cited_by_count int",
    "authors array<struct<name: string, orcid: string, institution_name: string, institution_country: string>>",
    "concepts array<struct<name: string, score: double>>", "is_open_access boolean", "oa_url string",
    "ingested_at string",
)

TOPIC_ROWS = _struct(
    "paper_id string", "topic_cluster_id int", "topic_cluster string", "umap_x float", "umap_y float"
)

ENTITY_ROWS = _struct(
    "paper_id string", "methods array<string>", "datasets array<string>", "tasks array<string>"
)

# Records as the three services return them, before normalisation.
RESULT_A = _struct(
    "short_id string", "title string", "summary string", "authors array<struct<name: string>>",
    "published timestamp", "updated timestamp", "primary_category string", "categories array<string>",
    "links array<struct<title: string, href: string>>", "entry_id string", "queried_category string",
)

RESULT_B = _struct(
    "externalIds map<string,string>", "corpusId string", "paperId string",
    "title string", "abstract string", "authors array<struct<name: string>>",
    "publicationDate string", "year string", "venue string", "publicationVenue struct<name: string>",
    "fieldsOfStudy array<string>", "citationCount int", "referenceCount int", "isOpenAccess boolean",
    "openAccessPdf struct<url: string>", "full_text string",
    "references array<struct<paperId: string, corpusId: string>>",
    "citations array<struct<paperId: string, corpusId: string>>",
)

BULK_B = _struct(
    "corpusid bigint", "externalids map<string,string>",
    "content struct<text: string, annotations: map<string,string>>",
    "publicationdate string", "year string", "venue string", "fieldsofstudy array<string>",
    "citationcount int", "referencecount int",
)

RESULT_C = _struct(
    "requested_id string", "id string", "doi string", "title string", "publication_date string",
    "publication_year int", "cited_by_count int",
    "authorships array<struct<author: struct<display_name: string, orcid: string>, "
    "institutions: array<struct<display_name: string, country_code: string>>>>",
    "concepts array<struct<display_name: string, score: double>>",
    "open_access struct<is_oa: boolean, oa_url: string>",
)

# Curated tables. `papers` lists its partition column last.
TABLES = {
    "papers": """
        paper_id STRING COMMENT 'key of the consolidated record',
        title STRING, abstract STRING, authors ARRAY<STRING>,
        submitted_date DATE COMMENT 'first submission', updated_date DATE COMMENT 'latest revision',
        primary_category STRING, categories ARRAY<STRING>,
        citation_count INT, reference_count INT, influential_citation_count INT,
        topic_cluster_id INT COMMENT '-1 marks an outlier', topic_cluster STRING,
        umap_x FLOAT, umap_y FLOAT,
        methods ARRAY<STRING>, datasets ARRAY<STRING>, tasks ARRAY<STRING>,
        source STRING, ingested_at TIMESTAMP, s2_paper_id STRING COMMENT 'alternate key used by edges',
        ingest_year_month STRING COMMENT 'yyyy-MM or unknown'""",
    "trends": """
        grain STRING COMMENT 'category or topic',
        primary_category STRING, topic_cluster STRING, topic_cluster_id INT, year_month STRING,
        paper_count BIGINT, avg_citation_count DOUBLE, avg_pagerank DOUBLE""",
    "citation_edges": "citing_id STRING, cited_id STRING, source STRING",
    "pagerank_scores": "paper_id STRING, pagerank_score DOUBLE",
    "paper_fulltext": f"""
        paper_id STRING, arxiv_id STRING, corpusid STRING, full_text STRING,
        sections {SECTIONS}, doi STRING, ingested_at STRING""",
}
