"""Fixed values that results depend on. Each list is given as it must match, in its natural order."""

# Source names in order of trust.
SOURCES = ("arxiv", "s2orc", "openalex")

# Categories below a source that hold no paper metadata.
NON_PAPER_CATEGORIES = ("edges", "s2orc_fulltext")

# Shape of a preprint id, without and with version suffix.
PREPRINT_ID = r"^\d{4}\.\d{4,6}$"
PREPRINT_ID_VERSIONED = r"^\d{4}\.\d{4,6}(v\d+)?$"

# Floor of the influence score, and the span above it.
SCORE_FLOOR = 0.15
SCORE_SPAN = 0.85

# Cue phrases of limitation sentences.
LIMITATION_CUES = (
    "limitation", "limited", "future work", "challenge", "constraint", "drawback", "however",
    "we leave", "remain", "bottleneck", "expensive",
)
LIMITATION_MIN_CHARS = 30
SNIPPET_CHARS = 280

# Cue phrases for and against an idea.
SUPPORT_CUES = ("improve", "state-of-the-art", "outperform", "effective", "robust", "gain")
CAUTION_CUES = ("limited", "limitation", "challenge", "however", "future work", "expensive")

# Limitation themes and their phrases.
THEMES = {
    "data_scarcity": ("limited data", "small dataset", "data scarcity", "insufficient data"),
    "compute_cost": ("computationally expensive", "high compute", "costly", "resource-intensive"),
    "generalization": (
        "does not generalize", "domain shift", "out-of-distribution", "distribution shift",
    ),
    "evaluation_scope": (
        "limited evaluation", "few benchmarks", "evaluation is limited", "single dataset",
    ),
    "interpretability": (
        "lack interpretability", "black-box", "hard to interpret", "explainability",
    ),
}

# Strings that are no entities.
ENTITY_STOP = (
    "pad", "me", "ra", "mi", "pa", "op", "cha", "ar", "co", "na", "re", "ll", "lo", "ld", "ec",
    "the", "and", "for", "its", "via", "not", "are", "was", "one", "two", "use", "new", "all",
    "our", "how", "may", "but", "mor", "bas", "pro", "com", "res", "pre", "tra", "inp", "out",
    "mod", "dat", "app", "sys",
)

# Section headings that name methods, data and tasks.
PRIORITY_HEADINGS = (
    "introduction", "method", "methodology", "experiment", "approach", "model", "dataset",
    "evaluation", "results", "system", "framework",
)

# Tag types of a general tagger and the entity types they stand for; other tags are dropped.
TAG_TYPES = {"ORG": "METHOD", "MISC": "TASK"}
ENTITY_TYPES = ("METHOD", "DATASET", "TASK")
ENTITY_CONFIDENCE = 0.80
ENTITY_PUNCTUATION = ".,;:!?()[]{}\"'"

# Weights of the five signals of the reading list.
SIGNAL_WEIGHTS = {
    "relevance": 0.35,
    "influence": 0.25,
    "recency": 0.15,
    "representativeness": 0.15,
    "diversity": 0.10,
}
RECENCY_DAYS = 365

# Reading categories in the order that decides ties.
READING_CATEGORIES = ("foundational", "representative", "emerging", "contrasting")

# Sentence classes and the list each one fills.
SENTENCE_CLASSES = {
    "METHODOLOGY": "methodological_details",
    "LIMITATION": "limitations",
    "CONTRIBUTION": "contributions",
    "EVALUATION": "evaluation_context",
}
SENTENCE_CONFIDENCE = 0.75
SENTENCES_PER_CLASS = 5

# Growth limits of trend signals.
EMERGING_GROWTH = 0.25
DECLINING_GROWTH = -0.15

# English stop words of the public Lucene analyser.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
)

# Okapi BM25 constants.
BM25_K1 = 1.2
BM25_B = 0.75
