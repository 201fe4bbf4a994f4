"""Text expressions on whole documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import text as tx
from corpuslens.operators import entities
from registry.core import query

SPACE = r"\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def squeeze_sql(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[{SPACE}]+', ' ', 'g'), ' ')"


def clean_sql(text: str, normal: bool) -> str:
    rules = [
        (r"(?s)\$\$.*?\$\$", " "), (r"(?s)\\\[.*?\\\]", " "), (r"\$[^$]*?\$", " "), (r"(?s)\\\(.*?\\\)", " "),
        *[(rf"\\{m}\{{([^}}]*)\}}", r"\1") for m in ("textbf", "textit", "emph", "underline", "text")],
        (r"\\href\{[^}]*\}\{([^}]*)\}", r"\1"),
        *[(rf"\\{m}\{{[^}}]*\}}", " ") for m in ("cite", "ref", "label", "footnote", "url", "includegraphics")],
        (r"\\[a-zA-Z]+\b\*?", " "), (r"[{}]", ""),
        (rf"https?://[^{SPACE}]+", " "), (rf"www\.[^{SPACE}]+", " "),
    ]
    for pattern, new in rules:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    if normal:
        text = f"nfc_normalize({text})"
    text = rf"regexp_replace({text}, '[\x00-\x08\x0b-\x1f\x{{7f}}-\x{{9f}}\p{{Cf}}]', '', 'g')"
    return squeeze_sql(text)


def sentences_sql(text: str) -> str:
    names = "|".join(a.replace(".", r"\.") for a in tx.ABBREVIATIONS)
    guarded = rf"regexp_replace({text}, '\b({names})\.(\s)', '\1' || chr(1) || '\2', 'g')"
    cut = rf"string_split(regexp_replace({guarded}, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31))"
    return (
        f"list_filter(list_transform({cut}, lambda s: trim(translate(s, chr(1), '.'), ' ')), lambda s: s <> '')"
    )


STOPS = ", ".join(f"'{w}'" for w in fixed.STOP_WORDS)


def words_sql(text: str, stops: bool = True) -> str:
    dropped = f" and t not in ({STOPS})" if stops else ""
    return rf"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> ''{dropped})"


@query(sql=f"select page_id, {clean_sql('html', True)} as clean from pages")
def clean_pages(v):
    return tx.clean_text(v.table("pages"), "html").select("page_id", "clean")


@query(sql=f"select doc_id, {clean_sql('text', False)} as clean from documents")
def clean_documents(v):
    return tx.clean_text(v.table("documents"), "text").select("doc_id", "clean")


MARKUP = (
    "concat('Let $a_1$ be ', split_part(text, ' ', 2), ' in \\\\textbf{', lang, '} and $$x\n+y$$ \\\\emph{', source, "
    "'} \\\\cite{k} \\\\href{http://u.v}{', split_part(text, ' ', 3), '} \\\\alpha* \\\\[z\\\\] \\\\(q\\\\) ', text)"
)


@query(sql=f"select doc_id, {clean_sql('m', False)} as clean from (select doc_id, "
           + MARKUP.replace("\\\\", "\\").replace("\n", "' || chr(10) || '") + " as m from documents)")
def clean_markup(v):
    """Formulas, formatting macros, links and references around every document."""
    rows = v.table("documents").select("doc_id", F.expr(MARKUP).alias("m"))
    return tx.clean_text(rows, "m").select("doc_id", "clean")


@query(sql=f"""select doc_id, sentence, pos from (select doc_id, unnest({sentences_sql('text')}) as sentence,
    generate_subscripts({sentences_sql('text')}, 1) - 1 as pos from documents)""")
def split_sentences(v):
    return tx.split_sentences(v.table("documents"), "text", "doc_id")


@query(sql=f"""select doc_id, array_to_string({sentences_sql(clean_sql('text', False))}, ' ') as text from documents""")
def rejoin_sentences(v):
    return tx.clean_text(v.table("documents"), "text").select("doc_id", tx.rejoin_sentences(F.col("clean")).alias("text"))


@query(sql=rf"""select doc_id, array_to_string(list_transform(list_filter(list_transform(
    string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda s: trim(s, ' ')),
    lambda s: length(s) >= 30 and (contains(lower(s), 'the ') or contains(lower(s), 'und ') or contains(lower(s), 'que')))[1:3],
    lambda s: substr(s, 1, 280)), '|') as found from documents""")
def cue_sentences(v):
    found = tx.cue_sentences(F.col("text"), ("the ", "und ", "que"), 3)
    return v.table("documents").select("doc_id", F.array_join(found, "|").alias("found"))


@query(sql=f"""select lang, cast(sum(len({words_sql('text', False)})) as bigint) as words,
    cast(sum(len({words_sql('text')})) as bigint) as content_words from documents group by 1""")
def count_words(v):
    return v.table("documents").groupBy("lang").agg(
        F.sum(F.size(tx.words(F.col("text")))).cast("bigint").alias("words"),
        F.sum(F.size(tx.content_words(F.col("text")))).cast("bigint").alias("content_words"),
    )


@query(sql=f"select item_id, md5({squeeze_sql('lower(text)')}) as query_key from benchmark")
def query_keys(v):
    return v.table("benchmark").select("item_id", tx.query_key(F.col("text")).alias("query_key"))


@query(sql=f"""with l as (select conv_id, turn, {squeeze_sql('lower(text)')} as t from conversations)
    select conv_id, turn, trim(t, '.,;:!?()[]{{}}"''') as entity from l""")
def normalise_entities(v):
    return v.table("conversations").select(
        "conv_id", "turn", tx.normalise_entity(F.col("text")).alias("entity")
    )


@query("fulltext", sql="""select paper_id, array_to_string(list_filter((
    list_concat(list_filter(lines, lambda l: contains(lower(split_part(l, ' ', 1)), 'the') or contains(lower(split_part(l, ' ', 1)), 'le')),
    list_filter(lines, lambda l: not (contains(lower(split_part(l, ' ', 1)), 'the') or contains(lower(split_part(l, ' ', 1)), 'le')))))[1:5],
    lambda l: l <> ''), ' ') as text from fulltext""")
def prioritise_sections(v):
    text = entities.prioritise_sections(F.col("sections"), F.col("full_text"), headings=("the", "le"))
    return v.fulltext.select("paper_id", text.alias("text"))


_MARKED = "replace(replace(text, 'en', 'e' || chr(769)), 'on', 'n' || chr(771))"


@query(sql=f"select doc_id, {clean_sql(_MARKED, True)} as clean from documents")
def clean_decomposed(v):
    """Letters written with combining marks come out composed, whatever the text held before."""
    marked = F.replace(F.replace("text", F.lit("en"), F.lit("e\u0301")), F.lit("on"), F.lit("n\u0303"))
    return tx.clean_text(v.table("documents"), marked).select("doc_id", "clean")
