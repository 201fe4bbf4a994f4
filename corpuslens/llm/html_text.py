"""Main text of web pages by consensus: each page's containers are scored, hosts vote on generalised tag-class paths, and
pages are read again along the path that won."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import table
from corpuslens.session import cut_lineage

#: Elements whose content is never main text.
SKIPPED = frozenset(
    "nav footer aside form script style noscript template iframe svg math canvas button select option textarea input "
    "object embed audio video dialog menu head title".split()
)
#: First or last words of a class or id that mark such content.
KINDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr newsletter comment comments disqus "
    "respond sidebar nav navbar navigation breadcrumb breadcrumbs popup modal pagination pager footer skip".split()
)
#: Words that mark it as the last word, or as the first if only helpers follow.
LOOSE_KINDS = frozenset(
    "share sharing social related recommended notice banner promo menu widget widgets toolbar subscribe masthead replies".split()
)
HELPERS = frozenset(
    "area articles bar block box buttons container content form group icons inner items left link links list posts right row "
    "section signup slot stories top bottom wrap wrapper".split()
)
#: A header is skipped if it is the page's; articles have headers of their own.
PAGE_WORDS = frozenset("site page main top global header the".split())
#: A name with one of these words tells of an element's surroundings.
ABOUT = frozenset("has with no without".split())
#: Elements that hold the page's content, whatever their class or id says about its surroundings.
HOLDERS = frozenset("html body main article".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: An opening tag that ends an open one of the same line.
CLOSES = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
#: Words in the class of an element that holds the text.
CONTENT_WORDS = frozenset("content entry post article story".split())
CONTAINERS = frozenset("article main section div td body".split())
#: A tag ends at its first > outside quotes; a < outside quotes shows that it was none, so each character is looked at a
#: fixed number of times.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript)\b[^<>]*+>.*?(?:</\1\s*+>|\Z)|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^<>]*+>", re.S | re.I,
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
BARRIERS = ("ul", "ol", "dl", "table", "div", "article", "section", "main", "body")


def marks_boilerplate(name: str) -> bool:
    """Whether one class or id names content that is no main text, by its first and last word."""
    words = [w for w in re.split(r"[-_]+", re.sub(r"\d+", "", name.lower())) if w]
    if not words or ABOUT & set(words):
        return False
    if words[-1] == "header":
        return set(words) <= PAGE_WORDS
    return words[0] in KINDS or words[-1] in KINDS or words[-1] in LOOSE_KINDS or (
        words[0] in LOOSE_KINDS and all(w in HELPERS for w in words[1:])
    )


@lru_cache(1 << 14)
def _named(names: str) -> bool:
    return any(marks_boilerplate(n) for n in names.split())


def _step(tag: str, attributes: str, by_name: bool = True) -> tuple[str, bool]:
    """Generalised path step, as tag and sorted classes without their numbers, and whether the content is left out; by the
    words of its class and id too, if `by_name`."""
    named = {k.lower(): v.strip("\"'") for k, v in NAMES.findall(attributes)} if attributes else {}
    classes = sorted({re.sub(r"\d+", "", c) for c in named.get("class", "").split()} - {""})
    marked = by_name and tag not in HOLDERS and _named(f"{named.get('class', '')} {named.get('id', '')}")
    skipped = tag in SKIPPED or marked or named.get("role", "").lower() in ("navigation", "banner", "contentinfo", "complementary")
    return ".".join([tag, *classes]), skipped


class Page(NamedTuple):
    """Elements in page order, as their parent's number (-1 for none) and step, and blocks of text: element, text and
    characters inside links. Inline elements are no elements here."""

    parents: list[int]
    steps: list[str]
    blocks: list[tuple[int, str, int]]


def _read(page: str, by_name: bool) -> Page:
    """One walk; what is open is known by tag and place, so no step looks through the stack."""
    parents, steps, blocks, text = [], [], [], []
    stack: list[tuple[str, int, bool]] = []  # tag, element (-1 for inline ones), skipped
    places: dict[str, list[int]] = defaultdict(list)  # of each open tag in the stack
    walls: list[int] = []  # places of the elements that aren't inline
    linked = skipping = at = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            blocks.append((stack[walls[-1]][1] if walls else -1, joined, linked))
        text.clear()
        linked = 0

    def close(k: int) -> None:
        nonlocal skipping
        if walls and walls[-1] >= k:
            flush()
        while len(stack) > k:
            tag, element, skipped = stack.pop()
            places[tag].pop()
            skipping -= skipped
            if element >= 0:
                walls.pop()

    def last(*tags: str) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=-1)

    def add(part: str) -> None:
        nonlocal linked
        if part and not skipping:
            text.append(part)
            if places["a"]:
                linked += len(part)

    for m in TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        wall = walls[-1] if walls else -1
        if m[2]:
            k = last(tag)
            if k >= 0 and (tag not in INLINE or k > wall):
                close(k)
            elif tag == "p":
                flush()
            continue
        if tag not in INLINE:
            flush()
            if tag in ENDS_PARAGRAPH and 0 <= last("p") == wall:
                close(wall)
            if tag in CLOSES and last(*CLOSES[tag]) > last(*BARRIERS):
                close(last(*CLOSES[tag]))
        if tag in VOID or m[4].rstrip().endswith("/"):
            continue
        step, skipped = _step(tag, m[4], by_name)
        if tag == "header" and not places["article"] and not places["main"]:
            skipped = True
        element = -1
        if tag not in INLINE:
            element = len(parents)
            parents.append(stack[walls[-1]][1] if walls else -1)
            steps.append(step)
            walls.append(len(stack))
        places[tag].append(len(stack))
        stack.append((tag, element, skipped))
        skipping += skipped
    add(page[at:])
    flush()
    return Page(parents, steps, blocks)


def read_page(page: str) -> Page:
    """Elements and blocks of text in page order.

    Skipped content is left out, tolerant of missing end tags; references are decoded and white space is folded. A page
    that has no text left is read again without the rules on classes and ids. Time grows with the length of the page,
    however deep its elements are.
    """
    found = _read(page, True)
    return found if found.blocks else _read(page, False)


def score_containers(page: Page) -> dict[int, float]:
    """Score of each container that holds text, by its element.

    A block lends its unlinked text to its containers: whole to the nearest, half as much to each one further out; what an
    article or main element holds counts double. What children have is handed up once.
    """
    held, scores = [0.0] * len(page.parents), {}
    for element, text, linked in page.blocks:
        if element >= 0:
            worth = max(0, len(text) - linked) * (1 + min(2, text.count(",") / 10)) * (1 - linked / max(1, len(text) + linked))
            held[element] += worth
            scores[element] = 0.0
    touched = [e in scores for e in range(len(held))]
    scores.clear()
    for e in range(len(held) - 1, -1, -1):
        if not touched[e]:
            continue
        tag, worth = page.steps[e].split(".", 1)[0], held[e]
        if tag in CONTAINERS:
            scores[e] = worth * (2 if tag in ("article", "main") else 1)
            worth /= 2
        if page.parents[e] >= 0:
            held[page.parents[e]] += worth
            touched[page.parents[e]] = True
    return scores


def path_of(page: Page, element: int) -> str:
    steps = []
    while element >= 0:
        steps.append(page.steps[element])
        element = page.parents[element]
    return "/".join(reversed(steps))


def lifted(page: Page, element: int) -> int:
    """The nearest element around a container that says it holds the text: an article or main, else one with such a class,
    else a section, else the container."""
    chain, at = [], element
    while at >= 0:
        chain.append((at, page.steps[at].split(".")))
        at = page.parents[at]
    for fits in (
        lambda words: words[0] in ("article", "main"),
        lambda words: words[0] in CONTAINERS and words[0] != "body" and any(CONTENT_WORDS & set(re.split("[-_]+", w.lower())) for w in words[1:]),
        lambda words: words[0] == "section",
    ):
        found = next((e for e, words in chain if fits(words)), None)
        if found is not None:
            return found
    return element


def best_path(page: Page) -> tuple[str, float] | None:
    """Path of the element that the best container is lifted to, and the container's share of all scores; of equal scores
    the larger path counts."""
    scores = score_containers(page)
    total, most = sum(scores.values()), max(scores.values(), default=0.0)
    if not total:
        return None
    return max(path_of(page, lifted(page, e)) for e, s in scores.items() if s == most), most / total


def main_text(page: Page, path: str | None) -> str:
    """Text of all containers on `path`; where the page has none, of its own best container, else of the page."""
    chosen = _inside(page, path.split("/")) if path else set()
    texts = [t for e, t, _ in page.blocks if e in chosen]
    if not texts:
        scores = score_containers(page)
        if scores:
            depth: list[int] = []
            for parent in page.parents:
                depth.append(depth[parent] + 1 if parent >= 0 else 0)
            best = max(scores, key=lambda e: (scores[e], -depth[e], -e))
            chosen = _below(page, {lifted(page, best)})
            texts = [t for e, t, _ in page.blocks if e in chosen]
        else:
            texts = [t for _, t, _ in page.blocks]
    return " ".join(texts)


def _below(page: Page, tops: set[int]) -> set[int]:
    """The elements `tops` and all in them."""
    inside = set(tops)
    for e, parent in enumerate(page.parents):
        if parent in inside:
            inside.add(e)
    return inside


def _inside(page: Page, steps: list[str]) -> set[int]:
    """All elements in containers whose path is `steps`."""
    matched: list[int] = []  # steps that the path to an element has in common, or -1
    for step, parent in zip(page.steps, page.parents, strict=True):
        k = matched[parent] if parent >= 0 else 0
        matched.append(k + 1 if 0 <= k < len(steps) and steps[k] == step else -1)
    return _below(page, {e for e, k in enumerate(matched) if k == len(steps)})


def extract(pages: DataFrame) -> DataFrame:
    """`pages` (url, html) with `main_path`, the path that won on the host, and `text`.

    Each page votes for the path of its best container with that container's share of the page's scores; hosts add votes
    up in Spark, the heaviest path wins, ties go to the smaller path. A null or empty html has an empty text and no
    vote; a null url or one without a host belongs to the host ''. Repeated rows vote each and are read alike. Other
    columns stay, own columns of the same names are replaced; an empty table gives none.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit("")))
    rows = pages.drop("main_path", "text").withColumn("_host", host)

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            votes = []
            for at, page in zip(b["_host"], b["html"], strict=True):
                best = best_path(read_page(page or ""))
                if best:
                    votes.append((at, best[0], round(1000 * best[1])))
            yield pd.DataFrame(votes, columns=["_host", "path", "votes"])

    votes = rows.select("_host", "html").mapInPandas(vote, "_host string, path string, votes long").groupBy("_host", "path").agg(
        F.sum("votes").alias("votes")
    )
    winners = cut_lineage(votes.groupBy("_host").agg(F.min(F.struct(-F.col("votes"), "path")).alias("w")).select(
        "_host", F.col("w.path").alias("main_path")
    ))

    @F.pandas_udf(T.StringType())
    def read(page: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([main_text(read_page(x or ""), p) for x, p in zip(page, path, strict=True)], dtype=object)

    return rows.join(winners, "_host", "left").withColumn("text", read("html", "main_path")).drop("_host")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. Nulls, empty and long pages, repeated rows and empty tables as in `extract`."""
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
