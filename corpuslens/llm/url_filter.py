"""URL rules by Bloom filter cascades over all keys that the corpus can ask for: exact membership without a join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.common import ascii_lower, table
from corpuslens.session import cut_lineage

#: Rules of the registered query: verdict, host, path prefix.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _probes(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    """k positions per key; each level mixes the two hashes anew."""
    with np.errstate(over="ignore"):
        mix = h1 ^ (h2 * np.uint64(2 * level + 1))
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            mix = (mix ^ (mix >> np.uint64(shift))) * np.uint64(factor)
        step = (h2 ^ (mix >> np.uint64(29))) | np.uint64(1)
        return (mix[:, None] + np.arange(k, dtype=np.uint64) * step[:, None]) % np.uint64(bits)


class Cascade:
    """Levels of bits. Level 1 holds the listed keys, level 2 the false positives of level 1, and so on in turn."""

    def __init__(self, levels: list[tuple[np.ndarray, int, int]]):
        self.levels = levels

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words, bits, k = self.levels[level]
        p = _probes(h1, h2, level, bits, k)
        return ((words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)).all(axis=1)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe that the cascade was built over."""
        answer = np.zeros(len(h1), bool)
        still = np.arange(len(h1))
        for level in range(len(self.levels)):
            answer[still] = level % 2 == 0
            out = ~self.passes(level, h1[still], h2[still])
            answer[still[out]] = level % 2 == 1
            still = still[~out]
        return answer

    def size(self) -> int:
        return sum(w.nbytes for w, _, _ in self.levels)


def _positions(level: int, bits: int, k: int):
    @F.pandas_udf("array<long>")
    def positions(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(list(_probes(h1.to_numpy().view(np.uint64), h2.to_numpy().view(np.uint64), level, bits, k).view(np.int64)))

    return positions


def build_cascade(keys: DataFrame, max_bytes: int, rate: float = 0.02) -> Cascade | None:
    """Cascade over `keys` (h1, h2, listed): one row per key of the universe.

    Bits are set and merged by word in Spark; only the filter's words reach the driver. None if the filter
    would need more than `max_bytes`, which the caller must answer in another way.
    """
    spark, levels = keys.sparkSession, []
    inside, outside = keys.filter("listed"), keys.filter("not listed")
    while True:
        n = inside.count()
        if n == 0 and levels:
            return Cascade(levels)
        k = max(1, round(-math.log2(rate)))
        bits = 64 * max(1, math.ceil(n * k / math.log(2) / 64))
        if sum(w.nbytes for w, _, _ in levels) + bits // 8 > max_bytes:
            return None
        at = F.explode(_positions(len(levels), bits, k)("h1", "h2")).alias("p")
        words = inside.select(at).groupBy(F.shiftright("p", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v")
        ).collect()  # bounded by max_bytes
        block = np.zeros(bits // 64, np.int64)
        for row in words:
            block[row["w"]] = row["v"]
        levels.append((block.view(np.uint64), bits, k))
        if len(levels) > 64:
            raise RuntimeError("the cascade does not end: two keys share both hashes")
        shared, level, rate = spark.sparkContext.broadcast(list(levels)), len(levels) - 1, 0.5

        def wrong(batches: Iterator[pd.DataFrame], shared=shared, level=level) -> Iterator[pd.DataFrame]:
            cascade = Cascade(shared.value)
            for b in batches:
                yield b[cascade.passes(level, b["h1"].to_numpy().view(np.uint64), b["h2"].to_numpy().view(np.uint64))]

        inside, outside = cut_lineage(outside.mapInPandas(wrong, keys.schema)), inside


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without `://` or for a null."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)\z", 1)
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge_urls(
    pages: DataFrame, rules: DataFrame, path_lengths: list[int] | None = None, otherwise: str = "allow",
    max_filter_bytes: int = 64 << 20,
) -> DataFrame:
    """`pages` with host, path, rule and verdict.

    `rules` (verdict, host, path) fit their host and its subdomains where the path starts with the rule's. The
    keys a URL can ask for are its host and each parent domain with each prefix of its path that is as long as some
    rule's. Two cascades over the distinct keys of the corpus (blocked keys, allowed keys) say exactly which are
    listed; the longest listed key is the rule, and a key listed both ways blocks. Without a listed key the verdict is
    `otherwise` and the rule is null. The filters travel to the tasks only below `max_filter_bytes`; above, the keys
    are joined. Null urls have an empty host and path; repeated rows and rules change nothing; an empty table
    gives none. Own columns of the same names are replaced.
    """
    host, path = split_url(F.col("url"))
    rules = rules.select(
        (F.col("verdict") == "block").alias("block"), F.concat(ascii_lower(F.col("host")), "path").alias("key"),
        F.length("path").alias("len"),
    ).filter("key is not null")
    lengths = path_lengths or sorted(r[0] for r in rules.select("len").distinct().collect())  # a few small numbers
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(F.array(*[F.lit(x) for x in lengths]).cast("array<int>"), lambda x: F.length("path") >= x)
    asked = F.flatten(F.transform(domains, lambda d: F.transform(fits, lambda x: F.concat(d, F.substring(F.col("path"), F.lit(1), x)))))
    parted = pages.withColumns({"host": host, "path": path})
    # The universe: few distinct (host, path prefix) pairs, then their keys.
    heads = parted.select("host", F.substring(F.col("path"), 1, max([*lengths, 0])).alias("path")).distinct()
    keys = heads.select(F.explode(asked).alias("key"), F.lit(0).alias("b"), F.lit(0).alias("a"), F.lit(1).alias("u")).union(
        rules.select("key", F.col("block").cast("int"), (~F.col("block")).cast("int"), F.lit(0))
    ).groupBy("key").agg(*[F.max(c).alias(c) for c in "bau"]).filter("u = 1")
    h1, h2 = _hashes(F.col("key"))
    keys = cut_lineage(keys.select("key", h1.alias("h1"), h2.alias("h2"), (F.col("b") == 1).alias("b"), (F.col("a") == 1).alias("a")))
    cascades = [build_cascade(keys.select("h1", "h2", F.col(c).alias("listed")), max_filter_bytes) for c in "ba"]
    longest = F.reverse(F.array_sort(F.transform(asked, lambda k: F.struct(F.length(k).alias("n"), k.alias("key")))))
    candidates = F.transform(longest, lambda s: s["key"])
    if None in cascades:
        return _judge_by_join(parted.withColumn("_asked", candidates), keys, otherwise)
    shared = pages.sparkSession.sparkContext.broadcast([c.levels for c in cascades])

    @F.pandas_udf("array<byte>")
    def status(first: pd.Series, second: pd.Series) -> pd.Series:
        """2 blocked, 1 allowed, 0 not listed, for each key of each row."""
        sizes = first.map(len).to_numpy()
        if sizes.sum() == 0:
            return pd.Series([np.zeros(0, np.int8)] * len(first))
        a, b = (np.concatenate(x.to_numpy()).astype(np.int64).view(np.uint64) for x in (first, second))
        block, allow = (Cascade(levels).listed(a, b) for levels in shared.value)
        return pd.Series(np.split(np.where(block, 2, allow).astype(np.int8), np.cumsum(sizes)[:-1]))

    asked_once = parted.withColumn("_asked", candidates)
    judged = asked_once.withColumn("_status", status(
        F.transform("_asked", lambda k: _hashes(k)[0]), F.transform("_asked", lambda k: _hashes(k)[1])
    ))
    first = F.get(F.filter(F.arrays_zip("_asked", "_status"), lambda z: z["_status"] > 0), F.lit(0))
    return judged.withColumn("_first", first).withColumns({
        "rule": F.col("_first._asked"),
        "verdict": F.when(F.col("_first._status") == 2, "block").when(F.col("_first._status") == 1, "allow").otherwise(otherwise),
    }).drop("_asked", "_status", "_first")


def _judge_by_join(parted: DataFrame, keys: DataFrame, otherwise: str) -> DataFrame:
    """For lists whose filter is too large to send: the distinct heads meet the listed keys in a join."""
    named = keys.filter("a or b").select("key", F.col("b").alias("_block"))
    asked = parted.select("_asked").distinct()
    best = asked.select("_asked", F.explode("_asked").alias("key")).join(named, "key").groupBy("_asked").agg(
        F.max(F.struct(F.length("key"), F.col("key").alias("key"), F.col("_block").alias("block"))).alias("_best")
    )
    return parted.join(best, "_asked", "left").withColumns({
        "rule": F.col("_best.key"),
        "verdict": F.when(F.col("_best.block"), "block").when(~F.col("_best.block"), "allow").otherwise(otherwise),
    }).drop("_asked", "_best")


def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    rules = spark.createDataFrame(list(RULES), "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_FITS = " ".join(
    f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p}'"
    for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
)
SQL = f"""with parts as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r
    from pages),
split as (select page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from parts),
ruled as (select *, case {_FITS} end as rule from split)
select page_id, host, path, rule,
    case when rule in ({', '.join(f"'{h}{p}'" for v, h, p in RULES if v == 'block')}) then 'block' else 'allow' end as verdict from ruled"""
