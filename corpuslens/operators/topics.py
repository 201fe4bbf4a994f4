"""Topic modelling as data work: vectors, coordinates, density clusters and topic words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import text as tx
from corpuslens.operators.numbering import numbered
from corpuslens.session import cut_lineage

NOISE = -1


def hashed_weights(texts: DataFrame, key: str = "paper_id", text: str = "text", dims: int = 256) -> DataFrame:
    """(key, place, value): the tf-idf weights of each text's words at `dims` places, of length 1 together.

    A word's place is the number of the first 32 bits of its md5; its weight is ln((n + 1) / (df + 1)) for each time it stands,
    with n texts of which df have the place.
    """
    place = (F.conv(F.left(F.md5("word"), F.lit(8)), 16, 10).cast("long") % dims).cast("int")
    words = tx.unfold(texts, tx.content_words(F.col(text)), "word", key)
    counts = words.groupBy(key, place.alias("place")).agg(F.count(F.lit(1)).alias("tf"))
    n = texts.agg(F.count(F.lit(1)).alias("n")).scalar()
    rarity = counts.groupBy("place").agg(F.ln((n + 1) / (F.count(F.lit(1)) + 1)).alias("idf"))
    weighted = counts.join(rarity, "place").select(key, "place", (F.col("tf") * F.col("idf")).alias("w"))
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms.filter("norm > 0"), key).select(key, "place", (F.col("w") / F.col("norm")).alias("value"))


def encode_texts(texts: DataFrame, key: str = "paper_id", text: str = "text", dims: int = 256) -> DataFrame:
    """Unit tf-idf vectors over hashed words: the built-in encoder. A text without words has zeros; `key` is unique."""
    found = hashed_weights(texts, key, text, dims).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("at")
    )
    value = lambda i: F.coalesce(F.try_element_at("at", i.cast("int")), F.lit(0.0)).cast("float")
    return texts.select(key).join(found, key, "left").select(
        key, F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), value).alias("embedding")
    )


def encode_with_model(
    texts: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], key: str = "paper_id",
    text: str = "text",
) -> DataFrame:
    """Vectors of a user's encoder, loaded once per task and fed whole Arrow batches."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for batch in batches:
            vectors = encode(batch[text].tolist())
            yield pd.DataFrame({key: batch[key], "embedding": [np.asarray(v, "float32") for v in vectors]})

    return texts.select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<float>")


def project_2d(vectors: DataFrame, key: str = "paper_id") -> DataFrame:
    """First two principal components of the unit vectors.

    Spark sums the d x d covariance over all tasks; only that matrix reaches the driver. Each axis
    points to where its largest loading is positive, so the signs are fixed.
    """
    unit = Normalizer(inputCol="v", outputCol="u").transform(
        vectors.select(key, array_to_vector("embedding").alias("v"))
    )
    model = PCA(k=2, inputCol="u", outputCol="p").fit(unit)
    axes = model.pc.toArray()
    signs = [1.0 if axis[np.abs(axis).argmax()] >= 0 else -1.0 for axis in axes.T]
    p = vector_to_array("p")
    return model.transform(unit).select(
        key, (F.get(p, F.lit(0)) * signs[0]).alias("umap_x"), (F.get(p, F.lit(1)) * signs[1]).alias("umap_y")
    )


def connected(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: (id, component).

    Every round takes the smallest label among the neighbours and then follows that label one step
    (pointer jumping), so long chains close in few rounds. The loop ends when no label changes.
    """
    edges = cut_lineage(edges)
    labels = cut_lineage(nodes.select("id", F.col("id").alias("component")))
    while True:
        near = edges.join(labels.select(F.col("id").alias("dst"), "component"), "dst").groupBy(
            F.col("src").alias("id")
        ).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id", "left").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("mid")
        )
        jump = lower.select(F.col("id").alias("mid"), F.col("mid").alias("far"))
        fresh = cut_lineage(lower.join(jump, "mid", "left").select("id", "old", F.least("mid", "far").alias("component")))
        labels = fresh.select("id", "component")
        if fresh.filter(F.col("old") != F.col("component")).isEmpty():
            return labels


def _squared(a: Column, b: Column, dims: int) -> Column:
    """Squared distance of two places, coordinate by coordinate, so that Spark compiles it."""
    gaps = [F.get(a, F.lit(i)) - F.get(b, F.lit(i)) for i in range(dims)]
    return reduce(Column.__add__, [x * x for x in gaps])


def _between(low: Column, high: Column, other_low: Column, other_high: Column, dims: int) -> Column:
    """Squared distance of two boxes; a place is a box whose corners are the same."""
    at = lambda c, i: F.get(c, F.lit(i))
    gaps = [F.greatest(at(other_low, i) - at(high, i), at(low, i) - at(other_high, i), F.lit(0.0)) for i in range(dims)]
    return reduce(Column.__add__, [x * x for x in gaps])


def _cell(at: Column, side: float) -> Column:
    return F.transform(at, lambda x: F.floor(x / side))


def _around(cells: DataFrame, dims: int) -> DataFrame:
    """(cell, next): each of some cells with the occupied ones of `cells` that touch it, itself included."""
    near = cells.withColumn("next", F.array().cast("array<bigint>"))
    for i in range(dims):
        near = near.withColumn("_c", F.explode(F.array(*[F.get("cell", F.lit(i)) + d for d in (-1, 0, 1)]))).withColumn(
            "next", F.concat("next", F.array("_c"))
        ).drop("_c")
    return near.join(cells.select(F.col("cell").alias("next")), "next")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all tasks: a join that makes many pairs of few rows must not be put into one task for its small input.

    Both sides need it, since Spark may send either whole to the tasks of the other."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _core_spots(spots: DataFrame, pairs: DataFrame, eps: float, min_samples: int, dims: int) -> DataFrame:
    """(at, core) of every spot: whether enough points lie within `eps` of it, itself included.

    All points of a fine cell are that near to each other, so a crowded cell needs no look at its neighbours. The others
    are few around any cell, so they are the side that a join holds; the spots of a cell, of any number, stream past.
    """
    crowd = spots.groupBy("fine").agg(F.sum("n").alias("crowd"))
    known = spots.join(crowd, "fine").withColumn("sure", F.col("crowd") >= min_samples)
    open_ = known.filter(~F.col("sure")).select("cell", "at").join(pairs, "cell").drop("cell")
    others = spots.select(F.col("cell").alias("next"), F.col("at").alias("to"), "n")
    near = _squared(F.col("at"), F.col("to"), dims) <= eps * eps
    counted = _dealt(others, "next").join(_dealt(open_, "next"), "next").filter(near).groupBy("at").agg(F.sum("n").alias("near"))
    return known.join(counted, "at", "left").select("at", "cell", "fine", "n", (F.col("sure") | (F.coalesce("near", F.lit(0)) >= min_samples)).alias("core"))


def _core_parts(core: DataFrame, pairs: DataFrame, eps: float, dims: int) -> DataFrame:
    """(id, component) of every fine cell with core points: cells with points within `eps` of each other share a component.

    Only cells whose boxes are that near are compared, first by a few points of each, one for each half of its side. The
    cells that these leave in different parts are then compared by all their points near the other's box.
    """
    reach, side = eps * eps, eps / dims**0.5
    corners = [F.array(*[f(F.get("at", F.lit(i))) for i in range(dims)]) for f in (F.min, F.max)]
    boxes = cut_lineage(core.groupBy("fine").agg(corners[0].alias("low"), corners[1].alias("high")).withColumn("id", F.monotonically_increasing_id()))
    core = cut_lineage(core.join(boxes.select("fine", "id"), "fine").select("id", "cell", "at"))
    held = core.select("id", "cell").distinct().join(boxes.drop("fine"), "id")
    as_ = lambda rows, **names: rows.select(*[F.col(old).alias(new) for old, new in names.items()])
    one = as_(held, id="src", cell="cell", low="low", high="high").join(pairs, "cell").drop("cell")
    other = as_(held, id="dst", cell="next", low="low_", high="high_")
    near = _between(F.col("low"), F.col("high"), F.col("low_"), F.col("high_"), dims) <= reach
    met = cut_lineage(_dealt(one, "next").join(_dealt(other, "next"), "next").filter((F.col("src") < F.col("dst")) & near).select("src", "dst").distinct())
    few = cut_lineage(core.groupBy("id", _cell(F.col("at"), side / 2).alias("_half")).agg(F.min("at").alias("at")).select("id", "at"))
    close = _squared(F.col("at"), F.col("to"), dims) <= reach
    sure = met.join(as_(few, id="src", at="at"), "src").join(as_(few, id="dst", at="to"), "dst").filter(close).select("src", "dst").distinct()
    both = lambda links: links.union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    part = connected(both(sure), boxes.select("id"))
    apart = cut_lineage(met.join(as_(part, id="src", component="a"), "src").join(as_(part, id="dst", component="b"), "dst").filter("a != b"))
    box = lambda name: as_(boxes, id=name, low="low", high="high")
    by_box = lambda spot: _between(F.col(spot), F.col(spot), F.col("low"), F.col("high"), dims) <= reach
    x = as_(core, id="src", at="at").join(apart.join(box("dst"), "dst"), "src").filter(by_box("at")).select("src", "dst", "a", "b", "at")
    y = as_(core, id="dst", at="to").join(apart.select("src", "dst").join(box("src"), "src"), "dst").filter(by_box("to")).select("src", "dst", "to")
    late = cut_lineage(x.join(y, ["src", "dst"]).filter(close).select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct())
    if not late.isEmpty():
        whole = connected(both(late), part.select(F.col("component").alias("id")).distinct())
        part = part.join(as_(whole, id="component", component="_whole"), "component").select("id", F.col("_whole").alias("component"))
    return boxes.select("id", "fine").join(part, "id").select(F.col("fine").alias("id"), "component")


def assign_topics(
    points: DataFrame, eps: float, min_samples: int = 10, min_cluster_size: int = 10, key: str = "paper_id",
    dims: Sequence[str] = ("umap_x", "umap_y"),
) -> DataFrame:
    """Density clusters of points with any number of coordinates: topic id by falling size, -1 for noise, membership 0..1.

    A point is core if `min_samples` points, itself included, lie within `eps`. Core points that near to each other share a
    cluster; any other point within `eps` of a core point belongs to the nearest one's (ties: the smaller place), the rest
    and clusters under the least size are noise. Membership is 1 for a core point and falls with the distance from the
    nearest core point for others. Equal points are one spot with a count, so copies of a text never meet each other, and
    neighbours meet by cells of side `eps` in equi-joins. A point with a missing coordinate is noise.
    """
    d = len(dims)
    at = F.array(*[F.col(c).cast("double") for c in dims])
    whole = F.forall(at, lambda x: x.isNotNull() & ~F.isnan(x))
    spots = cut_lineage(points.filter(whole).groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).select(
        "at", "n", _cell(F.col("at"), eps).alias("cell"), _cell(F.col("at"), eps / d**0.5).alias("fine")
    ))
    pairs = cut_lineage(_around(spots.select("cell").distinct(), d))
    judged = cut_lineage(_core_spots(spots, pairs, eps, min_samples, d))
    core = judged.filter("core")
    part = cut_lineage(_core_parts(core, pairs, eps, d))
    inner = core.join(part.withColumnRenamed("id", "fine"), "fine").select("at", "n", "component", F.lit(1.0).alias("probability"))
    edge = judged.filter("not core").select("at", "n", "cell").join(pairs, "cell").drop("cell")
    gap = _squared(F.col("at"), F.col("to"), d)
    around = lambda rows: _dealt(core.select(F.col("cell").alias("next"), F.col("at").alias("to"), "fine"), "next").join(
        _dealt(rows, "next"), "next").withColumn("d", gap)
    # The least distance first, as a number alone, then the place that has it: the pairs are never sorted.
    least = cut_lineage(around(edge).filter(F.col("d") <= eps * eps).groupBy("at").agg(F.min("d").alias("least")))
    border = around(edge.join(least, "at")).filter("d = least").groupBy("at", "n").agg(F.min(F.struct("d", "to", "fine")).alias("w")).select(
        "at", "n", F.col("w.fine").alias("id"), (eps / (eps + F.sqrt("w.d"))).alias("probability")
    ).join(part, "id").select("at", "n", "component", "probability")
    member = cut_lineage(inner.union(border))
    sizes = member.groupBy("component").agg(F.sum("n").alias("size"), F.min(F.when(F.col("probability") == 1, F.col("at"))).alias("least"))
    large = numbered(sizes.filter(F.col("size") >= min_cluster_size), F.desc("size"), "least", name="topic_id")
    labels = member.join(large.select("component", F.col("topic_id").cast("int").alias("topic_id")), "component").select("at", "topic_id", "probability")
    return points.withColumn("at", at).join(labels, "at", "left").select(
        key, *dims, F.coalesce("topic_id", F.lit(NOISE)).alias("topic_id"), "probability"
    )


def topic_word_counts(docs: DataFrame, topics: DataFrame, key: str = "paper_id", text: str = "text") -> DataFrame:
    """Word counts per topic, combined before the shuffle."""
    tokens = docs.select(key, tx.content_words(F.col(text)).alias("w")).join(topics.select(key, "topic_id"), key)
    return tx.unfold(tokens, F.col("w"), "term", "topic_id").groupBy("topic_id", "term").agg(
        F.count(F.lit(1)).alias("tf")
    )


def class_tfidf(counts: DataFrame) -> DataFrame:
    """Weight of each word in each topic: its share there times ln(1 + A / f), where A is the mean
    number of words per topic and f how often the word occurs in all."""
    per_topic = counts.groupBy("topic_id").agg(F.sum("tf").alias("words"))
    mean_words = per_topic.agg(F.avg("words").alias("a")).scalar()
    per_term = counts.groupBy("term").agg(F.sum("tf").alias("f"))
    rows = counts.join(per_term, "term").join(per_topic, "topic_id")
    weight = F.col("tf") / F.col("words") * F.ln(1 + mean_words / F.col("f"))
    return rows.select("topic_id", "term", "tf", weight.alias("weight"))


def topic_terms(weights: DataFrame, n: int = 10, digits: int = 12) -> DataFrame:
    """The `n` heaviest words of each topic, one per row."""
    order = Window.partitionBy("topic_id").orderBy(F.round("weight", digits).desc(), F.col("term"))
    return weights.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def topic_info(topics: DataFrame, terms: DataFrame) -> DataFrame:
    """Size, keywords and label of each topic but noise."""
    sizes = topics.filter(F.col("topic_id") != NOISE).groupBy("topic_id").agg(F.count(F.lit(1)).alias("size"))
    words = terms.groupBy("topic_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "term"))), lambda t: t["term"]).alias("keywords")
    )
    return sizes.join(words, "topic_id", "left").withColumn("topic_label", F.array_join("keywords", "_"))


def label_assignments(topics: DataFrame, info: DataFrame, key: str = "paper_id") -> DataFrame:
    """Topic label of each paper; noise is called outlier and has no probability."""
    named = topics.join(info.select("topic_id", "topic_label"), "topic_id", "left")
    noise = F.col("topic_id") == NOISE
    probability = F.when(~noise, F.col("probability")) if "probability" in topics.columns else F.lit(None)
    return named.select(
        key, "topic_id", F.when(noise, "outlier").otherwise(F.col("topic_label")).alias("topic_label"),
        probability.cast("double").alias("probability"),
    )


def merge_coordinates(assignments: DataFrame, coordinates: DataFrame, key: str = "paper_id") -> DataFrame:
    """Assignments with their coordinates, as the papers table takes them."""
    return assignments.join(coordinates.select(key, "umap_x", "umap_y"), key, "left").select(
        key, F.col("topic_id").alias("topic_cluster_id"), F.col("topic_label").alias("topic_cluster"),
        "umap_x", "umap_y",
    )


def cluster_quality(topics: DataFrame) -> DataFrame:
    """Share of noise and number of topics."""
    noise = F.col("topic_id") == NOISE
    return topics.agg(
        F.count(F.lit(1)).alias("papers"), F.count_if(noise).alias("outliers"),
        F.avg(noise.cast("double")).alias("noise_ratio"),
        F.countDistinct(F.when(~noise, F.col("topic_id"))).alias("topics"),
    )


def _merges(vectors: DataFrame, sizes: DataFrame, digits: int = 9) -> DataFrame:
    """(src, dst, cosine) of the topics that are each other's most similar, src into dst, the larger (ties: smaller id).

    Topics meet by their shared words. Ties go to smaller ids, so the most similar pair of all is always among them.
    """
    norms = vectors.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    unit = vectors.join(norms, "topic_id").select("topic_id", "term", (F.col("weight") / F.col("norm")).alias("v"))
    left, right = unit.select("term", F.col("topic_id").alias("a"), "v"), unit.select("term", F.col("topic_id").alias("b"), F.col("v").alias("u"))
    cosine = left.join(right, "term").filter("a != b").groupBy("a", "b").agg(F.round(F.sum(F.col("v") * F.col("u")), digits).alias("c"))
    nearest = cosine.groupBy("a").agg(F.min(F.struct((-F.col("c")).alias("c"), "b")).alias("w")).select("a", F.col("w.b").alias("b"), (-F.col("w.c")).alias("c"))
    back = nearest.select(F.col("b").alias("a"), F.col("a").alias("b"))
    size = lambda name, out: sizes.select(F.col("topic_id").alias(name), F.col("size").alias(out))
    mutual = nearest.join(back, ["a", "b"]).filter("a < b").join(size("a", "sa"), "a").join(size("b", "sb"), "b")
    into_a = F.col("sa") >= F.col("sb")
    return mutual.select(
        F.when(into_a, F.col("b")).otherwise(F.col("a")).alias("src"), F.when(into_a, F.col("a")).otherwise(F.col("b")).alias("dst"), F.col("c").alias("cosine")
    )


def reduce_topics(topics: DataFrame, weights: DataFrame, n: int) -> DataFrame:
    """Topic map (topic_id, merged_id) that leaves `n` topics, merging the most similar ones in rounds.

    In each round topics that are each other's most similar merge, the most similar first, never more than are too many;
    the word weights of what merges are added up. A merged topic has the id of its largest member. Topics that share no
    word with any other stay until the end; if they are still too many, the smallest join the largest of all.
    """
    sizes = topics.filter(F.col("topic_id") != NOISE).groupBy("topic_id").agg(F.count(F.lit(1)).alias("size"))
    sizes = cut_lineage(sizes)
    vectors = cut_lineage(weights.filter(F.col("topic_id") != NOISE).select("topic_id", "term", "weight").join(sizes.select("topic_id"), "topic_id"))
    merged = sizes.select("topic_id", F.col("topic_id").alias("merged_id"))
    while (over := sizes.count() - n) > 0:
        # At most as many rows as topics are too many.
        step = cut_lineage(_merges(vectors, sizes).orderBy(F.desc("cosine"), "dst", "src").limit(over).select("src", "dst"))
        if step.isEmpty():
            largest = sizes.orderBy(F.desc("size"), "topic_id").limit(1).select(F.col("topic_id").alias("dst"))
            smallest = sizes.orderBy("size", F.desc("topic_id")).limit(over).select(F.col("topic_id").alias("src"))
            step = cut_lineage(smallest.withColumn("dst", largest.scalar()))
        moved = lambda rows, name: rows.join(
            step.select(F.col("src").alias(name), F.col("dst").alias("_to")), name, "left"
        ).withColumn(name, F.coalesce("_to", name)).drop("_to")
        merged = cut_lineage(moved(merged, "merged_id"))
        sizes = cut_lineage(moved(sizes, "topic_id").groupBy("topic_id").agg(F.sum("size").alias("size")))
        vectors = cut_lineage(moved(vectors, "topic_id").groupBy("topic_id", "term").agg(F.sum("weight").alias("weight")))
    return merged.select("topic_id", "merged_id")


def apply_reduction(topics: DataFrame, merged: DataFrame) -> DataFrame:
    """Topics after a merge; noise stays noise."""
    rows = topics.join(merged, "topic_id", "left")
    return rows.withColumn("topic_id", F.coalesce("merged_id", F.lit(NOISE))).drop("merged_id")
