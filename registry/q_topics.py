"""Topic modelling. Vectors and projections have no SQL; their tests compare them by brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from corpuslens.operators import consolidate, search
from corpuslens.operators import topics as tp
from corpuslens.operators.numbering import numbered
from corpuslens.plans import topic_model
from registry.core import query
from registry.q_text import words_sql

EPS, MIN_SAMPLES, MIN_SIZE = 0.025, 8, 10


def clusters_sql(places: str, eps: float, min_samples: int, min_size: int) -> str:
    """CTEs that end in clusters(paper_id, topic_id, probability): all pairs of `places` (paper_id, list of coordinates)."""
    gap = "list_reduce(list_prepend(0e0, list_transform(list_zip(a.pos, b.pos), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), lambda s, x: s + x)"
    return f""", places as materialized ({places}),
    spots as materialized (select pos, count(*) as n from places group by 1),
    gaps as materialized (select a.pos as pos, b.pos as other, b.n, {gap} as d from spots a, spots b where {gap} <= {eps}e0 * {eps}e0),
    core as materialized (select pos from gaps group by 1 having sum(n) >= {min_samples}),
    links as materialized (select pos, other from gaps where pos in (from core) and other in (from core)),
    reach as (select pos, pos as target from core union select r.pos, l.other from reach r join links l on l.pos = r.target),
    comp as materialized (select pos, min(target) as component from reach group by 1),
    near as (select pos, first(other order by d, other) as other, min(d) as d from gaps
      where pos not in (from core) and other in (from core) group by 1),
    member as materialized (select pos, component, 1e0 as probability from comp union all
      select near.pos, component, {eps}e0 / ({eps}e0 + sqrt(d)) from near join comp on comp.pos = near.other),
    ranked as (select component, row_number() over (order by sum(n) desc, component) - 1 as topic_id
      from member join spots using (pos) group by 1 having sum(n) >= {min_size}),
    clusters as (select paper_id, coalesce(topic_id, -1) as topic_id, case when topic_id is not null then probability end as probability
      from places left join member using (pos) left join ranked using (component))"""


CLUSTERS = clusters_sql("select paper_id, [umap_x, umap_y] as pos from points", EPS, MIN_SAMPLES, MIN_SIZE)
EPS_5, SAMPLES_5 = 0.13, 6
CLUSTERS_5 = clusters_sql(
    "select cast(vec_id as varchar) as paper_id, list_transform(embedding[1:5], lambda x: cast(x as double)) as pos from embeddings",
    EPS_5, SAMPLES_5, MIN_SIZE,
)


def clusters(v):
    return tp.assign_topics(v.points, EPS, MIN_SAMPLES, MIN_SIZE)


@query("points", sql=CLUSTERS_5 + " select paper_id, topic_id, round(probability, 6) as probability from clusters")
def assign_topics_in_five_dimensions(v):
    names = [f"c{i}" for i in range(5)]
    places = v.table("embeddings").select(
        F.col("vec_id").cast("string").alias("paper_id"), *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(names)]
    )
    found = tp.assign_topics(places, EPS_5, SAMPLES_5, MIN_SIZE, dims=names)
    return found.select("paper_id", "topic_id", F.round("probability", 6).alias("probability"))


@query("points", sql=f"{CLUSTERS} select paper_id, topic_id, round(probability, 6) as probability from clusters")
def assign_topics(v):
    return clusters(v).select("paper_id", "topic_id", F.round("probability", 6).alias("probability"))


@query("points", sql=f"""{CLUSTERS} select count(*) as papers, count(*) filter (where topic_id = -1) as outliers,
    round(avg(case when topic_id = -1 then 1.0 else 0.0 end), 6) as noise_ratio,
    count(distinct topic_id) filter (where topic_id <> -1) as topics from clusters""")
def cluster_quality(v):
    return tp.cluster_quality(clusters(v)).withColumn("noise_ratio", F.round("noise_ratio", 6))


WEIGHTS = f""", wc as (select topic_cluster_id as topic_id, term, count(*) as tf from (select topic_cluster_id,
      unnest({words_sql('abstract')}) as term from texts) group by 1, 2),
    per_topic as (select topic_id, sum(tf) as words from wc group by 1),
    per_term as (select term, sum(tf) as f from wc group by 1),
    weights as (select topic_id, term, tf, tf / words * ln(1 + (select avg(words) from per_topic) / f) as weight
      from wc join per_topic using (topic_id) join per_term using (term)),
    terms as (select * from (select *, row_number() over (partition by topic_id order by round(weight, 12) desc, term) as place
      from weights) where place <= 10)"""


def topics(v):
    return v.texts.select("paper_id", F.col("topic_cluster_id").alias("topic_id"))


def docs(v):
    return v.texts.select("paper_id", F.col("abstract").alias("text"))


def weights(v):
    return tp.class_tfidf(tp.topic_word_counts(docs(v), topics(v)))


@query("texts", sql=f"{WEIGHTS} select topic_id, term, tf, round(weight, 9) as weight from weights")
def class_tfidf(v):
    return weights(v).withColumn("weight", F.round("weight", 9))


@query("texts", sql=f"{WEIGHTS} select topic_id, term, place from terms")
def topic_terms(v):
    return tp.topic_terms(weights(v)).select("topic_id", "term", "place")


INFO = """, info as (select topic_id, s.size, string_agg(term, '_' order by place) as topic_label from terms
    join (select topic_cluster_id as topic_id, count(*) as size from texts where topic_cluster_id <> -1 group by 1) s
    using (topic_id) group by 1, 2)"""


@query("texts", sql=f"{WEIGHTS}{INFO} select * from info")
def topic_info(v):
    return tp.topic_info(topics(v), tp.topic_terms(weights(v))).select("topic_id", "size", "topic_label")


@query("texts", sql=f"""{WEIGHTS}{INFO} select paper_id, topic_cluster_id, case when topic_cluster_id = -1 then 'outlier'
    else topic_label end as topic_cluster, umap_x, umap_y from texts left join info on topic_id = topic_cluster_id""")
def label_and_place(v):
    """Assignments with labels, joined to coordinates as the papers table takes them."""
    info = tp.topic_info(topics(v), tp.topic_terms(weights(v)))
    return tp.merge_coordinates(tp.label_assignments(topics(v), info), v.texts)


REDUCED = f"""{WEIGHTS}, sizes as (select topic_cluster_id as topic_id, count(*) as size from texts
      where topic_cluster_id <> -1 group by 1),
    rounds as (select 0 as i, topic_id, topic_id as grp from sizes union all (
      with held as (select r.grp, sum(size) as size from rounds r join sizes using (topic_id) group by 1),
      vec as (select r.grp, term, sum(weight) as w from rounds r join weights using (topic_id) group by 1, 2),
      unit as (select grp, term, w / sqrt(sum(w * w) over (partition by grp)) as u from vec),
      cosine as (select a.grp as a, b.grp as b, round(sum(a.u * b.u), 9) as c from unit a join unit b using (term)
        where a.grp <> b.grp group by 1, 2),
      nearest as (select a, first(b order by c desc, b) as b, max(c) as c from cosine group by 1),
      pairs as (select x.a, x.b, x.c, ha.size as sa, hb.size as sb from nearest x join nearest y on y.a = x.b and y.b = x.a
        join held ha on ha.grp = x.a join held hb on hb.grp = x.b where x.a < x.b),
      merges as (select case when sa >= sb then b else a end as src, case when sa >= sb then a else b end as dst, c from pairs),
      chosen as (select src, dst, row_number() over (order by c desc, dst, src) as rn from merges)
      select r.i + 1, r.topic_id, coalesce(m.dst, r.grp) from rounds r left join (select * from chosen
        where rn <= (select count(*) from held) - 4) m on m.src = r.grp where (select count(*) from held) > 4))"""


@query("texts", sql=f"""{REDUCED} select topic_id, grp as merged_id from rounds where i = (select max(i) from rounds)""")
def reduce_topics(v):
    return tp.reduce_topics(topics(v), weights(v), 4)


@query("texts", sql=f"""select case when topic_cluster_id = -1 then -1 else 0 end as topic_id, count(*) as papers
    from texts group by 1""")
def reduce_to_one_topic(v):
    """With one topic left, every paper that is no outlier has it."""
    merged = tp.apply_reduction(topics(v), tp.reduce_topics(topics(v), weights(v), 1))
    low = merged.filter(F.col("topic_id") != tp.NOISE).agg(F.min("topic_id").alias("t")).scalar()
    return merged.groupBy(F.when(F.col("topic_id") == low, 0).otherwise(F.col("topic_id")).alias("topic_id")).agg(
        F.count("*").alias("papers")
    )


@query("texts", sql=f""", words as (select paper_id, unnest({words_sql('abstract')}) as word from texts),
    counts as (select paper_id, ('0x' || md5(word)[1:8])::bigint % 64 as place, count(*) as tf from words group by 1, 2),
    weighted as (select paper_id, place, tf * ln(((select count(*) from texts) + 1) / (count(*) over (partition by place) + 1)) as w
      from counts),
    unit as (select paper_id, place, w / sqrt(sum(w * w) over (partition by paper_id)) as value from weighted),
    held as (select paper_id, map_from_entries(list((place, value))) as m from unit group by 1)
    select paper_id, list_transform(range(0, 64), lambda i: coalesce(m[i], 0e0)::float) as embedding from texts left join held using (paper_id)""")
def encode_texts(v):
    """Vectors of 64 hashed places."""
    return tp.encode_texts(docs(v), dims=64)


@query()
def project_2d(v):
    return tp.project_2d(v.table("embeddings").select(F.col("vec_id").cast("string").alias("paper_id"), "embedding"))


@query()
def topic_model_run(v):
    run = topic_model.fit(v.texts, dims=64, eps=0.08, min_samples=5, n_words=5)
    return run.assignments


@query(sql="""select cast(doc_id as varchar) as paper_id, length(text) % 7 as a, length(text) % 11 as b from documents""")
def encode_with_own_model(v):
    """A user's encoder, loaded once per task: here two numbers from the length of a text."""
    def load():
        return lambda texts: np.array([[len(t) % 7, len(t) % 11] for t in texts], "float32").reshape(-1, 2)

    rows = v.table("documents").select(F.col("doc_id").cast("string").alias("paper_id"), "text")
    found = tp.encode_with_model(rows, load)
    return found.select("paper_id", F.get("embedding", F.lit(0)).cast("int").alias("a"), F.get("embedding", F.lit(1)).cast("int").alias("b"))


@query(sql="select 0 as clusters, 0 as merged, 0 as edges, 0 as hits, 0 as numbered")
def empty_tables(v):
    """Clusters, merges, edges, searches and numbers of the given tables without their rows are empty and stop nothing."""
    none = v.texts.filter("paper_id is null")
    hits = search.search(none, v.queries, stem=False)
    points = v.points.filter("paper_id is null")
    parts = {
        "clusters": tp.assign_topics(points, EPS), "merged": tp.reduce_topics(none.select("topic_cluster_id").withColumnRenamed(
            "topic_cluster_id", "topic_id"), weights(v).filter("topic_id is null"), 2),
        "edges": consolidate.dedup_edges(v.raw_edges.filter("citing_id is null")), "hits": hits,
        "numbered": numbered(none.select("paper_id"), "paper_id"),
    }
    counts = None
    for name, rows in parts.items():
        one = rows.select(F.lit(name).alias("name")).groupBy("name").count()
        counts = one if counts is None else counts.unionByName(one)
    return counts.groupBy().agg(*[F.coalesce(F.sum(F.when(F.col("name") == n, F.col("count"))), F.lit(0)).cast("int").alias(n) for n in parts])
