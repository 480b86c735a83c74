"""k-means++ on sparse documents ``(doc_id, term_id, cnt)``.

``|a - c|^2 = |a|^2 + |c|^2 - 2 a.c``: the dot products come from joining
postings with the centre table on the term, so the work follows the non-zero
entries.  Centres stay in long form, written once per round; their true size
lets Catalyst broadcast them while they are small and fall back to a shuffle
join, with skew splitting, when they grow with the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mlframe.functions.rng import race_key, uniform
from mlframe.operators import kmeans
from mlframe.operators.kmeans import Clustering
from mlframe.runtime import discard, durable


def _entries(bow: DataFrame) -> DataFrame:
    """Entries added up.  Negative counts fail the job: ``nearest_documents`` is exact for non-negative ones only."""
    good = F.when(F.col("cnt") < 0, F.raise_error(F.lit("counts must not be negative")).cast("double")).otherwise(F.col("cnt"))
    return bow.withColumn("cnt", good).groupBy("doc_id", "term_id").agg(F.sum("cnt").cast("double").alias("cnt")).where("cnt <> 0")


def _postings(bow: DataFrame) -> DataFrame:
    """Entries placed by document: per-document sums then need no further shuffle."""
    return _entries(bow).repartition("doc_id")


def _held(bow: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A written table with one row per document, and its entries: a row's sums are one row before any shuffle, and nothing is cached."""
    rows = _entries(bow).groupBy("doc_id").agg(F.collect_list(F.struct("term_id", "cnt")).alias("e"))
    table = durable(rows.select("doc_id", F.col("e.term_id").alias("terms"), F.col("e.cnt").alias("cnts")), release=True)
    entries = table.select("doc_id", F.explode(F.arrays_zip("terms", "cnts")).alias("e"))
    return table, entries.select("doc_id", F.col("e.terms").alias("term_id"), F.col("e.cnts").alias("cnt"))


def _norms(table: DataFrame, key: str, value: str) -> DataFrame:
    return table.groupBy(key).agg(F.sum(F.col(value) * F.col(value)).alias("norm2"))


def nearest_documents(postings: DataFrame, centers: DataFrame) -> DataFrame:
    """(doc_id, cluster, sq_distance): nearest of the sparse centres (cluster, term_id, weight); ties: lowest cluster.

    Counts and weights must not be negative: a centre without a shared term
    can then win only if it is the one with the smallest norm, so that single
    centre is the only one considered without a join match.
    """
    c_norm = _norms(centers, "cluster", "weight")
    low = c_norm.agg(F.min(F.struct("norm2", "cluster")).alias("m")).first()["m"]
    if low is None:
        raise ValueError("no centres")
    norms = _norms(postings, "doc_id", "cnt").withColumnRenamed("norm2", "doc_norm2")
    dots = (
        postings.join(centers, "term_id")
        .groupBy("doc_id", "cluster").agg(F.sum(F.col("cnt") * F.col("weight")).alias("dot"))
        .join(c_norm, "cluster")  # k rows
        .select("doc_id", F.struct((F.col("norm2") - 2.0 * F.col("dot")).alias("rest"), "cluster").alias("c"))
        .groupBy("doc_id").agg(F.min("c").alias("c"))
    )
    lonely = F.struct(F.lit(low["norm2"]).alias("rest"), F.lit(low["cluster"]).alias("cluster"))
    best = F.when(F.col("c").isNull(), lonely).otherwise(F.least(F.col("c"), lonely))
    return norms.join(dots, "doc_id", "left").select("doc_id", "doc_norm2", best.alias("b")).select(
        "doc_id", F.col("b.cluster").alias("cluster"),
        F.greatest(F.col("doc_norm2") + F.col("b.rest"), F.lit(0.0)).alias("sq_distance"))


def mean_centers(postings: DataFrame, assignment: DataFrame) -> DataFrame:
    """(cluster, term_id, weight): mean of the documents of each cluster."""
    sizes = assignment.groupBy("cluster").agg(F.count("*").alias("size"))
    sums = postings.join(assignment.select("doc_id", "cluster"), "doc_id").groupBy("cluster", "term_id").agg(
        F.sum("cnt").alias("total"))
    return sums.join(sizes, "cluster").select("cluster", "term_id", (F.col("total") / F.col("size")).alias("weight"))


def bow_step(bow: DataFrame, centers: DataFrame) -> DataFrame:
    """One round: new centres from given ones."""
    postings = _postings(bow)
    return mean_centers(postings, nearest_documents(postings, centers))


def _centers_of(postings: DataFrame, chosen: list[tuple[int, object]]) -> DataFrame:
    whens = None
    for cluster, doc in chosen:
        cond = F.col("doc_id") == doc
        whens = F.when(cond, cluster) if whens is None else whens.when(cond, cluster)
    return postings.where(F.col("doc_id").isin([d for _, d in chosen])).select(
        whens.cast("int").alias("cluster"), "term_id", F.col("cnt").alias("weight"))


def bow_init(bow: DataFrame, k: int, seed: int = 0, init: str = "d2", portable: bool = False) -> DataFrame:
    """k-means++ start: (cluster, doc_id) of the chosen documents, numbered from 1."""
    table, postings = _held(bow)
    try:
        chosen = _choose(postings, k, seed, init, portable)
    finally:
        discard(table)
    return bow.sparkSession.createDataFrame(
        chosen, f"cluster int, doc_id {bow.schema['doc_id'].dataType.simpleString()}")


def _choose(postings: DataFrame, k: int, seed: int, init: str, portable: bool) -> list[tuple[int, object]]:
    docs = postings.select("doc_id").distinct()
    u = uniform("doc_id", seed, "row", portable)
    first = docs.agg(F.min_by("doc_id", F.struct(u, F.col("doc_id"))).alias("d")).first()["d"]
    chosen = [] if first is None else [(1, first)]
    folded, done = None, 0  # distances so far, and how many of the chosen they cover
    try:
        while chosen and len(chosen) < k:
            near = nearest_documents(postings, _centers_of(postings, chosen[done:])).select("doc_id", "sq_distance")
            if folded is not None:
                near = near.join(folded.withColumnRenamed("sq_distance", "_so_far"), "doc_id").select(
                    "doc_id", F.least("sq_distance", "_so_far").alias("sq_distance"))
            if len(chosen) - done >= kmeans.FOLD:
                done, old = len(chosen), folded
                near = folded = durable(near, release=True)
                discard(old)
            left = near.where((F.col("sq_distance") > 0) & ~F.col("doc_id").isin([d for _, d in chosen]))
            if init == "d2":
                key = race_key(F.col("sq_distance"), uniform("doc_id", seed, f"d{len(chosen)}", portable))
            else:
                key = -F.col("sq_distance")
            pick = left.agg(F.min_by("doc_id", F.struct(key, F.col("doc_id"))).alias("d")).first()["d"]
            if pick is None:
                break
            chosen.append((len(chosen) + 1, pick))
    finally:
        discard(folded)
    return chosen


def kmeans_pp_bow(bow: DataFrame, k: int, iterations: int, seed: int = 0, init: str = "d2",
                  portable: bool = False) -> Clustering:
    """k-means++ on documents: centres (cluster, term_id, weight) and assignment (doc_id, cluster, distance)."""
    table, postings = _held(bow)
    try:
        centers = durable(_centers_of(postings, _choose(postings, k, seed, init, portable)), release=True)
        for _ in range(iterations):
            # the shuffle files of the one go before the other begins
            old, near = centers, durable(nearest_documents(postings, centers), release=True)
            centers = durable(mean_centers(postings, near), release=True)
            discard(old)
            discard(near)
        final = nearest_documents(postings, centers)
        assignment = durable(final.withColumn("distance", F.sqrt("sq_distance")).drop("sq_distance"), release=True)
    finally:
        discard(table)
    return Clustering(centers, assignment, iterations)
