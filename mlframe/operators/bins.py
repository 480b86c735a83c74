"""Trees on binned values: edges are found once per fit, and nodes are judged by histograms of bins and classes.

A value is replaced by the number of edges below it, so a level of a forest is one scan that counts (node, feature, bin, class); no value is
sorted or shuffled after the edges are known.  Classes are rows, never columns.  Where every node looks at all features, only the
smaller child of a split is counted: its sibling's histogram is the parent's less its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, ShortType, StructField, StructType

from mlframe.functions.rng import feature_subset
from mlframe.runtime import MODEL_BLOCK_VALUES, discard, durable

MOST_BINS = 32_767
CUT_LEVELS = 8  # levels chained as (mostly broadcast) joins before the rows are written again
KEYS = ["tree_id", "node_id"]


def quantile_edges(df: DataFrame, max_bins: int) -> DataFrame:
    """(feature, bin, edge): at most ``max_bins - 1`` values that cut each feature's rows into equal shares.

    A value is an edge where the running count of the rows up to it passes a multiple of rows / max_bins; a feature of at most
    ``max_bins`` values has all of them but the largest.  Values are counted (map-side) before they are ordered, and running counts
    are sums over range partitions plus one row per partition.
    """
    if not 2 <= max_bins <= MOST_BINS:
        raise ValueError(f"max_bins must lie in 2..{MOST_BINS}")
    counts = df.select(F.posexplode("features").alias("feature", "v")).groupBy("feature", "v").agg(F.count("*").alias("c"))
    counts = durable(counts.repartitionByRange("feature", "v").withColumn("_p", F.spark_partition_id()))
    parts = counts.groupBy("feature", "_p").agg(F.sum("c").alias("s"), F.count("*").alias("k"), F.max("v").alias("top"))
    every = Window.partitionBy("feature")
    parts = parts.select("feature", "_p", (F.sum("s").over(every.orderBy("_p")) - F.col("s")).alias("before"), F.sum("s").over(every).alias("n"),
                         F.sum("k").over(every).alias("values"), F.max("top").over(every).alias("top"))
    run = F.sum("c").over(Window.partitionBy("feature", "_p").orderBy("v"))
    cum = counts.withColumn("r", run).join(parts, ["feature", "_p"]).withColumn("upto", F.col("before") + F.col("r"))
    whole = F.expr(f"(upto * {max_bins}) div n > ((upto - c) * {max_bins}) div n")
    edges = cum.where((F.col("v") < F.col("top")) & (whole | (F.col("values") <= max_bins)))
    number = F.row_number().over(Window.partitionBy("feature").orderBy("v")) - 1  # fewer than max_bins rows each
    out = durable(edges.select("feature", number.alias("bin"), F.col("v").alias("edge")))
    discard(counts)
    return out


def collect_edges(edges: DataFrame, dims: int) -> list[np.ndarray]:
    """The edges of each feature, for the tasks; a model of at most dims x (max_bins - 1) numbers."""
    rows = edges.orderBy("feature", "bin").limit(MODEL_BLOCK_VALUES + 1).collect()
    if len(rows) > MODEL_BLOCK_VALUES:
        raise ValueError("too many edges for one model: use fewer bins")
    out: list[list[float]] = [[] for _ in range(dims)]
    for r in rows:
        out[r["feature"]].append(r["edge"])
    return [np.array(x, np.float64) for x in out]


def to_bins(df: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """``df`` with ``bins``: for each feature the number of its edges below the value (NaN lies above all)."""
    dims = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("features"))
            flat = vectors.flatten()
            if vectors.null_count or flat.null_count or len(flat) != dims * len(vectors):
                raise ValueError(f"every vector must hold {dims} numbers")
            values = flat.to_numpy(zero_copy_only=False).reshape(len(vectors), dims)
            out = np.empty(values.shape, np.int16)
            for j, e in enumerate(edges):
                out[:, j] = np.searchsorted(e, values[:, j])
            lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, max(dims, 1), dtype=np.int32), out.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "bins"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("bins", ArrayType(ShortType()))]))


def _xlogx(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(F.greatest(c, F.lit(1)))).otherwise(F.lit(0.0))


def split_gains(hist: DataFrame, by: list[str]) -> DataFrame:
    """(by, feature, bin, gain, n_left, n_right) of the splits "bin <= b" of histograms (by, feature, bin, label, c).

    With S the sum of c log2 c over classes, entropy is log2 n - S / n.  A bin changes S only in its own classes, so S on both sides is a
    running sum of changes; no row holds more than one class.
    """
    node = [*by, "feature"]
    left = F.sum("c").over(Window.partitionBy(*node, "label").orderBy("bin"))
    total = F.sum("c").over(Window.partitionBy(*node, "label"))
    rows = hist.withColumn("l", left).withColumn("t", total)
    c, lo, t = F.col("c"), F.col("l"), F.col("t")
    changes = rows.select(*node, "bin", "c", (_xlogx(lo) - _xlogx(lo - c)).alias("dl"), (_xlogx(t - lo) - _xlogx(t - lo + c)).alias("dr"))
    bins = changes.groupBy(*node, "bin").agg(F.sum("c").alias("c"), F.sum("dl").alias("dl"), F.sum("dr").alias("dr"))
    run, whole = Window.partitionBy(*node).orderBy("bin"), Window.partitionBy(*node)
    bins = bins.select(*node, "bin", F.sum("c").over(run).alias("n_left"), F.sum("c").over(whole).alias("n"), F.sum("dl").over(run).alias("sl"),
                       F.sum("dl").over(whole).alias("s"), F.sum("dr").over(run).alias("dr")).withColumn("n_right", F.col("n") - F.col("n_left"))
    n, n_left, n_right = F.col("n"), F.col("n_left"), F.col("n_right")
    below = _xlogx(n_left) - F.col("sl") + _xlogx(n_right) - (F.col("s") + F.col("dr"))
    return bins.select(*node, "bin", (F.log2(n) - F.col("s") / n - below / n).alias("gain"), "n_left", "n_right").where("n_right > 0")


def _best(gains: DataFrame, by: list[str]) -> DataFrame:
    """Highest gain (to 9 digits); ties: lowest feature, then largest value."""
    key = F.struct(F.round("gain", 9).alias("g"), (-F.col("feature")).alias("f"), "bin", "n_left", "n_right")
    best = gains.groupBy(*by).agg(F.max(key).alias("k"))
    return best.select(*by, (-F.col("k.f")).cast("int").alias("feature"), F.col("k.bin").alias("bin"), F.col("k.n_left").alias("n_left"),
                       F.col("k.n_right").alias("n_right"))


def _count(rows: DataFrame, features: Column) -> DataFrame:
    """(tree_id, node_id, feature, bin, label, c) of rows (tree_id, node_id, bins, label)."""
    flat = rows.select(*KEYS, "label", F.explode(features).alias("feature"), "bins")
    return flat.select(*KEYS, "feature", F.get("bins", F.col("feature")).cast("int").alias("bin"), "label") \
        .groupBy(*KEYS, "feature", "bin", "label").agg(F.count("*").alias("c"))


def _stats(classes: DataFrame) -> DataFrame:
    """(tree_id, node_id, n, prediction, n_prediction, dist, pure) of class counts; largest class, ties to the smallest label."""
    top = F.min(F.struct((-F.col("c")).alias("c"), F.col("label").alias("v")))
    pairs = F.collect_list(F.struct(F.col("label").cast("string"), F.col("c").cast("double")))
    out = classes.groupBy(*KEYS).agg(F.sum("c").alias("n"), top.alias("t"), F.map_from_entries(pairs).alias("dist"))
    return out.select(*KEYS, "n", F.col("t.v").alias("prediction"), (-F.col("t.c")).alias("n_prediction"), "dist", (-F.col("t.c") == F.col("n")).alias("pure"))


def grow(rows: DataFrame, edges: DataFrame, dims: int, m: int, max_depth: int | None, seed: int, portable: bool = False) -> tuple[DataFrame, int]:
    """Node table and depth of the trees grown on rows (tree_id, node_id, bins, label).

    A level scans the rows once, for the histograms; the class counts of the children are sums over the split feature's bins.
    """
    tables: list[DataFrame] = []
    everything = m >= dims
    all_features = F.sequence(F.lit(0), F.lit(dims - 1))
    classes = durable(rows.groupBy(*KEYS, "label").agg(F.count("*").alias("c")))
    level, hist, splits = 0, None, None
    while True:
        stats = durable(_stats(classes))
        alive = stats.where("not pure").select(*KEYS)
        if (max_depth is not None and level >= max_depth) or alive.isEmpty():
            tables.append(stats.select(*KEYS, F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("threshold"),
                                       "n", "prediction", "n_prediction", "dist"))
            break
        if not everything:
            drawn = feature_subset(alive, dims, m, seed, KEYS, portable)
            new = durable(_count(rows.join(drawn, KEYS), F.col("features_used")))
        elif hist is None:
            new = durable(_count(rows, all_features))
        else:
            new = durable(_siblings(hist, splits, rows, all_features).join(alive, KEYS, "left_semi"))
        discard(hist)
        hist = new
        found = _best(split_gains(hist, KEYS), KEYS)
        splits = durable(found.join(edges.withColumnRenamed("edge", "threshold"), ["feature", "bin"]))
        tables.append(stats.join(splits.select(*KEYS, "feature", "threshold"), KEYS, "left").select(
            *KEYS, "feature", "threshold", "n", "prediction", "n_prediction", "dist"))
        if splits.isEmpty():
            break
        level += 1
        cut = splits.select(*KEYS, "feature", F.col("bin").alias("cut"))
        side = lambda b: F.when(b > F.col("cut"), "1").otherwise("0")
        classes = durable(hist.join(cut, [*KEYS, "feature"]).groupBy("tree_id", F.concat("node_id", side(F.col("bin"))).alias("node_id"), "label")
                          .agg(F.sum("c").alias("c")))
        rows = rows.join(cut, KEYS).select("tree_id", F.concat("node_id", side(F.get("bins", F.col("feature")))).alias("node_id"), "bins", "label")
        if level % CUT_LEVELS == 0:
            rows = durable(rows)
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.unionByName(t)
    return durable(nodes), level


def _siblings(hist: DataFrame, splits: DataFrame, rows: DataFrame, all_features: Column) -> DataFrame:
    """Histograms of both children of every split: the smaller child is counted, the larger is the parent less the smaller."""
    low = F.col("n_left") <= F.col("n_right")
    small, large = F.when(low, "0").otherwise("1"), F.when(low, "1").otherwise("0")
    names = splits.select(*KEYS, F.concat("node_id", small).alias("small"), F.concat("node_id", large).alias("large"))
    counted = durable(_count(rows.join(names.select("tree_id", F.col("small").alias("node_id")), KEYS, "left_semi"), all_features))
    cells = ["feature", "bin", "label"]
    whole = hist.join(names, KEYS).select("tree_id", F.col("large").alias("node_id"), *cells, "c")
    less = counted.join(names.select("tree_id", F.col("small").alias("node_id"), "large"), KEYS).select(
        "tree_id", F.col("large").alias("node_id"), *cells, (-F.col("c")).alias("c"))
    rest = whole.unionByName(less).groupBy(*KEYS, *cells).agg(F.sum("c").alias("c")).where("c > 0")
    return counted.unionByName(rest)
