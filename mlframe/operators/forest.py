"""Random forest, grown level by level: every job works on all nodes of all trees.

Rows carry (tree_id, node_id); a node id is the heap number written in binary
('1' root, '10' left child, '11' right child), so depth has no limit.  Split
search aggregates to one row per (tree, node, feature, value) before any
sorting, and running class counts are built over range partitions plus
per-range offsets, so the root of a tree is never one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StringType, StructField, StructType

from mlframe.functions.rng import cut_points, feature_subset, uniform
from mlframe.functions.vec import add_all
from mlframe.operators import bins
from mlframe.runtime import MODEL_BLOCK_VALUES, durable, spread

CUT_LEVELS = 8  # levels chained as (mostly broadcast) joins before the rows are written again


def extract_labeled(parsed: DataFrame) -> DataFrame:
    """Vector and label of parsed labelled vectors; the true centre is dropped."""
    return parsed.drop("center")


def _entropy(counts: list[Column], total: Column) -> Column:
    terms = [F.when(c > 0, (c / total) * F.log2(c / total)).otherwise(0.0) for c in counts]
    return -add_all(terms)


def entropy(df: DataFrame, by: list[str], label: str = "label") -> DataFrame:
    """Base-2 entropy of the class counts per group."""
    counts = df.groupBy(*by, label).agg(F.count("*").alias("c"))
    # sum c*log2(c) and sum c are enough: H = log2(n) - sum(c log2 c)/n
    agg = counts.groupBy(*by).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log2(F.col("c"))).alias("s"))
    return agg.select(*by, "n", (F.log2("n") - F.col("s") / F.col("n")).alias("entropy"))


def split_gain(df: DataFrame, by: list[str], feature: int, threshold: float, label: str = "label") -> DataFrame:
    """Information gain of the split ``x[feature] <= threshold`` per group."""
    left = F.col("features")[feature] <= F.lit(float(threshold))
    c = df.groupBy(*by, label).agg(F.count_if(left).alias("l"), F.count_if(~left).alias("r"))

    def clog(col: str) -> Column:
        return F.sum(F.when(F.col(col) > 0, F.col(col) * F.log2(F.col(col))).otherwise(0.0))

    c = c.withColumn("t", F.col("l") + F.col("r"))
    agg = c.groupBy(*by).agg(*[F.sum(x).alias(f"n{x}") for x in "lrt"], *[clog(x).alias(f"s{x}") for x in "lrt"])

    def h(x: str) -> Column:
        n = F.col(f"n{x}")
        return F.when(n > 0, F.log2(F.greatest(n, F.lit(1))) - F.col(f"s{x}") / F.greatest(n, F.lit(1))).otherwise(0.0)

    share = lambda x: F.col(f"n{x}") / F.col("nt")
    return agg.select(*by, F.col("nl").alias("n_left"), F.col("nr").alias("n_right"),
                      (h("t") - share("l") * h("l") - share("r") * h("r")).alias("gain"))


def split_candidates(rows: DataFrame, by: list[str], classes: list, features_used: bool = False) -> DataFrame:
    """(by, feature, threshold, gain, n_left, n_right) for every value of every considered feature.

    ``rows`` has ``features`` and ``label``; with ``features_used`` only the
    features listed in that column are considered.
    """
    k = range(len(classes))
    if features_used:
        flat = rows.select(*by, "label", F.explode("features_used").alias("feature"), "features").select(
            *by, "label", "feature", F.get("features", F.col("feature")).alias("v"))
    else:
        flat = rows.select(*by, "label", F.posexplode("features").alias("feature", "v"))
    hist = flat.groupBy(*by, "feature", "v").agg(
        *[F.count_if(F.col("label") == F.lit(c)).alias(f"c{i}") for i, c in enumerate(classes)])
    keys = [*by, "feature"]
    hist = durable(hist.repartitionByRange(*keys, "v").withColumn("_p", F.spark_partition_id()))
    parts = hist.groupBy(*keys, "_p").agg(*[F.sum(f"c{i}").alias(f"s{i}") for i in k])
    # one row per range partition and group
    before = Window.partitionBy(*keys).orderBy("_p")
    whole = Window.partitionBy(*keys)
    parts = parts.select(*keys, "_p", *[(F.sum(f"s{i}").over(before) - F.col(f"s{i}")).alias(f"b{i}") for i in k],
                         *[F.sum(f"s{i}").over(whole).alias(f"t{i}") for i in k])
    run = Window.partitionBy(*keys, "_p").orderBy("v")
    cum = hist.select(*keys, "_p", "v", *[F.sum(f"c{i}").over(run).alias(f"r{i}") for i in k]).join(
        parts, [*keys, "_p"])
    left = [F.col(f"r{i}") + F.col(f"b{i}") for i in k]
    total = [F.col(f"t{i}") for i in k]
    cum = cum.select(*keys, F.col("v").alias("threshold"), *[c.alias(f"l{i}") for i, c in enumerate(left)],
                     *[(t - c).alias(f"q{i}") for i, (t, c) in enumerate(zip(total, left))],
                     *[t.alias(f"t{i}") for i, t in enumerate(total)])
    cum = cum.withColumn("n_left", add_all([F.col(f"l{i}") for i in k])).withColumn(
        "n_right", add_all([F.col(f"q{i}") for i in k])).withColumn("n", F.col("n_left") + F.col("n_right"))
    h_left = _entropy([F.col(f"l{i}") for i in k], F.col("n_left"))
    h_right = F.when(F.col("n_right") > 0, _entropy(
        [F.col(f"q{i}") for i in k], F.greatest("n_right", F.lit(1)))).otherwise(0.0)
    gain = _entropy([F.col(f"t{i}") for i in k], F.col("n")) - (
        F.col("n_left") / F.col("n") * h_left + F.col("n_right") / F.col("n") * h_right)
    return cum.select(*keys, "threshold", gain.alias("gain"), "n_left", "n_right")


def _best(cand: DataFrame, by: list[str]) -> DataFrame:
    """Highest gain (to 9 digits); ties: lowest feature, then largest value."""
    key = F.struct(F.round("gain", 9).alias("g"), (-F.col("feature")).alias("f"), F.col("threshold").alias("v"))
    best = cand.groupBy(*by).agg(F.max(key).alias("k"))
    return best.select(*by, (-F.col("k.f")).cast("int").alias("feature"), F.col("k.v").alias("threshold"),
                       F.col("k.g").alias("gain"))


def class_list(df: DataFrame) -> list:
    """The distinct labels in order (one entry per class)."""
    return sorted(r[0] for r in df.select("label").distinct().collect())


def best_split(df: DataFrame, by: list[str], classes: list | None = None) -> DataFrame:
    """(by, feature, threshold, gain): best binary split of each group over all features."""
    return _best(split_candidates(df, by, classes or class_list(df)), by)


@dataclass
class Tree:
    """A tree in arrays: feature (-1 at leaves), threshold, left and right child, and the label, of every node; node 0 is the root."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    labels: list

    @classmethod
    def of(cls, rows: list) -> Tree:
        rows = sorted(rows, key=lambda r: (len(r["node_id"]), r["node_id"]))
        at = {r["node_id"]: i for i, r in enumerate(rows)}
        child = lambda side: np.array([at.get(r["node_id"] + side, 0) for r in rows], np.int64)
        return cls(np.array([-1 if r["feature"] is None else r["feature"] for r in rows], np.int64),
                   np.array([np.nan if r["threshold"] is None else r["threshold"] for r in rows]), child("0"), child("1"),
                   [r["prediction"] for r in rows])

    def walk(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The node that each vector (a run of ``values``) ends in."""
        node = np.zeros(len(starts) - 1, np.int64)
        moving = np.arange(len(node))
        while len(moving):
            f = self.feature[node[moving]]
            moving, f = moving[f >= 0], f[f >= 0]
            if (f >= starts[moving + 1] - starts[moving]).any():
                raise ValueError("a vector is too short for the model")
            v, cut = values[starts[moving] + f], self.threshold[node[moving]]
            right = (v > cut) | np.isnan(v)
            node[moving] = np.where(right, self.right[node[moving]], self.left[node[moving]])
        return node


class ForestModel:
    """Node table (tree_id, node_id, feature, threshold, n, prediction, dist) with scoring methods."""

    def __init__(self, nodes: DataFrame, n_trees: int, depth: int, rows: DataFrame | None = None):
        self.nodes = nodes
        self.n_trees = n_trees
        self.depth = depth
        self._rows = rows  # training rows per tree with in_bag flag

    def _route(self, df: DataFrame) -> DataFrame:
        """Walk rows (tree_id, features, ...) down their tree; adds node_id, prediction, score."""
        df = df.withColumn("node_id", F.lit("1"))
        for level in range(1, self.depth + 1):
            splits = self.nodes.where((F.length("node_id") == level) & F.col("feature").isNotNull()).select(
                "tree_id", "node_id", "feature", "threshold")
            side = F.when(F.get("features", F.col("feature")) > F.col("threshold"), "1").otherwise("0")
            step = F.when(F.col("feature").isNull(), F.col("node_id")).otherwise(F.concat("node_id", side))
            df = df.join(splits, ["tree_id", "node_id"], "left").withColumn("node_id", step).drop("feature", "threshold")
            if level % CUT_LEVELS == 0:
                df = durable(df)
        leaf = self.nodes.select("tree_id", "node_id", "prediction", F.col("n_prediction").alias("score"))
        return df.join(leaf, ["tree_id", "node_id"])

    def walker(self) -> list[Tree]:
        """The trees as arrays, for scoring without joins; a model of at most MODEL_BLOCK_VALUES nodes."""
        rows = self.nodes.select("tree_id", "node_id", "feature", "threshold", "prediction").limit(MODEL_BLOCK_VALUES + 1).collect()
        if len(rows) > MODEL_BLOCK_VALUES:
            raise ValueError("too many nodes for one task: score by joins (votes, predict)")
        trees: dict[int, list] = {}
        for r in rows:
            trees.setdefault(r["tree_id"], []).append(r)
        return [Tree.of(trees[t]) for t in sorted(trees)]

    def score(self, points: DataFrame) -> DataFrame:
        """``points`` with ``prediction`` and ``share``, as ``predict`` gives them, row by row: no join and no shuffle, also on streams.

        The trees go to the tasks as arrays; a batch of rows walks down a tree together, one step a level.  A NULL component goes left
        and NaN right, as in the joins; rows without a vector are rejected.
        """
        for c in ("prediction", "share"):
            if c in points.columns:
                raise ValueError(f"the input already has a column {c}")
        trees, n_trees = self.walker(), self.n_trees
        label = self.nodes.schema["prediction"].dataType
        labels = sorted({x for t in trees for x in t.labels})
        kind = pa.string() if isinstance(label, StringType) else pa.float64() if isinstance(label, (DoubleType, FloatType)) else pa.int64()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = {x: i for i, x in enumerate(labels)}
            for batch in batches:
                vectors = batch.column(batch.schema.get_field_index("features"))
                if vectors.null_count:
                    raise ValueError("a row has no vector")
                flat = vectors.flatten()
                starts = np.r_[0, np.cumsum(pc.list_value_length(vectors).to_numpy())]
                values = pc.fill_null(flat, -np.inf).to_numpy(zero_copy_only=False)
                votes = np.zeros((len(vectors), len(labels)), np.int64)
                for t in trees:
                    leaf = t.walk(values, starts)
                    votes[np.arange(len(leaf)), np.array([number[x] for x in t.labels])[leaf]] += 1
                best = votes.argmax(axis=1)  # the first, so the smallest label wins a tie
                names = pa.array([labels[i] for i in best.tolist()], kind)
                share = votes[np.arange(len(best)), best] / n_trees
                yield pa.RecordBatch.from_arrays([*batch.columns, names, pa.array(share)], [*batch.schema.names, "prediction", "share"])

        out = {pa.string(): StringType(), pa.float64(): DoubleType()}.get(kind, LongType())
        scored = points.mapInArrow(run, StructType([*points.schema.fields, StructField("prediction", out), StructField("share", DoubleType())]))
        return scored.withColumn("prediction", F.col("prediction").cast(label))

    def _per_tree(self, points: DataFrame) -> DataFrame:
        trees = F.explode(F.sequence(F.lit(1), F.lit(self.n_trees))).alias("tree_id")
        return self._route(points.select("row_id", "features", trees))

    def tree_predictions(self, points: DataFrame) -> DataFrame:
        """(row_id, tree_id, prediction, score): class with the most rows in the reached node and that count."""
        return self._per_tree(points).select("row_id", "tree_id", "prediction", "score")

    def votes(self, points: DataFrame) -> DataFrame:
        """(row_id, label, share) of trees voting for each class."""
        return self._per_tree(points).groupBy("row_id", F.col("prediction").alias("label")).agg(
            (F.count("*") / F.lit(self.n_trees)).alias("share"))

    def predict(self, points: DataFrame) -> DataFrame:
        """(row_id, prediction, share): class with the greatest share; ties: smallest label."""
        best = F.max_by(F.struct("label", "share"), F.struct("share", "_rank"))
        votes = self.votes(points)
        # rank labels so that the smallest wins a tie
        labels = self.nodes.select(F.col("prediction").alias("label")).distinct()
        ranked = labels.withColumn("_rank", -F.row_number().over(Window.orderBy("label")))  # one row per class
        return votes.join(ranked, "label").groupBy("row_id").agg(best.alias("b")).select(
            "row_id", F.col("b.label").alias("prediction"), F.col("b.share").alias("share"))

    def oob_by_tree(self) -> DataFrame:
        """(tree_id, n, error): share of each tree's out-of-bag rows it gets wrong."""
        oob = self._rows.where(~F.col("in_bag")).select("row_id", "tree_id", "features", "label")
        scored = self._route(oob)
        wrong = F.when(F.col("prediction") != F.col("label"), 1.0).otherwise(0.0)
        return scored.groupBy("tree_id").agg(F.count("*").alias("n"), F.avg(wrong).alias("error"))

    def oob_error(self) -> DataFrame:
        """One row ``error``: mean over the trees that have out-of-bag rows."""
        return self.oob_by_tree().agg(F.avg("error").alias("error"))


def bootstrap(df: DataFrame, ratio: float, n_trees: int, seed: int = 0, exact: bool = True,
              portable: bool = False) -> DataFrame:
    """(row_id, features, label, tree_id, in_bag): bags of round(ratio * N) distinct rows; the rest is out of bag.

    A bag is a threshold on the row's random number for that tree (one row per
    tree), so the copies of a row for its trees are made on the fly in each
    scan and never written.  ``exact=False`` draws each row independently with
    probability ``ratio``.
    """
    return _bags(distinct_rows(df), ratio, n_trees, seed, exact, portable)


def distinct_rows(df: DataFrame) -> DataFrame:
    """(features, label, row_id, _copies): one row per vector and label, written."""
    return spread(durable(df.groupBy("features", "label").agg(F.min("row_id").alias("row_id"), F.count("*").alias("_copies"))))


def _bags(distinct: DataFrame, ratio: float, n_trees: int, seed: int, exact: bool, portable: bool) -> DataFrame:
    """``distinct`` without ``_copies``, once per tree, with tree_id and in_bag."""
    columns = [c for c in distinct.columns if c != "_copies"]
    trees = F.explode(F.sequence(F.lit(1), F.lit(n_trees))).alias("tree_id")
    u = uniform("row_id", seed, F.concat(F.lit("bag"), F.col("tree_id").cast("string")), portable)
    rows = distinct.select(*columns, trees)
    if not exact:
        return rows.withColumn("in_bag", u < ratio)
    total = distinct.agg(F.sum("_copies").alias("n")).first()["n"] or 0
    size = math.floor(ratio * total + 0.5)
    if size < 1:
        return rows.withColumn("in_bag", F.lit(False))
    cut = durable(cut_points(rows, size, u, "row_id", ["tree_id"]))  # one row per tree
    below = F.struct(u.alias("u"), F.col("row_id").alias("id")) <= F.col("cut")
    return rows.join(F.broadcast(cut), "tree_id").select(*columns, "tree_id", below.alias("in_bag"))


def vector_size(df: DataFrame) -> int:
    """The common size of all vectors."""
    row = df.agg(F.min(F.size("features")).alias("lo"), F.max(F.size("features")).alias("hi")).first()
    if row["lo"] is None:
        raise ValueError("no training rows")
    if row["lo"] != row["hi"]:
        raise ValueError("vectors differ in size")
    return row["lo"]


def _profile(df: DataFrame) -> tuple[int, list]:
    """Vector size and classes, in one scan."""
    row = df.agg(F.min(F.size("features")).alias("lo"), F.max(F.size("features")).alias("hi"),
                 F.collect_set("label").alias("c")).first()
    if row["lo"] is None:
        raise ValueError("no training rows")
    if row["lo"] != row["hi"]:
        raise ValueError("vectors differ in size")
    return row["lo"], sorted(row["c"])


def forest_fit(df: DataFrame, n_trees: int = 200, m: int = 10, max_depth: int | None = None, ratio: float = 0.66,
               seed: int = 0, exact: bool = True, portable: bool = False, max_bins: int | None = None) -> ForestModel:
    """Fit ``n_trees`` trees on rows (row_id, features, label).

    Each node looks at ``m`` randomly drawn features.  A node is final when it
    is pure, at ``max_depth``, or when no value of its features separates rows.
    With ``max_bins`` only quantiles of each feature are tried as thresholds, see
    ``bins``; a feature of at most so many values loses none of its splits.
    """
    if max_bins is not None:
        dims = vector_size(df)
        edges = bins.quantile_edges(df, max_bins)
        distinct = spread(durable(bins.to_bins(distinct_rows(df), bins.collect_edges(edges, dims))))
        rows = _bags(distinct, ratio, n_trees, seed, exact, portable)
        nodes, depth = bins.grow(rows.where("in_bag").select("tree_id", F.lit("1").alias("node_id"), "bins", "label"),
                                 edges, dims, m, max_depth, seed, portable)
        return ForestModel(nodes, n_trees, depth, rows)
    dims, classes = _profile(df)
    rows = bootstrap(df, ratio, n_trees, seed, exact, portable)
    nodes, depth = grow(rows.where("in_bag").select("tree_id", F.lit("1").alias("node_id"), "features", "label"),
                        classes, dims, m, max_depth, seed, portable)
    return ForestModel(nodes, n_trees, depth, rows)


def tree_fit(df: DataFrame, m: int, max_depth: int | None = None, seed: int = 0, portable: bool = False,
             max_bins: int | None = None) -> ForestModel:
    """One tree on all rows (no bootstrap); ``max_bins`` as in ``forest_fit``."""
    if max_bins is not None:
        dims = vector_size(df)
        edges = bins.quantile_edges(df, max_bins)
        binned = durable(bins.to_bins(df, bins.collect_edges(edges, dims)))
        rows = binned.select(F.lit(1).alias("tree_id"), F.lit("1").alias("node_id"), "bins", "label")
        nodes, depth = bins.grow(rows, edges, dims, m, max_depth, seed, portable)
        return ForestModel(nodes, 1, depth, df.withColumn("tree_id", F.lit(1)).withColumn("in_bag", F.lit(True)))
    dims, classes = _profile(df)
    rows = df.select(F.lit(1).alias("tree_id"), F.lit("1").alias("node_id"), "features", "label")
    nodes, depth = grow(rows, classes, dims, m, max_depth, seed, portable)
    return ForestModel(nodes, 1, depth, df.withColumn("tree_id", F.lit(1)).withColumn("in_bag", F.lit(True)))


def _node_stats(rows: DataFrame, classes: list) -> DataFrame:
    """(tree_id, node_id, n, prediction, n_prediction, dist, pure): largest class, ties to the smallest label."""
    counts = rows.groupBy("tree_id", "node_id").agg(
        *[F.count_if(F.col("label") == F.lit(c)).alias(f"c{i}") for i, c in enumerate(classes)])
    cols = [F.col(f"c{i}") for i in range(len(classes))]
    top = F.array_max(F.array(*[
        F.struct(c.alias("c"), F.lit(-i).alias("i"), F.lit(v).alias("v")) for i, (c, v) in enumerate(zip(cols, classes))]))
    dist = F.map_filter(
        F.create_map(*[x for c, v in zip(cols, classes) for x in (F.lit(str(v)), c.cast("double"))]),
        lambda k, v: v > 0)
    return counts.select("tree_id", "node_id", add_all(cols).alias("n"), top.alias("_t"), dist.alias("dist")).select(
        "tree_id", "node_id", "n", F.col("_t.v").alias("prediction"), F.col("_t.c").alias("n_prediction"), "dist",
        (F.col("_t.c") == F.col("n")).alias("pure"))


def grow(rows: DataFrame, classes: list, dims: int, m: int, max_depth: int | None, seed: int,
         portable: bool = False) -> tuple[DataFrame, int]:
    """Node table and depth of the trees grown on rows (tree_id, node_id, features, label)."""
    tables: list[DataFrame] = []
    level = 0
    keys = ["tree_id", "node_id"]
    while True:
        stats = durable(_node_stats(rows, classes))
        alive = stats.where("not pure").select(*keys)
        if (max_depth is not None and level >= max_depth) or alive.isEmpty():
            tables.append(stats.select(*keys, F.lit(None).cast("int").alias("feature"),
                                       F.lit(None).cast("double").alias("threshold"),
                                       "n", "prediction", "n_prediction", "dist"))
            break
        used = feature_subset(alive, dims, m, seed, keys, portable)
        active = rows.join(used, keys)
        cand = split_candidates(active, keys, classes, features_used=True).where("n_right > 0")
        splits = durable(_best(cand, keys).select(*keys, "feature", "threshold"))
        tables.append(stats.join(splits, keys, "left").select(
            *keys, "feature", "threshold", "n", "prediction", "n_prediction", "dist"))
        if splits.isEmpty():
            break
        level += 1
        side = F.when(F.get("features", F.col("feature")) > F.col("threshold"), "1").otherwise("0")
        rows = rows.join(splits, keys).select(
            "tree_id", F.concat("node_id", side).alias("node_id"), "features", "label")
        if level % CUT_LEVELS == 0:
            rows = durable(rows)
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.unionByName(t)
    return durable(nodes), level
