"""Dense k-means and k-means++.

A round is one scan: every task finds the nearest centre of its rows and adds
up counts and vector sums, and k partial rows per task reach the shuffle.
Centres live on the driver (k * d numbers) and travel with the tasks, so no
join or cross product is planned and the input is never reshuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mlframe.functions.rng import race_key, random_row, uniform
from mlframe.functions.vec import batch_matrix, checked, unrolled_sq_dist
from mlframe.runtime import MODEL_BLOCK_VALUES, UNROLL_TERMS, discard, durable

Distance = Callable[[Column, Column], Column]
# Draws of k-means++ between two writings of the distances so far: the work is k * FOLD / 2 distances a point instead of k * k / 2.
FOLD = 32
# Points of a round's batches travel in rows of at most so many bytes.
PACKED_BYTES = 4_000_000


@dataclass
class Clustering:
    centers: DataFrame      # cluster int, center array<double>
    assignment: DataFrame   # input columns + cluster int, distance double
    rounds: int


class _Model:
    """Driver-side centres, ordered by cluster id so that ties go to the lowest id."""

    def __init__(self, rows: list[tuple[int, list[float]]]):
        rows = sorted(rows)
        self.ids = [int(i) for i, _ in rows]
        self.values = [[float(x) for x in c] for _, c in rows]
        if len({len(c) for c in self.values}) > 1:
            raise ValueError("centres differ in size")

    @property
    def dims(self) -> int:
        return len(self.values[0]) if self.values else 0

    def rows(self) -> list[tuple[int, list[float]]]:
        return list(zip(self.ids, self.values))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "cluster int, center array<double>")


def _collect_model(centers: DataFrame) -> _Model:
    return _Model([(r["cluster"], r["center"]) for r in centers.select("cluster", "center").collect()])


def _farthest_move(old: _Model, new: _Model) -> float:
    return float(np.sqrt(((np.array(old.values) - np.array(new.values)) ** 2).sum(axis=1)).max(initial=0.0))


def _nearest_numpy(x: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (first on ties) and its squared distance."""
    best = np.full(len(x), np.inf)
    index = np.zeros(len(x), dtype=np.int64)
    for i, c in enumerate(values):
        diff = x - c
        d2 = np.einsum("ij,ij->i", diff, diff)
        closer = d2 < best
        best[closer] = d2[closer]
        index[closer] = i
    return index, best


def _blocks(model: _Model):
    """Centres in blocks small enough to ship with a task."""
    step = max(1, MODEL_BLOCK_VALUES // max(model.dims, 1))
    for lo in range(0, len(model.ids), step):
        yield model.ids[lo:lo + step], model.values[lo:lo + step]


def nearest(points: DataFrame, centers: DataFrame | _Model, features: str = "features",
            distance: Distance | None = None) -> DataFrame:
    """Append ``cluster`` and ``sq_distance`` of the nearest centre (ties: lowest cluster).

    Row-wise and stateless, so it also runs on a streaming DataFrame.  A custom
    ``distance(features, centre)`` Column function replaces the squared
    Euclidean one.  Vectors of another size than the centres, NULL ones and
    NULL components fail the job, whatever the size of the model.
    """
    if clash := {"cluster", "sq_distance"} & set(points.columns):
        raise ValueError(f"points already have columns {sorted(clash)}")
    model = centers if isinstance(centers, _Model) else _collect_model(centers)
    if not model.ids:
        raise ValueError("no centres")
    if distance is not None or len(model.ids) * model.dims <= UNROLL_TERMS:
        x = F.col(features)
        if distance is None:
            best = F.array_min(F.array(*[F.struct(
                checked(unrolled_sq_dist(x, c), x, model.dims).alias("d"), F.lit(i).cast("int").alias("i"))
                for i, c in model.rows()]))
        else:  # one expression over an array of centres: the plan does not grow with their number
            table = F.lit(model.values).cast("array<array<double>>")
            ids = F.lit(model.ids).cast("array<int>")
            best = F.array_min(F.transform(F.arrays_zip(table.alias("c"), ids.alias("i")), lambda s: F.struct(
                checked(F.when(F.forall(x, lambda v: v.isNotNull()), distance(x, s["c"]).cast("double")), x, model.dims).alias("d"), s["i"].alias("i"))))
        return points.withColumn("_best", best).select(
            *points.columns, F.col("_best.i").alias("cluster"), F.col("_best.d").alias("sq_distance"))

    dims = model.dims
    out = T.StructType(points.schema.fields + [
        T.StructField("cluster", T.IntegerType()), T.StructField("sq_distance", T.DoubleType())])
    df = points
    for ids, values in _blocks(model):
        block_ids, block = np.array(ids, dtype=np.int32), np.array(values)

        def run(batches, block_ids=block_ids, block=block):
            for b in batches:
                index, d2 = _nearest_numpy(batch_matrix(b.column(features), dims), block)
                cluster = block_ids[index]
                names = b.schema.names
                cols = b.columns
                if "sq_distance" in names:  # a previous block already chose a centre
                    old = b.column("sq_distance").to_numpy(zero_copy_only=False)
                    keep = old <= d2
                    cluster = np.where(keep, b.column("cluster").to_numpy(zero_copy_only=False), cluster)
                    d2 = np.where(keep, old, d2)
                    names, cols = names[:-2], cols[:-2]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(cluster.astype(np.int32)), pa.array(d2)],
                    [*names, "cluster", "sq_distance"])

        df = df.mapInArrow(run, out)
    return df


def assign(points: DataFrame, centers: DataFrame, features: str = "features",
           distance: Distance | None = None) -> DataFrame:
    """Nearest centre of each point with its distance."""
    df = nearest(points, centers, features, distance)
    dist = F.col("sq_distance") if distance is not None else F.sqrt("sq_distance")
    return df.withColumn("distance", dist).drop("sq_distance")


def _by_batches(model: _Model, distance: Distance | None) -> bool:
    """Whether rounds run on batches: a model too large to unroll, and small enough to travel at once."""
    return distance is None and UNROLL_TERMS < len(model.ids) * model.dims <= MODEL_BLOCK_VALUES


def _packed(df: DataFrame, dims: int, features: str) -> DataFrame:
    """(x, h): a batch of points as one row of plain numbers, so a round neither builds nor reads rows of arrays; 4 bytes a number if none needs more."""

    def run(batches):
        for b in batches:
            x = batch_matrix(b.column("features"), dims)
            with np.errstate(over="ignore"):
                short = x.astype(np.float32)
            x = short if np.array_equal(x, short.astype(np.float64)) else x
            h = b.column("h").to_numpy(zero_copy_only=False)
            step = max(1, PACKED_BYTES // (8 * max(dims, 1)))
            for lo in range(0, len(x), step):
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v[lo:lo + step]).tobytes()], pa.binary()) for v in (x, h)], ["x", "h"])

    return df.select(F.col(features).alias("features"), F.xxhash64("row_id").alias("h")).mapInArrow(run, "x binary, h binary")


def _nearest_fast(x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The index that ``_nearest_numpy`` gives: by one matrix product, and from the differences where rounding could decide."""
    norms = np.einsum("ij,ij->i", values, values)
    rest = norms - 2.0 * (x @ values.T)
    index = rest.argmin(axis=1)
    if len(values) > 1:
        two = np.partition(rest, 1, axis=1)
        size = np.einsum("ij,ij->i", x, x) + norms.max()
        close = np.flatnonzero(~(two[:, 1] - two[:, 0] > (1e-12 + 1e-15 * x.shape[1]) * size))
        if len(close):
            index[close], _ = _nearest_numpy(x[close], values)
    return index


def _partials(df: DataFrame, model: _Model, features: str, distance: Distance | None) -> DataFrame:
    """(cluster, n, fingerprint, pos, total) rows for the next centres; ``df`` are points, or batches of ``_packed``."""
    dims = model.dims
    if _by_batches(model, distance):
        ids, values = np.array(model.ids, dtype=np.int32), np.array(model.values)

        def run(batches):
            k = len(ids)
            n, mark, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dims))
            for b in batches:
                for xs, hs in zip(b.column("x"), b.column("h")):
                    h = np.frombuffer(hs.as_buffer(), np.int64)
                    raw = xs.as_buffer()
                    x = np.frombuffer(raw, np.float32 if raw.size == 4 * dims * len(h) else np.float64).reshape(len(h), dims).astype(np.float64)
                    index = _nearest_fast(x, values)
                    n += np.bincount(index, minlength=k)
                    np.bitwise_xor.at(mark, index, h)
                    for i in np.unique(index):
                        total[i] += x[index == i].sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(n), pa.array(mark), pa.array(list(total), pa.list_(pa.float64()))],
                ["cluster", "n", "mark", "total"])

        packed = df if df.columns == ["x", "h"] else _packed(df, dims, features)
        part = packed.mapInArrow(run, "cluster int, n long, mark long, total array<double>").where("n > 0")
        sums = part.select("cluster", "n", "mark", F.posexplode("total").alias("pos", "x"))
        return sums.groupBy("cluster", "pos").agg(
            F.sum("n").alias("n"), F.bit_xor("mark").alias("mark"), F.sum("x").alias("x"))
    hashed = df.select(F.col(features).alias("features"), F.xxhash64("row_id").alias("h"))
    near = nearest(hashed, model, "features", distance)
    x = F.col("features")
    if dims > UNROLL_TERMS:  # long form: one sum, however wide the vectors are
        return near.select("cluster", "h", F.posexplode(x).alias("pos", "x")).groupBy("cluster", "pos").agg(
            F.count("*").alias("n"), F.bit_xor("h").alias("mark"), F.sum("x").alias("x"))
    agg = near.groupBy("cluster").agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("mark"), *[F.sum(x[j]).alias(f"s{j}") for j in range(dims)])
    total = F.array(*[F.col(f"s{j}") for j in range(dims)])
    return agg.select("cluster", "n", "mark", F.posexplode(total).alias("pos", "x"))


def _lloyd_round(df: DataFrame, model: _Model, features: str, empty: str,
                 distance: Distance | None) -> tuple[_Model, dict]:
    """One round: new centres and a fingerprint of who belongs where."""
    sums: dict[int, list] = {}
    for r in _partials(df, model, features, distance).collect():  # k * d rows
        entry = sums.setdefault(r["cluster"], [r["n"], r["mark"], [0.0] * model.dims])
        entry[2][r["pos"]] = r["x"] / r["n"]
    rows = []
    for i, old in model.rows():
        if i in sums:
            rows.append((i, sums[i][2]))
        elif empty == "keep":
            rows.append((i, old))
    return _Model(rows), {i: (n, mark) for i, (n, mark, _) in sums.items()}


def lloyd_step(points: DataFrame, centers: DataFrame, features: str = "features") -> DataFrame:
    """Centres after one round as (cluster, n, center); empty clusters are absent."""
    model = _collect_model(centers)
    parts = _partials(points, model, features, None)
    mean = F.struct("pos", (F.col("x") / F.col("n")).alias("mean"))
    vec = F.array_sort(F.collect_list(mean))["mean"]  # d entries per cluster
    return parts.groupBy("cluster").agg(F.max("n").alias("n"), vec.alias("center"))


def distinct_centers(points: DataFrame) -> DataFrame:
    """Starting centres = distinct values of the ``center`` column, numbered in value order."""
    distinct = sorted(tuple(r["center"]) for r in points.select("center").distinct().collect())
    return _Model(list(enumerate([list(c) for c in distinct]))).frame(points.sparkSession)


def kmeans(points: DataFrame, centers: DataFrame, iterations: int | None = None, dedupe: bool = False,
           empty: str | None = None, features: str = "features",
           distance: Distance | None = None, tol: float | None = None) -> Clustering:
    """k-means from given centres.

    ``iterations=None`` runs until no point changes its cluster; a number runs
    exactly that many rounds.  With ``tol`` a run also ends after the first round that moves no centre
    farther than that (and drops none).  ``dedupe`` lets equal points weigh once.  A
    cluster that loses all points keeps its centre (``empty='keep'``) or
    vanishes (``'drop'``, the default together with ``dedupe``).
    """
    if iterations is not None and iterations < 0:
        raise ValueError("iterations must not be negative")
    empty = empty or ("drop" if dedupe else "keep")
    model = _collect_model(centers)
    df = points.select("row_id", features)
    if dedupe:
        df = df.groupBy(features).agg(F.min("row_id").alias("row_id"))
    # where clusters may vanish, a later model can be small enough to unroll: it needs the points
    df = (_packed(df, model.dims, features) if _by_batches(model, distance) and empty == "keep" else df).persist()
    rounds, last = 0, None
    try:
        while iterations is None or rounds < iterations:
            old = model
            model, mark = _lloyd_round(df, model, features, empty, distance)
            rounds += 1
            if tol is not None and old.ids == model.ids and _farthest_move(old, model) <= tol:
                break
            if mark == last:  # same members as before: the centres cannot move again
                break
            last = mark
    finally:
        df.unpersist()
    spark = points.sparkSession
    final = nearest(points, model, features, distance)
    dist = F.col("sq_distance") if distance is not None else F.sqrt("sq_distance")
    return Clustering(model.frame(spark), final.withColumn("distance", dist).drop("sq_distance"), rounds)


def kmeans_pp_init(points: DataFrame, k: int, seed: int = 0, init: str = "d2", first: str = "random",
                   portable: bool = False, features: str = "features",
                   distance: Distance | None = None) -> DataFrame:
    """k starting centres, numbered from 1.

    ``init='d2'`` draws each next centre with probability proportional to the
    squared distance to the nearest chosen one; ``'farthest'`` takes the
    farthest point.  Each draw is one scan ending in a one-row aggregate.
    A scan measures only the centres drawn since the distances so far were
    last written (every ``FOLD`` draws).  Fewer than k distinct points give
    fewer centres.
    """
    if init not in ("d2", "farthest") or first not in ("random", "first"):
        raise ValueError("init is 'd2' or 'farthest', first is 'random' or 'first'")
    df = points.select("row_id", F.col(features).alias("features"), F.lit(float("inf")).alias("_so_far")).persist()
    folded = None  # the table of the distances so far
    try:
        if first == "random":
            row = random_row(df, seed, "row_id", portable).first()
        else:
            row = df.agg(F.min_by(F.struct("row_id", "features"), "row_id").alias("r")).where(
                "r is not null").select("r.*").first()
        chosen = [] if row is None else [(1, row["features"])]
        done = 0  # centres whose distances are in _so_far
        while chosen and len(chosen) < k:
            near = nearest(df if folded is None else folded, _Model(chosen[done:]), "features", distance).select(
                "row_id", "features", F.least("_so_far", "sq_distance").alias("_so_far"))
            if len(chosen) - done >= FOLD:
                done, old = len(chosen), folded
                near = folded = durable(near)
                discard(old)
            d2 = F.col("_so_far") if distance is None else F.col("_so_far") * F.col("_so_far")
            near = near.withColumn("_w", d2).where("_w > 0")
            if init == "d2":
                u = uniform("row_id", seed, f"d{len(chosen)}", portable)
                key = F.struct(race_key(F.col("_w"), u), F.col("row_id"))
            else:
                key = F.struct(-F.col("_w"), F.col("row_id"))
            row = near.agg(F.min_by("features", key).alias("c")).first()
            if row["c"] is None:
                break
            chosen.append((len(chosen) + 1, row["c"]))
    finally:
        df.unpersist()
        discard(folded)
    return _Model(chosen).frame(points.sparkSession)


def kmeans_pp(points: DataFrame, k: int, iterations: int, seed: int = 0, init: str = "d2",
              first: str = "random", portable: bool = False, features: str = "features",
              distance: Distance | None = None) -> Clustering:
    """k-means++ start followed by a fixed number of rounds; empty clusters vanish."""
    centers = kmeans_pp_init(points, k, seed, init, first, portable, features, distance)
    return kmeans(points, centers, iterations, empty="drop", features=features, distance=distance)
