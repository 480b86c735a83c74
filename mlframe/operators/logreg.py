"""Logistic regression without intercept, labels 0/1, weights start at 0."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from mlframe.functions.rng import exact_sample, uniform
from mlframe.functions.vec import add_all, batch_matrix, checked, sigmoid, unrolled_dot
from mlframe.runtime import UNROLL_TERMS, discard, durable

# Fewest rows of a batch of stochastic descent when the caller names no size.
LEAST_BATCH = 1024
# More batches than this are not a job each: runs of them are, of so many numbers (32 MB).
STEP_JOBS = 64
RUN_VALUES = 4_000_000


def _dims(points: DataFrame) -> int:
    row = points.agg(F.min(F.size("features")).alias("lo"), F.max(F.size("features")).alias("hi")).first()
    if row["lo"] is None:
        raise ValueError("no training rows")
    if row["lo"] != row["hi"]:
        raise ValueError("vectors differ in size")
    return row["lo"]


def _wide(points: DataFrame, dims: int, *extra: str) -> DataFrame:
    """One primitive column per feature: null-free, compactly cached, short generated code.

    The size of a vector is looked at once, with its first component; each component only for NULL.
    """
    x = F.col("features")
    null = F.raise_error(F.lit(f"vectors differ in size from {dims} or hold NULL")).cast("double")
    rest = [F.coalesce(F.get(x, F.lit(j)), null).alias(f"x{j}") for j in range(1, dims)]
    first = [checked(F.get(x, F.lit(0)), x, dims).alias("x0")] if dims else []
    return points.select(*extra, F.col("label").cast("double").alias("y"), *first, *rest)


def gradient(df: DataFrame, theta: list[float]) -> DataFrame:
    """Sum of (sigmoid(theta.x) - y) * x and the row count, in one partial + final aggregate."""
    dims = len(theta)
    if dims <= UNROLL_TERMS:
        z = add_all([F.col(f"x{j}") * F.lit(float(t)) for j, t in enumerate(theta)])
        err = df.withColumn("_e", sigmoid(z) - F.col("y"))
        return err.agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(F.col("_e") * F.col(f"x{j}")) for j in range(dims)]).alias("g"))

    weights = np.array(theta)

    def run(batches):
        n, g = 0, np.zeros(dims)
        for b in batches:
            x = batch_matrix(b.column("features"), dims)
            with np.errstate(over="ignore"):
                e = 1.0 / (1.0 + np.exp(-(x @ weights))) - b.column("y").to_numpy(zero_copy_only=False)
            n += len(x)
            g += e @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([list(g)], pa.list_(pa.float64()))], ["n", "g"])

    part = df.select("y", "features").mapInArrow(run, "n long, g array<double>")
    rows = part.select("n", F.posexplode("g").alias("pos", "v")).groupBy("pos").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v"))
    return rows.agg(F.max("n").alias("n"),
                    F.array_sort(F.collect_list(F.struct("pos", "v")))["v"].alias("g"))


def _prepare(points: DataFrame, dims: int, *extra: str) -> DataFrame:
    if dims <= UNROLL_TERMS:
        return _wide(points, dims, *extra)
    return points.select(*extra, F.col("label").cast("double").alias("y"), "features")


def logreg_fit(points: DataFrame, alpha: float, iterations: int, theta0: list[float] | None = None) -> list[float]:
    """Batch gradient descent: theta -= alpha/n * sum of gradients, for a fixed number of rounds.

    One aggregate job per round over the cached features; only d numbers come back.
    """
    dims = len(theta0) if theta0 is not None else _dims(points)
    theta = [float(t) for t in theta0] if theta0 is not None else [0.0] * dims
    df = _prepare(points, dims).persist()
    try:
        for _ in range(iterations):
            row = gradient(df, theta).first()
            if row["n"] == 0:
                raise ValueError("no training rows")
            theta = [t - alpha * g / row["n"] for t, g in zip(theta, row["g"])]
    finally:
        df.unpersist()
    return theta


def logreg_fit_sgd(points: DataFrame, alpha: float, iterations: int, subset: int = 0, batch: int | None = None,
                   seed: int = 0, portable: bool = False, steps: int = 64) -> list[float]:
    """Mini-batch gradient descent over the first ``subset`` rows of a seeded shuffle.

    Row-by-row updates are serial by nature.  Here an epoch visits hash-drawn batches
    in turn and steps by the mean gradient of each, which reaches the same optimum but
    not the same digits.  An epoch is at most ``steps`` jobs, so batches grow with the
    data from ``LEAST_BATCH`` rows on; ``batch`` asks for batches of about so many rows
    instead, however many jobs that takes.  Needs ``row_id``.
    """
    if steps < 1 or batch is not None and batch < 1:
        raise ValueError("steps and batch must be positive")
    dims = _dims(points)
    if subset > 0:
        points = exact_sample(points, subset, uniform("row_id", seed, "shuffle", portable), "row_id")
        total = subset
    else:
        total = points.count()
    n_batches = max(1, -(-total // (batch or LEAST_BATCH)))
    if batch is None:
        n_batches = min(n_batches, steps)
    b = F.floor(uniform("row_id", seed, "batch", portable) * n_batches).cast("int")
    df = _prepare(points.withColumn("_b", b), dims, "_b")
    theta = [0.0] * dims
    if n_batches > STEP_JOBS and batch is not None:
        runs = _runs(df, n_batches, total // n_batches * (dims + 1))
        try:
            for _ in range(iterations):
                for i in range(-(-n_batches // runs.batches)):
                    theta = runs.descend(i, theta, alpha)
        finally:
            discard(runs.rows)
        return theta
    # sorted by batch, so the cached blocks carry min/max statistics that skip other batches
    df = (df.sortWithinPartitions("_b") if n_batches > 1 else df).persist()
    try:
        for _ in range(iterations):
            for i in range(n_batches):
                row = gradient(df.where(F.col("_b") == i) if n_batches > 1 else df, theta).first()
                if row["n"]:
                    theta = [t - alpha * g / row["n"] for t, g in zip(theta, row["g"])]
    finally:
        df.unpersist()
    return theta


class _runs:
    """Rows in runs of whole batches, a folder each: one job walks through the batches of a run, as each starts from the last one's weights.

    Each run is bounded in numbers, so the only task that holds it, batch by batch, is too.
    """

    def __init__(self, df: DataFrame, n_batches: int, batch_values: int):
        self.batches = max(1, RUN_VALUES // max(batch_values, 1))
        run = F.floor(F.col("_b") / self.batches).cast("int")
        # two runs' rows never share a file, and the rows of a run stand in the order of their batches
        placed = df.withColumn("_run", run).repartition("_run").sortWithinPartitions("_run", "_b")
        self.rows = durable(placed, "_run", release=True)

    def descend(self, i: int, theta: list[float], alpha: float) -> list[float]:
        """The weights after the batches of run ``i``."""
        dims, start, wide = len(theta), list(theta), "features" not in self.rows.columns

        def walk(batches):
            w, now, n, g = np.array(start), None, 0, np.zeros(dims)
            for b in batches:
                marks = b.column("_b").to_numpy(zero_copy_only=False)
                if wide:
                    x = np.array([b.column(f"x{j}").to_numpy(zero_copy_only=False) for j in range(dims)]).reshape(dims, len(marks)).T
                else:
                    x = batch_matrix(b.column("features"), dims)
                y = b.column("y").to_numpy(zero_copy_only=False)
                known = b.column("y").is_valid().to_numpy(zero_copy_only=False) | (not wide)  # as sums pass over NULL
                cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
                for lo, hi in zip(cuts, cuts[1:]):
                    if lo == hi:
                        continue
                    if marks[lo] != now:
                        w, now, n, g = w - alpha * g / max(n, 1), marks[lo], 0, np.zeros(dims)
                    with np.errstate(over="ignore"):
                        e = 1.0 / (1.0 + np.exp(-(x[lo:hi] @ w))) - y[lo:hi]
                    n += hi - lo
                    g = g + e[known[lo:hi]] @ x[lo:hi][known[lo:hi]]
            yield pa.RecordBatch.from_arrays([pa.array([list(w - alpha * g / max(n, 1))], pa.list_(pa.float64()))], ["theta"])

        cols = ["_b", "y", *([f"x{j}" for j in range(dims)] if wide else ["features"])]
        # a run's files are brought to one task and put in order of their batches there
        rows = self.rows.where(F.col("_run") == i).select(*cols).coalesce(1).sortWithinPartitions("_b")
        row = rows.mapInArrow(walk, "theta array<double>").first()
        return theta if row is None else list(row["theta"])


def logreg_predict(points: DataFrame, theta: list[float]) -> DataFrame:
    """Append ``probability`` and ``prediction``; row-wise, also usable on a stream.

    Vectors of another size than theta, NULL ones and NULL components fail the job.
    """
    dims = len(theta)
    if clash := {"probability", "prediction"} & set(points.columns):
        raise ValueError(f"points already have columns {sorted(clash)}")
    if dims <= UNROLL_TERMS:
        x = F.col("features")
        scored = points.withColumn("probability", sigmoid(checked(unrolled_dot(x, theta), x, dims)))
    else:
        weights = np.array(theta, dtype=float)

        def run(batches):
            for b in batches:
                with np.errstate(over="ignore"):
                    p = 1.0 / (1.0 + np.exp(-(batch_matrix(b.column("features"), dims) @ weights)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], [*b.schema.names, "probability"])

        scored = points.mapInArrow(run, T.StructType(points.schema.fields + [T.StructField("probability", T.DoubleType())]))
    return scored.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


def theta_frame(spark, theta: list[float]) -> DataFrame:
    return spark.createDataFrame([([float(t) for t in theta],)], "theta array<double>")
