"""Position-addressable random numbers and seeded samples.

A number depends only on (seed, stream, id), so results do not change with
partitioning, retries or lost executors, which ``rand()`` cannot promise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

SMALLEST = 2.0 ** -33  # half a step of the 32-bit form; keeps ln(0) away


def uniform(id_col: Column | str, seed: int, stream: Column | int | str = 0, portable: bool = False) -> Column:
    """Uniform number in [0, 1) for a row id.

    ``portable`` uses an md5 prefix (32 bits), which other SQL engines can
    reproduce; the default uses the faster xxhash64 (53 bits).
    """
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    stream = stream if isinstance(stream, Column) else F.lit(stream)
    if portable:
        key = F.concat_ws(":", F.lit(str(seed)), stream.cast("string"), id_col.cast("string"))
        return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(int(seed)), stream, id_col), 11)
    return bits / F.lit(float(2 ** 53))


def uniform_int(id_col: Column | str, k: int, seed: int, stream: Column | int | str = 0,
                portable: bool = False) -> Column:
    """Uniform integer in [0, k)."""
    return F.floor(uniform(id_col, seed, stream, portable) * k).cast("int")


def gaussian(id_col: Column | str, seed: int, stream: str, portable: bool = False) -> Column:
    """Standard normal number (Box-Muller on two uniform streams)."""
    u1 = uniform(id_col, seed, f"{stream}a", portable) + F.lit(SMALLEST)
    u2 = uniform(id_col, seed, f"{stream}b", portable)
    return F.sqrt(-2.0 * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def bernoulli(df: DataFrame, frac: float, seed: int, id_col: str, portable: bool = False) -> DataFrame:
    """Keep each row with probability ``frac``."""
    return df.where(uniform(id_col, seed, "bernoulli", portable) < frac)


def first_by_id(df: DataFrame, id_col: str) -> DataFrame:
    """One row: the one with the smallest id (a limit-1 with a fixed order)."""
    cols = df.columns
    return df.agg(F.min_by(F.struct(*cols), F.col(id_col)).alias("r")).where("r is not null").select("r.*")


def random_row(df: DataFrame, seed: int, id_col: str, portable: bool = False) -> DataFrame:
    """One row drawn uniformly: the smallest (u, id)."""
    u = uniform(id_col, seed, "row", portable)
    return (
        df.agg(F.min_by(F.struct(*df.columns), F.struct(u, F.col(id_col))).alias("r"))
        .where("r is not null").select("r.*")
    )


def race_key(weight: Column, u: Column) -> Column:
    """Exponential race: the smallest key wins with probability proportional to ``weight``."""
    return -F.ln(u + F.lit(SMALLEST)) / weight


def weighted_pick(df: DataFrame, weight: str, seed: int, id_col: str, stream: Column | int | str = "pick",
                  portable: bool = False) -> DataFrame:
    """One row drawn with probability proportional to a non-negative weight, in a single aggregate."""
    live = df.where(F.col(weight) > 0)
    key = race_key(F.col(weight), uniform(id_col, seed, stream, portable))
    return (
        live.agg(F.min_by(F.struct(*df.columns), F.struct(key, F.col(id_col))).alias("r"))
        .where("r is not null").select("r.*")
    )


def cut_points(df: DataFrame, size: int, u: Column, id_col: str, by: list[str] | None = None,
               buckets: int = 4096) -> DataFrame:
    """Per group of ``by`` the ``size``-th smallest (u, id) as ``cut`` (the largest one in smaller groups).

    A histogram of ``u`` finds the bucket holding the cut and only that
    bucket's rows are ranked, so no task sees a whole group: a window
    partition here has at most ``buckets`` rows, or group/``buckets`` rows.
    """
    by = by or []
    key = F.struct(F.col("_u").alias("u"), F.col(id_col).alias("id"))
    tagged = df.select(*by, id_col, u.alias("_u")).withColumn("_bucket", F.floor(F.col("_u") * buckets).cast("int"))
    hist = tagged.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"), F.max(key).alias("_top"))
    order = Window.partitionBy(*by).orderBy("_bucket")
    hist = hist.withColumn("_before", F.sum("_n").over(order) - F.col("_n")).where(F.col("_before") < size)
    last = hist.groupBy(*by).agg(F.max(F.struct("_bucket", "_before", "_n", "_top")).alias("b")).select(*by, "b.*")
    done = last.where(F.col("_before") + F.col("_n") <= size).select(*by, F.col("_top").alias("cut"))
    open_ = last.where(F.col("_before") + F.col("_n") > size).select(
        *by, "_bucket", (F.lit(size) - F.col("_before")).alias("_take"))
    rank = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_u", id_col))
    inside = tagged.join(open_, by + ["_bucket"]).withColumn("_r", rank).where("_r = _take")
    return done.unionByName(inside.select(*by, key.alias("cut")))


def exact_sample(df: DataFrame, size: int, u: Column, id_col: str, by: list[str] | None = None) -> DataFrame:
    """Exactly ``size`` rows with the smallest (u, id), per group of ``by`` (all rows of smaller groups)."""
    by = by or []
    cut = cut_points(df, size, u, id_col, by)
    below = F.struct(u.alias("u"), F.col(id_col).alias("id")) <= F.col("cut")
    # one row per group
    joined = df.join(cut, by) if by else df.crossJoin(F.broadcast(cut))
    return joined.where(below).select(*df.columns)


def shuffled_subset(df: DataFrame, size: int, seed: int, id_col: str, portable: bool = False) -> DataFrame:
    """The first ``size`` rows of a seeded shuffle; ``size <= 0`` keeps every row."""
    if size <= 0:
        return df
    return exact_sample(df, size, uniform(id_col, seed, "shuffle", portable), id_col)


def feature_subset(df: DataFrame, n_features: int, m: int, seed: int, by: list[str],
                   portable: bool = False) -> DataFrame:
    """Add ``features_used``: ``m`` distinct feature numbers drawn per row of ``by`` keys."""
    m = max(1, min(m, n_features))
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in by])
    ranked = F.array_sort(F.array(*[
        F.struct(uniform(key, seed, f"feature{f}", portable).alias("u"), F.lit(f).alias("f"))
        for f in range(n_features)
    ]))
    return df.withColumn("features_used", F.slice(ranked, 1, m)["f"])
