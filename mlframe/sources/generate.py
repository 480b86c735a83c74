"""Synthetic data.  Generators number their rows through an id column, so any table of
ids (or ``spark.range``) can be turned into points, independent of partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mlframe.functions.rng import gaussian, uniform


def row_ids(spark: SparkSession, n: int = 1000) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("row_id"))


def _corner(dims: int, scale: int, seed: int, portable: bool) -> Column:
    return F.array(*[
        F.when(uniform("row_id", seed, f"corner{j}", portable) < 0.5, 0).otherwise(scale).cast("int")
        for j in range(dims)
    ])


def _finish(ids: DataFrame, dims: int) -> DataFrame:
    return ids.select(
        "row_id",
        F.array(*[F.col("_off")[j] + F.col("center")[j] for j in range(dims)]).alias("features"),
        "center",
        F.array_join(F.col("center").cast("array<string>"), "|").alias("label"),
    )


def random_sphere(ids: DataFrame, dims: int = 3, scale: int = 100, seed: int = 0,
                  portable: bool = False) -> DataFrame:
    """Points on spheres of radius sqrt(scale) around random corners of {0, scale}^dims."""
    radius = math.sqrt(scale)
    g = F.array(*[gaussian("row_id", seed, f"g{j}", portable) for j in range(dims)])
    norm = F.sqrt(sum((F.col("_g")[j] * F.col("_g")[j] for j in range(1, dims)), F.col("_g")[0] * F.col("_g")[0]))
    off = F.array(*[F.col("_g")[j] / F.col("_n") * radius for j in range(dims)])
    df = ids.select("row_id", _corner(dims, scale, seed, portable).alias("center"), g.alias("_g"))
    return _finish(df.withColumn("_n", norm).withColumn("_off", off), dims)


def random_hypercube(ids: DataFrame, dims: int = 3, scale: int = 100, seed: int = 0,
                     portable: bool = False) -> DataFrame:
    """Points uniform within +-sqrt(scale) per axis around random corners of {0, scale}^dims."""
    radius = math.sqrt(scale)
    off = F.array(*[
        (uniform("row_id", seed, f"h{j}", portable) * 2.0 - 1.0) * radius for j in range(dims)
    ])
    df = ids.select("row_id", _corner(dims, scale, seed, portable).alias("center"), off.alias("_off"))
    return _finish(df, dims)


def labels_1d(ids: DataFrame, s: float, seed: int = 0, portable: bool = False) -> DataFrame:
    """Uniform x with label 1 where x > s, else -1."""
    df = ids.select("row_id", F.array(uniform("row_id", seed, "x", portable)).alias("features"))
    return df.withColumn("label", F.when(F.col("features")[0] > s, "1").otherwise("-1"))


def labels_2d(ids: DataFrame, s: float, t: float, seed: int = 0, portable: bool = False) -> DataFrame:
    """Uniform (x, y) with label 1 where x > s and y > t, else -1."""
    df = ids.select("row_id", F.array(
        uniform("row_id", seed, "x", portable), uniform("row_id", seed, "y", portable)).alias("features"))
    inside = (F.col("features")[0] > s) & (F.col("features")[1] > t)
    return df.withColumn("label", F.when(inside, "1").otherwise("-1"))
