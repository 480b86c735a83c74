"""Vector and scalar functions as Column expressions (vectors are ``array<double>``)."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F


def _same_size(a: Column, b: Column, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value).otherwise(
        F.raise_error(F.lit("vectors differ in size"))
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two vectors."""
    return _same_size(a, b, _total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(sq_dist(a, b))


def dot(a: Column, b: Column) -> Column:
    return _same_size(a, b, _total(F.zip_with(a, b, lambda x, y: x * y)))


def vadd(a: Column, b: Column) -> Column:
    return _same_size(a, b, F.zip_with(a, b, lambda x, y: x + y))


def vsub(a: Column, b: Column) -> Column:
    return _same_size(a, b, F.zip_with(a, b, lambda x, y: x - y))


def vscale(a: Column, r: Column | float) -> Column:
    r = r if isinstance(r, Column) else F.lit(float(r))
    return F.transform(a, lambda x: x * r)


def vnorm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(a, lambda x: x * x)))


def velement(a: Column, index: int) -> Column:
    """Component at a 0-based index; an index outside the vector is an error under ANSI mode."""
    return a[index]


def vequal(a: Column, b: Column) -> Column:
    """Equality by value."""
    return a == b


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two arrays read as sets; two empty sets give 0."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(F.array_union(a, b))
    return F.when(total > 0, shared / F.greatest(total, F.lit(1))).otherwise(0.0)


def pack(values: Column, sep: str) -> Column:
    """Join an array to one delimited string."""
    return F.array_join(values.cast("array<string>"), sep)


def unpack(text: Column, sep: str) -> Column:
    """Split a delimited string, trimming parts and dropping empty ones."""
    parts = F.transform(F.split(text, re.escape(sep)), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def checked(value: Column, features: Column, dims: int) -> Column:
    """``value``, computed from ``features``; an error unless they have ``dims`` components and none is NULL.

    ``value`` must be NULL only if a component is.
    """
    bad = F.raise_error(F.lit(f"vectors differ in size from {dims} or hold NULL")).cast("double")
    return F.coalesce(F.when(F.size(features) == dims, value), bad)


def batch_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of an Arrow batch as a matrix; the same error as ``checked``, decided row by row."""
    flat = column.flatten()
    sizes = pc.list_value_length(column)
    if column.null_count or flat.null_count or (len(column) and not pc.all(pc.equal(sizes, dims)).as_py()):
        raise ValueError(f"vectors differ in size from {dims} or hold NULL")
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dims)


def add_all(terms: list[Column]) -> Column:
    """Left-to-right sum of a list of expressions."""
    return reduce(lambda a, b: a + b, terms)


def unrolled_sq_dist(features: Column, center: list[float]) -> Column:
    """Squared distance to a fixed point, one generated term per dimension."""
    return add_all(
        [(features[j] - F.lit(float(c))) * (features[j] - F.lit(float(c))) for j, c in enumerate(center)]
    )


def unrolled_dot(features: Column, weights: list[float]) -> Column:
    return add_all([features[j] * F.lit(float(w)) for j, w in enumerate(weights)])
