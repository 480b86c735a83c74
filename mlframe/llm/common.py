"""Helpers shared by the corpus operators: words, row groups in Arrow streams, ordered totals, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mlframe.runtime import discard, durable

# Words are runs of anything but space and \t \n \v \f \r; on UTF-8 bytes that is bytes.split().
SPACE = r"[\x20\x09-\x0D]+"
# Texts of one Arrow batch are handled in slices of about this many bytes, so arrays stay small.
SLICE_BYTES = 2_000_000
# Runs of letters are hashed and compared in blocks of about so many letters, each of which takes a few 64-bit numbers meanwhile.
RUN_BYTES = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where a column of ``df`` already has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; 0 for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words, in the JVM; null counts as empty."""
    words = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def raw(column: pa.Array) -> list:
    """The UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of about ``size`` bytes of text; a longer text is a range of its own."""
    sizes = np.array([0 if x is None else x for x in pc.binary_length(batch.column(text)).to_pylist()])
    block = (np.cumsum(sizes) - sizes) // size
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
    for a, b in zip(starts, [*starts[1:], len(block)]):
        yield batch.slice(a, b - a)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all given ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


_WEIGHTS = np.random.default_rng(5).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def run_blocks(sizes: np.ndarray) -> Iterator[slice]:
    """Neighbouring runs of about RUN_BYTES in all, so that their letters' 64-bit numbers stay small; a longer run is a block of its own."""
    ends = np.cumsum(sizes)
    block = (ends - sizes) // RUN_BYTES
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]).tolist() if len(block) else []
    return map(slice, starts, [*starts[1:], len(block)])


def run_hashes(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, weights: np.ndarray = _WEIGHTS) -> np.ndarray:
    """64-bit hashes of runs (words) of a flat array, none of them empty."""
    out = np.zeros(len(starts), np.uint64)
    for part in run_blocks(sizes):
        n = sizes[part]
        place = ranges(np.zeros(len(n), np.int64), n)
        own = codes[place + np.repeat(starts[part], n)]
        with np.errstate(over="ignore"):
            mixed = (own.astype(np.uint64) + np.uint64(1)) * weights[place & 63]
            if place.max() > 63:
                mixed *= ((place >> 6) + 1).astype(np.uint64)
            mixed ^= mixed >> np.uint64(29)
            out[part] = np.add.reduceat(mixed * np.uint64(0x9E3779B97F4A7C15), np.cumsum(n) - n) + n.astype(np.uint64)
    return out


def kinds(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each different value, in the order of values, and the number of every value's kind."""
    order = np.argsort(values)
    new = np.r_[True, np.diff(values[order]) != 0]
    of = np.empty(len(values), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def equal_runs(codes: np.ndarray, starts: np.ndarray, others: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which runs of ``codes`` hold the same as those of ``others``, run by run, of the same sizes."""
    out = np.zeros(len(starts), bool)
    for part in run_blocks(sizes):
        n = sizes[part]
        out[part] = np.logical_and.reduceat(codes[ranges(starts[part], n)] == others[ranges(at[part], n)], np.cumsum(n) - n)
    return out


def distinct_runs(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, weights: np.ndarray = _WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """One of each kind among runs (words) of a flat array, and the kind of every run.

    Runs are told apart by a 64-bit hash and then by their content; if two kinds share a hash, every run counts as its own kind.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    which, of = kinds(run_hashes(codes, starts, sizes, weights))
    other = which[of]
    if (sizes[other] == sizes).all() and equal_runs(codes, starts, codes, starts[other], sizes).all():
        return which, of
    return np.arange(len(starts)), np.arange(len(starts))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup a stream sorted by ``keys`` so that no group is cut; a group must fit in memory."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        first, last = batch.slice(0, 1).select(keys), batch.slice(batch.num_rows - 1, 1).select(keys)
        if held and not held[-1].slice(held[-1].num_rows - 1, 1).select(keys).equals(first):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        held.append(batch)
        if last.equals(first):
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        cut = int(np.flatnonzero(group_starts(whole, keys))[-1])
        yield whole.slice(0, cut)
        held = whole.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Flags the first row of each run of equal keys."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = rows.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return new


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)`` as ``node, root``; only nodes with an edge appear.

    Each round every node moves to the member of its closed neighbourhood that comes first in an order drawn anew for the
    round, and edges are contracted; the number of rounds is logarithmic.  Nothing is collected and every round is a table
    in the shared folder.
    """
    live = durable(edges.select("a", "b").where("a <> b").distinct())
    moves: list[DataFrame] = []
    while not live.isEmpty():
        both = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(moves)), c).alias("h"), c.alias("v"))  # noqa: B023, E731
        move = durable(both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
                       .select(F.col("a").alias("node"), F.least(F.col("m"), rank(F.col("a"))).getField("v").alias("to")))
        near, far = move.toDF("a", "ra"), move.toDF("b", "rb")
        rest = durable(live.join(near, "a").join(far, "b").where("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        discard(live)
        live = rest
        moves.append(move)
    discard(live)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    out = moves[-1].toDF("node", "root")
    for move in reversed(moves[:-1]):
        nxt = out.toDF("to", "nxt")
        out = move.join(nxt, "to", "left").select("node", F.coalesce("nxt", "to").alias("root"))
    return out
