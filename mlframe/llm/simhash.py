"""SimHash near-duplicates by tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from mlframe.llm.common import components, free_names, group_starts, raw, slices, whole_groups
from mlframe.runtime import durable

SEED = 42
SEGMENTS = 4
BASES = 8
# A bucket with more fingerprints than this is compared in pairs of chunks, each a group of its own.
CHUNK = 2_048
# The rows of one fingerprint are dealt into so many parts where they meet its group.
SALTS = 16


def _references() -> tuple[list[int], list[int]]:
    """Base fingerprints and segment masks; with each base the references are base and base ^ mask of every segment."""
    bases = [xxhash.xxh64_intdigest(f"reference {i}".encode(), SEED) for i in range(BASES)]
    width = 64 // SEGMENTS
    return bases, [((1 << width) - 1) << (width * s) for s in range(SEGMENTS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _words_of(text: bytes | None, shingle: int) -> list[int]:
    words = text.lower().split() if text else []
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [digest(b" ".join(words), SEED)]
    if shingle == 3:
        return [digest(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:])]
    return [digest(b" ".join(words[i:i + shingle]), SEED) for i in range(len(words) - shingle + 1)]


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Majority bits of consecutive runs of hashes.  Eight bits at a time are summed in byte lanes, 255 rows at most."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    parts = -(-n // 255)
    owner = np.repeat(np.arange(len(full)), parts)
    inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    at = np.repeat(np.cumsum(n) - n, parts) + inner * 255
    first = np.cumsum(parts) - parts
    lanes = np.uint64(0x0101010101010101)
    bits = np.zeros(len(full), np.uint64)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, at)
        byte = np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 8).astype(np.int64)
        count = np.add.reduceat(byte, first, axis=0)
        assert len(owner) == len(sums)
        on = (2 * count > n[:, None]).astype(np.uint64)
        bits |= (on << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(k))).sum(axis=1, dtype=np.uint64)
    out[full] = bits
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes = [_words_of(t, shingle) for t in raw(part.column("text"))]
                sizes = np.array([len(h) for h in hashes], np.int64)
                flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(sizes.sum()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_majority(flat, sizes).view(np.int64)), part.column("content")],
                                                 ["doc_id", "fp", "content"])
    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, content``: the 64-bit SimHash of each text, 0 for a text without words or a null text; and ``_content``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _content(F.col("text")).alias("content")) \
        .mapInArrow(_fingerprint_batches(shingle), "doc_id long, fp long, content string")


def _content(text: Column) -> Column:
    """128 bits that stand for a text; a null text is one of its own."""
    return F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit(""))


def distance_table(fp: Column) -> list[list[Column]]:
    """Per segment, the differences of distances that the references pin down.

    ``d(x, base) - d(x, base ^ mask)`` depends on the bits of that segment alone, so it is equal for two fingerprints that
    agree there.
    """
    bases, masks = _references()
    d = lambda p: F.bit_count(fp.bitwiseXOR(F.lit(_signed(p))))
    return [[d(b) - d(b ^ m) for b in bases] for m in masks]


def _survivors(max_bits: int):
    bases, masks = _references()
    refs = np.array([p for b in bases for p in (b, *(b ^ m for m in masks))], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["key", "ca", "cb"]
        for rows in whole_groups(batches, keys):
            fp = rows.column("fp").to_numpy().view(np.uint64)
            chunk, ca, cb = (rows.column(c).to_numpy() for c in ("chunk", "ca", "cb"))
            cross = ca != cb
            starts = np.flatnonzero(group_starts(rows, keys))
            size = np.diff(np.r_[starts, len(fp)])
            left = np.repeat(starts + size, size) - np.arange(len(fp))  # rows from here to the group's end
            coords = np.stack([np.bitwise_count(fp ^ r) for r in refs], 1).astype(np.int8)
            label = np.arange(len(fp))
            found: list[tuple[int, int]] = []

            def root(i: int) -> int:
                while label[i] != i:
                    label[i] = label[label[i]]
                    i = label[i]
                return i

            at, lag = np.flatnonzero(left > 1), 1
            while len(at):
                i = at[~cross[at] | (chunk[at] != chunk[at + lag])]
                i = i[label[i] != label[i + lag]]  # linked already in this group
                for c in range(coords.shape[1]):  # the largest coordinate difference decides
                    i = i[np.abs(coords[i, c] - coords[i + lag, c]) <= max_bits]
                i = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= max_bits]
                for x in i.tolist():
                    a, b = root(x), root(x + lag)
                    if a != b:
                        label[max(a, b)] = min(a, b)
                        found.append((x, x + lag))
                if len(i):
                    while (nxt := label[label]).tolist() != label.tolist():
                        label[:] = nxt
                lag += 1
                at = at[left[at] > lag]
            x = np.array(found, np.int64).reshape(-1, 2)
            s = fp.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(s[x[:, 0]]), pa.array(s[x[:, 1]])], ["a", "b"])
    return run


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges ``a, b`` that connect every two distinct fingerprints at most ``max_bits`` apart (max_bits < SEGMENTS).

    Two such fingerprints differ in at most ``max_bits`` segments, so the coordinates of the others agree: those of each
    choice of SEGMENTS - max_bits segments are a bucket key.  Inside a bucket, pairs whose coordinate vectors differ by
    more than ``max_bits`` anywhere are discarded and the rest is verified on the bits.  A bucket sends a spanning forest
    of its links, not its pairs.  A bucket of any size is dealt in chunk pairs to many groups.
    """
    from itertools import combinations

    if not 0 <= max_bits < SEGMENTS:
        raise ValueError(f"max_bits must be from 0 to {SEGMENTS - 1}")
    coords = distance_table(F.col("fp"))
    choices = list(combinations(range(SEGMENTS), SEGMENTS - max_bits))
    keys = F.array(*[F.xxhash64(F.lit(k), *[c for s in choice for c in coords[s]]) for k, choice in enumerate(choices)])
    buckets = fps.select("fp", F.explode(keys).alias("key"))
    counts = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(
        F.least(o, F.col("chunk")).alias("ca"), F.greatest(o, F.col("chunk")).alias("cb")))
    dealt = buckets.join(counts, "key").withColumn("chunks", chunks).withColumn("chunk", own) \
        .select("key", "fp", "chunk", F.explode(cells).alias("cell")).select("key", "cell.ca", "cell.cb", "chunk", "fp")
    return dealt.repartition("key", "ca", "cb").sortWithinPartitions("key", "ca", "cb") \
        .mapInArrow(_survivors(max_bits), "a long, b long").distinct()


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp, content`` of every row (content: 128 bits of the text), and ``fp, root, component_id`` of every fingerprint."""
    fps = durable(fingerprints(docs, shingle))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct, max_bits))
    linked = durable(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    names = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps, linked.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_bits`` differing bits, the document's own
    included.  Empty and null texts have fingerprint 0 and link like any other.  Repeated rows get equal results.  A null
    doc_id is never a component_id unless no document of the group has an id.  Other columns of ``docs`` are not looked at.
    """
    fps, named = _grouped(docs, shingle, max_bits)
    return _salted(fps, named).select("doc_id", "fp", "component_id")


def _salted(fps: DataFrame, named: DataFrame) -> DataFrame:
    """Rows with the name of their fingerprint's group.

    A fingerprint may be that of a third of all rows (empty texts, copies): rows are dealt by a salt, and the one row of a fingerprint is
    repeated for each salt.
    """
    many = fps.withColumn("salt", F.pmod(F.xxhash64("doc_id", "content"), F.lit(SALTS)).cast("int"))
    one = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.join(one, ["fp", "salt"]).drop("salt")


def query(docs: DataFrame) -> DataFrame:
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that represent their group: all columns, exactly one row for each component.

    That is the row with the smallest doc_id (null only where no document of the group has one); of rows that share it, the one whose text
    has the smallest hash, and of equal ones the one whose columns have.  Rows with one doc_id and texts of different groups
    represent each their own group.  An empty table gives no rows; columns of any name pass through.
    """
    fps, named = _grouped(docs, 3, 2)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    chosen = _salted(fps.distinct(), named).groupBy("root").agg(F.min(key).alias("k")).select("k.doc_id", "k.content")
    rid, text, row = free_names(docs, "_chosen_id", "_chosen_text", "_row")
    chosen = durable(chosen.toDF(rid, text))
    kept = docs.join(chosen, F.col("doc_id").cast("long").eqNullSafe(F.col(rid)) & (_content(F.col("text")) == F.col(text)), "left_semi")
    # equal rows of one document: combined before they are shuffled
    again = docs.groupBy(F.col("doc_id").alias(rid), _content(F.col("text")).alias(text)).count().where("count > 1")
    if again.isEmpty():
        return kept
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    return kept.groupBy(F.col("doc_id").alias(rid), _content(F.col("text")).alias(text)) \
        .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias(row)).select(f"{row}.*")
