"""Repeated passages as compacted paths of a De Bruijn graph over words.

Every run of WINDOW words is an edge between its first and last WINDOW - 1 words.  Consecutive edges with the same least
4-word hash travel as one partial path to the partition of that hash, where edges of the same 64-bit hash meet; edges of a hash that
very many windows share travel alone, by their own hash.  Repeated edges are cut out as paths with the coordinates of
their first source, paths that continue each other, in the document and in the source, are joined to long spans, and
of a span only the windows whose words are the source's words count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from mlframe.llm.common import group_starts, raw, whole_groups
from mlframe.runtime import durable

WINDOW = 13
ANCHOR = 4
# Documents of a task are compared among themselves in lots of about this many bytes before anything is shuffled.
LOT_BYTES = 5_000_000
MANY_WORDS = 400_000
TAG_BITS = 16
# Anchors of more windows than this, judged by one document of HOT_SAMPLE, are split by the windows' own hashes.
HOT_WINDOWS, HOT_SAMPLE = 200_000, 64
# Passages of sources leave a task in lots of about this many bytes.
PASSAGE_BYTES = 8_000_000
M = 0x9E3779B97F4A7C15
PATHS = "anchor long, doc_id long, at long, n int, edges binary"
REPEATS = "doc_id long, tag int, start int, n int, src_doc long, src_tag int, src_start int"
SOURCE = ["src_doc", "src_tag", "src_start", "n"]


class _Words(dict):
    """Hashes of words, kept as long as there are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MANY_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 42)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def _span(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> np.ndarray:
    """Hashes of runs of na + nb words from those of na and of nb words."""
    n = min(len(a), len(b) - na)
    return a[:n] + b[na:na + n] * np.uint64(pow(M, na, 1 << 64))


def _hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every start of WINDOW words: the hash of the window, and the least hash of ANCHOR words in it."""
    h2 = _span(h, 1, h, 1)
    h4 = _span(h2, 2, h2, 2)
    h8 = _span(h4, 4, h4, 4)
    h12 = _span(h8, 8, h4, 4)
    window = _mix(_span(h12, 12, h, 1))
    m = _mix(h4 ^ np.uint64(M))
    m2 = np.minimum(m[:-1], m[1:])
    m4 = np.minimum(m2[:-2], m2[2:])
    m8 = np.minimum(m4[:-4], m4[4:])
    return window, np.minimum(m8[:-2], m8[2:])


def _tag(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text, 42) & ((1 << TAG_BITS) - 1)


def _windows(docs: list[bytes], words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Document, first word, hash and anchor of every window; None if no text is long enough."""
    hashes = [np.array([words[w] for w in t.split()], np.uint64) for t in docs]
    size = np.array([len(h) for h in hashes])
    h = np.concatenate(hashes)
    if len(h) < WINDOW:
        return None
    owner = np.repeat(np.arange(len(docs)), size)
    place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    window, anchor = _hashes(h)
    inside = np.flatnonzero(owner[:len(window)] == owner[WINDOW - 1:])
    return (owner[inside], place[inside], window[inside], anchor[inside]) if len(inside) else None


def _lot(docs: list[tuple[int, bytes]], words: _Words, hot: np.ndarray) -> pa.RecordBatch | None:
    """Paths of one lot: what the lot itself proves repeated (``edges`` empty), and the partial paths to compare elsewhere.

    Of equal edges of the lot only those of the smallest doc_id go on, so a passage in all documents sends a lot one copy.
    """
    docs = sorted(docs, key=lambda d: d[0])
    if (found := _windows([t for _, t in docs], words)) is None:
        return None
    owner, place, window, anchor = found
    doc = np.array([d for d, _ in docs], np.int64)
    tag = np.array([_tag(t) for _, t in docs], np.int64)
    order = np.argsort(window, kind="stable")
    w = window[order]
    first = np.maximum.accumulate(np.where(np.r_[True, w[1:] != w[:-1]], np.arange(len(w)), 0))
    source = np.empty(len(w), np.int64)
    source[order] = order[first]
    local = doc[owner] > doc[owner[source]]
    anchor = np.where(np.isin(anchor, hot), window, anchor)
    key = np.where(local, np.uint64(0), anchor)
    new = np.r_[True, (owner[1:] != owner[:-1]) | (local[1:] != local[:-1]) | (key[1:] != key[:-1])
                | (local[1:] & (np.diff(source) != 1))]
    start = np.flatnonzero(new)
    n = np.diff(np.r_[start, len(w)])
    own = local[start]
    at = (tag[owner[start]] << 32) | place[start]
    spread = _mix(doc[owner[start]].astype(np.uint64) * np.uint64(M) + at.astype(np.uint64))
    sent = np.repeat(~own, n)
    # a proven path carries its source instead of edges: doc_id, and tag and place
    src = source[start[own]]
    proof = np.zeros(len(src), [("doc", "<i8"), ("at", "<i8")])
    proof["doc"], proof["at"] = doc[owner[src]], (tag[owner[src]] << 32) | place[src]
    length = np.where(own, 16, 8 * n)
    stop = np.cumsum(length)
    if len(stop) and stop[-1] > 2**31 - 1:
        raise ValueError("a lot must stay below 2 GB")
    data = np.empty(int(stop[-1]), np.uint8)
    is_proof = np.repeat(own, length)
    data[is_proof] = proof.view(np.uint8) if len(proof) else np.zeros(0, np.uint8)
    data[~is_proof] = window[sent].astype("<u8").view(np.uint8)
    edges = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.r_[0, stop].astype(np.int32)), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.where(own, spread, anchor[start]).view(np.int64)), pa.array(doc[owner[start]]), pa.array(at),
         pa.array(np.where(own, -n, n).astype(np.int32)), edges], ["anchor", "doc_id", "at", "n", "edges"])


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    lot, size = [], 0
    for batch in batches:
        for d, t in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text"))):
            lot.append((d, t))
            size += len(t)
            if size >= LOT_BYTES:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def _paths(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for lot in _lots(batches):
            if (out := _lot(lot, words, hot.value)) is not None:
                yield out
    return run


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for lot in _lots(batches):
        if (found := _windows([t for _, t in lot], words)) is not None:
            anchor, n = np.unique(found[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], ["anchor", "n"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in whole_groups(batches, ["anchor"]):
        n = rows.column("n").to_numpy()
        doc, at = rows.column("doc_id").to_numpy(), rows.column("at").to_numpy()
        blob = rows.column("edges").combine_chunks() if isinstance(rows.column("edges"), pa.ChunkedArray) else rows.column("edges")
        blob = blob.chunk(0) if isinstance(blob, pa.ChunkedArray) else blob
        offset = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset:blob.offset + len(blob) + 1].astype(np.int64)
        data = np.frombuffer(blob.buffers()[2] or b"", np.uint8)[offset[0]:offset[-1]]
        proven = n < 0
        held = np.repeat(proven, np.diff(offset))
        edge = np.ascontiguousarray(data[~held]).view("<u8")
        proof = np.ascontiguousarray(data[held]).view([("doc", "<i8"), ("at", "<i8")])
        out = [(doc[proven], at[proven], -n[proven], proof["doc"].astype(np.int64), proof["at"].astype(np.int64))]
        m = np.where(proven, 0, n)
        row = np.repeat(np.arange(len(n)), m)
        step = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)
        group = np.cumsum(group_starts(rows, ["anchor"]))[row]
        order = np.lexsort((doc[row], group, edge))
        k, g = edge[order], group[order]
        first = np.maximum.accumulate(np.where(np.r_[True, (k[1:] != k[:-1]) | (g[1:] != g[:-1])][:len(k)], np.arange(len(k)), 0))
        source = np.empty(len(k), np.int64)
        source[order] = order[first]
        again = np.flatnonzero(doc[row] > doc[row[source]])
        if len(again):
            r, s = row[again], source[again]
            src_doc, src_at = doc[row[s]], at[row[s]] + step[s]
            new = np.r_[True, (r[1:] != r[:-1]) | (np.diff(step[again]) != 1) | (src_doc[1:] != src_doc[:-1]) | (np.diff(src_at) != 1)]
            cut = np.flatnonzero(new)
            out.append((doc[r[cut]], at[r[cut]] + step[again[cut]], np.diff(np.r_[cut, len(again)]), src_doc[cut], src_at[cut]))
        d, a, n, sd, sa = (np.concatenate(x) for x in zip(*out))
        tag, start, src_tag, src_start = (x.astype(np.int32) for v in (a, sa) for x in (v >> 32, v & 0xFFFFFFFF))
        yield pa.RecordBatch.from_arrays(
            [pa.array(d), pa.array(tag), pa.array(start), pa.array(n.astype(np.int32)), pa.array(sd), pa.array(src_tag), pa.array(src_start)],
            ["doc_id", "tag", "start", "n", "src_doc", "src_tag", "src_start"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def hot_anchors(rows: DataFrame, windows: int = HOT_WINDOWS, sample: int = HOT_SAMPLE) -> np.ndarray:
    """Anchors of more than ``windows`` windows, judged by one document of ``sample``.  Only balance depends on them, never the result."""
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0)
    found = drawn.mapInArrow(_anchors, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")) \
        .where(F.col("n") * sample > windows).select("anchor").toArrow()
    return np.sort(found.column("anchor").to_numpy().view(np.uint64))


def repeats(docs: DataFrame, hot_windows: int = HOT_WINDOWS, hot_sample: int = HOT_SAMPLE) -> DataFrame:
    """``doc_id, tag, start, n, src_doc, src_tag, src_start``: n consecutive windows from word ``start`` also start in ``src_doc``, a smaller id.

    Tags tell rows of one doc_id with different texts apart.  Documents without an id take no part.  Windows meet by the
    64 bits of their hash; coordinates of document and source run in parallel over the n windows.
    """
    rows = _texts(docs).where("doc_id is not null and text is not null")
    hot = docs.sparkSession.sparkContext.broadcast(hot_anchors(rows, hot_windows, hot_sample))
    return rows.mapInArrow(_paths(hot), PATHS).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_meet, REPEATS)


def spans(found: DataFrame) -> DataFrame:
    """Compact paths: those that continue each other, in the document and in the source, become one; columns of ``found``."""
    by = Window.partitionBy("doc_id", "tag").orderBy("start", "src_doc", "src_tag", "src_start")
    here = F.struct("start", "src_doc", "src_tag", "src_start")
    after = F.struct((F.col("start") + F.col("n")).alias("start"), "src_doc", "src_tag", (F.col("src_start") + F.col("n")).alias("src_start"))
    island = F.sum(F.when(F.col("here") == F.col("before"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return found.withColumn("here", here).withColumn("before", F.lag(after).over(by)).withColumn("island", island) \
        .groupBy("doc_id", "tag", "island").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min("src_doc").alias("src_doc"),
                                                F.min("src_tag").alias("src_tag"), F.min("src_start").alias("src_start")).drop("island")


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), *(pa.array(c, pa.int32()) for c in cols[1:4]), pa.array(cols[4], pa.binary())], [*SOURCE, "words"])

    for batch in batches:
        for d, t, asked in zip(batch.column("id").to_pylist(), raw(batch.column("body")), batch.column("asked").to_pylist()):
            if t is None:
                continue
            words, tag = t.split(), _tag(t)
            for a in asked:
                if a["src_tag"] == tag:
                    passage = b" ".join(words[a["src_start"]:a["src_start"] + a["n"] + WINDOW - 1])
                    out.append((d, tag, a["src_start"], a["n"], passage))
                    size += len(passage)
                    if size >= PASSAGE_BYTES:
                        yield flush()
                        out, size = [], 0
    if out:
        yield flush()


def _agreed(words: list[bytes], cuts: list[dict]) -> list[tuple[int, int]]:
    """First word and the word after the last of every run of windows whose words are those of the source."""
    out = []
    for c in cuts:
        a, n = c["start"], c["n"]
        here = words[a:a + n + WINDOW - 1]
        for passage in c["words"]:
            there = passage.split()
            if here == there:
                out.append((a, a + len(here)))
                continue
            run = 0
            for i, same in enumerate([*(x == y for x, y in zip(here, there)), False]):
                if same:
                    run += 1
                    continue
                if run >= WINDOW:
                    out.append((a + i - run, a + i))
                run = 0
    return out


def _rest(words: list[bytes], cuts: list[tuple[int, int]]) -> list[bytes]:
    if not cuts:
        return words
    out, at = [], 0
    for a, b in sorted(cuts):
        out += words[at:a]
        at = max(at, b)
    return out + words[at:]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, kept, text = [], [], []
        for t, cuts in zip(raw(batch.column("text")), batch.column("cuts").to_pylist()):
            words = t.split() if t else []
            tag = _tag(t) if cuts else 0
            rest = _rest(words, _agreed(words, [c for c in cuts or () if c["tag"] == tag]))
            n.append(len(words))
            kept.append(len(rest))
            text.append(b" ".join(rest))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(kept, pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in text], pa.string())], ["doc_id", "n_words", "n_kept", "kept_sha256"])


def cut_out(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row: words covered by a window of ``found`` are removed.

    Each span is held against the words of its source, and windows that differ in a word stay.  Texts are dealt by doc_id once,
    for the sources and for the cuts, after the shuffle files of the paths are gone.
    """
    rows = _texts(docs)
    # names of their own keep both uses of the texts one plan, and so one shuffle
    known = rows.where("doc_id is not null").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    paths = durable(spans(found), release=True)
    asked = paths.select(*SOURCE).distinct().groupBy("src_doc").agg(F.collect_list(F.struct("src_tag", "src_start", "n")).alias("asked"))
    passages = known.join(asked, F.col("id") == F.col("src_doc")).select("id", "body", "asked") \
        .mapInArrow(_passages, "src_doc long, src_tag int, src_start int, n int, words binary") \
        .groupBy(*SOURCE).agg(F.collect_set("words").alias("words"))
    cuts = paths.join(passages, SOURCE).groupBy("doc_id").agg(F.collect_list(F.struct("tag", "start", "n", "words")).alias("cuts"))
    alone = rows.where("doc_id is null").withColumn("cuts", F.lit(None).cast(cuts.schema["cuts"].dataType))
    return known.join(cuts, F.col("id") == F.col("doc_id"), "left").select(F.col("id").alias("doc_id"), F.col("body").alias("text"), "cuts").union(alone) \
        .mapInArrow(_remove, "doc_id long, n_words long, n_kept long, kept_sha256 string") \
        .select("doc_id", "n_words", (F.col("n_words") - F.col("n_kept")).alias("n_removed"), "kept_sha256")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row: words covered by a repeated window are removed.

    Null texts have no words.  Rows that repeat doc_id and text get equal results.
    """
    return cut_out(docs, repeats(docs))


def query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs)
