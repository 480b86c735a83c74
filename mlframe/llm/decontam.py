"""Benchmark passages in documents, found by q-gram counts in diagonal bands and verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mlframe.llm.common import raw, slices

Q = 8
# A passage is this many characters of an item (a shorter item: all of it), of which at most one in EDIT_SHARE is edited.
WINDOW, EDIT_SHARE = 80, 12
# Items go to the tasks in parts of at most this many bytes; every part is a pass of its own.
PART_BYTES = 4_000_000
FOUND = "doc_id long, item_id long, doc_start long, doc_end long, item_start long, edits long"


def normal(text: bytes | None) -> bytes:
    """Lower case, single spaces between words."""
    if not text:
        return b""
    return b" ".join((text if text.isascii() else text.decode().lower().encode()).lower().split())


def qgrams(text: np.ndarray) -> np.ndarray:
    """All runs of eight bytes as numbers: an overlapping view, not a loop."""
    if len(text) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(text) - Q + 1,), "<u8", np.ascontiguousarray(text).tobytes(), strides=(1,)).copy()


def _slot(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)


def banded(pattern: bytes, text: bytes, k: int) -> tuple[int, int, int] | None:
    """Fewest edits of ``pattern`` against any stretch of ``text``, with its start and end; None if more than ``k``.

    Cells further than needed from the diagonals that ``text`` leaves room for are never computed: the caller cuts
    ``text`` to the band.
    """
    t = np.frombuffer(text, np.uint8)
    cost = np.zeros(len(t) + 1, np.int64)
    start = np.arange(len(t) + 1)
    at = np.arange(len(t) + 1)
    for i, p in enumerate(pattern, 1):
        sub = cost[:-1] + (t != p)
        up = cost[1:] + 1
        new, origin = np.r_[i, np.minimum(sub, up)], np.r_[0, np.where(sub <= up, start[:-1], start[1:])]
        low = np.minimum.accumulate(new - at)  # insertions: the best cell to the left plus its distance
        src = np.maximum.accumulate(np.where(new - at == low, at, 0))
        cost, start = low + at, origin[src]
        if cost.min() > k:
            return None
    end = int(cost.argmin())
    return (int(cost[end]), int(start[end]), end) if cost[end] <= k else None


class Index:
    """q-grams of the items of one part, sorted, with a bitmap in front."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = [(i, normal(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if len(t) >= Q]
        codes = [qgrams(np.frombuffer(t, np.uint8)) for _, t in self.items]
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        at = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.keys, first = np.unique(code[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.item, self.at = item[order], at[order]
        self.filter = np.zeros(1 << 22, bool)
        self.filter[_slot(self.keys)] = True
        self.width = np.array([min(WINDOW, len(t)) for _, t in self.items])
        self.budget = self.width // EDIT_SHARE
        self.need = self.width - Q + 1 - self.budget * Q  # the q-gram lemma

    def search(self, texts: list[bytes]) -> list[list[tuple[int, int, int, int, int]]]:
        """``passages`` of each normalised text.

        A passage leaves at least the fewest q-grams of any item's bound within a passage's length of text, so only places
        as dense in q-grams of the benchmark are looked at further.
        """
        out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in texts]
        if not len(self.keys) or not texts:
            return out
        code = qgrams(np.frombuffer(b"\0".join(texts), np.uint8))
        pos = np.flatnonzero(self.filter[_slot(code)])
        pos = pos[self.keys[np.minimum(np.searchsorted(self.keys, code[pos]), len(self.keys) - 1)] == code[pos]]
        need, span = max(1, int(self.need.min())), int((self.width + self.budget).max()) - Q + 1
        if len(pos) < need:
            return out
        first = np.flatnonzero(pos[need - 1:] - pos[:len(pos) - need + 1] < span)
        if not len(first):
            return out
        dense = np.zeros(len(pos) + 1, np.int64)  # marks first .. first + need - 1
        np.add.at(dense, first, 1)
        np.add.at(dense, first + need, -1)
        pos = pos[np.cumsum(dense)[:-1] > 0]
        begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        owner = np.searchsorted(begin, pos, "right") - 1
        cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for a, b in zip(cut, [*cut[1:], len(pos)]):
            k = int(owner[a])
            out[k] = self.passages(texts[k], code[pos[a:b]], pos[a:b] - begin[k])
        return out

    def passages(self, text: bytes, code: np.ndarray, pos: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item, start, end, item start, edits) of the first passage of every item in a normalised text, given its q-grams that
        items hold and their places.

        Hits of an item are put into overlapping bands of diagonals, twice the edit budget wide.  A window of hits that meets the
        lemma's bound is verified against the item's window at those diagonals.
        """
        k = np.searchsorted(self.keys, code)
        n = self.first[k + 1] - self.first[k]
        ref = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pos, item, at = np.repeat(pos, n), self.item[ref], self.at[ref]
        width = 2 * self.budget[item] + 1
        diag = pos - at + (1 << 40)
        rows = []
        for half in (0, 1):  # two bands that overlap by half
            shift = half * (width // 2 + width % 2)
            band = (diag + shift) // (2 * width)
            rows.append(np.stack([item, band * 2 + half, at, pos], 1))
        rows = np.concatenate(rows)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]
        group = np.cumsum(new) - 1
        # distinct q-grams of the item, from each row on, within one window
        fresh = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(1)]
        rows, group = rows[fresh], group[fresh]
        item = rows[:, 0]
        far = np.searchsorted(group * (1 << 32) + rows[:, 2], group * (1 << 32) + rows[:, 2] + self.width[item] - Q + 1)
        good = far - np.arange(len(rows)) >= self.need[item]
        found: dict[int, tuple[int, int, int, int, int]] = {}
        tried: set[tuple[int, int, int]] = set()
        for r in np.flatnonzero(good):
            i = int(item[r])
            if i in found:
                continue
            own, budget, w = self.items[i][1], int(self.budget[i]), int(self.width[i])
            first, last = int(rows[r, 2]), int(rows[far[r] - 1, 2]) + Q
            slack = 3 * budget + 2
            top, low = min(first, len(own) - w), max(0, min(last - w, len(own) - w))
            for start in dict.fromkeys((top, low, *range(low, top))):  # every window that could hold these hits
                lo = max(0, int(rows[r, 3]) - (first - start) - slack)
                if (i, start, lo // slack) in tried:
                    continue
                tried.add((i, start, lo // slack))
                got = banded(own[start:start + w], text[lo:int(rows[r, 3]) + (start + w - first) + slack], budget)
                if got:
                    found[i] = (self.items[i][0], lo + got[1], lo + got[2], start, got[0])
                    break
        return list(found.values())


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            for part in slices(batch):
                found = index.search([normal(t) for t in raw(part.column("text"))])
                rows = [(d, *p) for d, ps in zip(part.column("doc_id").to_pylist(), found) for p in ps]
                cols = list(zip(*rows)) if rows else [()] * 6
                names = ["doc_id", "item_id", "doc_start", "doc_end", "item_start", "edits"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)
    return run


def _indexes(benchmark: DataFrame) -> Iterator:
    """Broadcast indexes of the items, in parts of bounded size."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    part, size = [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        text = r.text.encode()
        if part and size + len(text) > PART_BYTES:
            yield sc.broadcast(Index(part))
            part, size = [], 0
        part.append((r.item_id, text))
        size += len(text)
    if part:
        yield sc.broadcast(Index(part))


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item of which it holds a passage: ``doc_id, item_id, doc_start, doc_end, item_start, edits``.

    Offsets count bytes of the normalised text (lower case, single spaces).  Items are read in parts of bounded size, each
    searched in all documents.  Items under eight bytes, null and empty texts match nothing; repeated rows repeat.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for shared in _indexes(benchmark):
        found = rows.mapInArrow(_find(shared), FOUND)
        out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], FOUND) if out is None else out


def _without(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            for part in slices(batch):
                found = index.search([normal(t) for t in raw(part.column("text"))])
                yield part.filter(pa.array([not ps for ps in found], pa.bool_()))
    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no passage of the benchmark.

    Every row is judged by its own text, where it is: nothing is shuffled, and rows that share a doc_id, or have none, do not touch each
    other.  Null and empty texts stay.  An empty benchmark keeps all rows.
    """
    out = docs
    for shared in _indexes(benchmark):
        out = out.mapInArrow(_without(shared), docs.schema)
    return out


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return passages(docs, benchmark)
