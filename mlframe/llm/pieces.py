"""SentencePiece encoding and decoding by vectorised merge rounds.

A model file of the sentencepiece library (byte-pair merges with byte fallback, no normalisation) is read as plain tables.  Texts
become one flat array of symbols.  Between two characters that stand side by side in no piece nothing can ever merge, so the
array falls into words there, and equal words of a lot are encoded once.  A round finds each word's pair of the best rank,
merges all its occurrences from the left, and closes the gaps; words without a pair left drop out.
"""

from __future__ import annotations

import functools
import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mlframe.llm.common import distinct_runs, ranges, slices

# Bytes of text in a lot, and characters after which one text is cut between two words.
LOT_BYTES, CHUNK = 1_000_000, 1_000_000
# Words of more symbols are merged at all places at once, and by a heap what is left after so many rounds (long runs of ties).
LONG_WORD, LONG_ROUNDS = 512, 300
NONE = np.iinfo(np.int32).max

# Fixed values of the model format: kinds of pieces, the sign for a space, the bytes' replacement sign.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE_SIGN, REPLACEMENT = "▁", "�"
MERGES_BY_PAIRS = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass(frozen=True)
class Model:
    """Pieces, scores and kinds by id, and what stands for an unknown piece in decoded text."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    unknown_text: str


def read_model(data: bytes) -> Model:
    """Read a model file; models that this operator would encode differently from the library are refused."""
    pieces, scores, kinds = [], [], []
    trainer: dict = {}
    normal: dict = {}
    for field, value in _fields(data):
        if field == 1:
            entry = dict(_fields(value))
            pieces.append(entry[1].decode())
            scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
            kinds.append(entry.get(3, NORMAL))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normal = dict(_fields(value))
    if trainer.get(3, 1) != MERGES_BY_PAIRS or not trainer.get(35, 0) or trainer.get(24, 0):
        raise ValueError("only byte-pair models with byte fallback and spaces before words are supported")
    if normal.get(2) or normal.get(4, 1) or not normal.get(3, 1) or not normal.get(5, 1):
        raise ValueError("only models without normalisation, with a space before the text, are supported")
    if kinds.count(BYTE) != 256 or USER in kinds or UNUSED in kinds:
        raise ValueError("models with own or unused pieces, or without all bytes, are not supported")
    return Model(pieces, scores, kinds, trainer[44].decode() if 44 in trainer else " ⁇ ")


class Tables:
    """Arrays for the merge rounds.  A symbol is a piece, or a character of a piece that is none itself; 0 is any other character."""

    def __init__(self, model: Model):
        score = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k == NORMAL}
        chars = sorted({c for p in score for c in p})
        names = [""] + chars + sorted(p for p in score if len(p) > 1)
        number = {s: i for i, s in enumerate(names)}
        ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == NORMAL}
        self.n = len(names)
        self.longest = max(map(len, names))
        self.ids = np.array([ids.get(s, -1) for s in names], np.int32)
        self.byte_ids = np.zeros(256, np.int32)
        for i, (p, k) in enumerate(zip(model.pieces, model.kinds)):
            if k == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
        self.symbol = np.zeros(0x110000, np.uint16 if len(chars) < 65535 else np.int32)
        self.symbol[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        # ranks: equal scores share one, the best is 0
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.array([order[score[s]] if s in score else NONE for s in names], np.int32)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)  # side by side in some piece
        # after such a merge a pair of the same or a better rank can arise beside it: one merge a round
        self.alone = np.zeros(self.n, bool)
        pairs = {}
        for p in score:
            for c, d in zip(p, p[1:]):
                self.joined[number[c], number[d]] = True
            for k in range(1, len(p)):
                a, b = number.get(p[:k]), number.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.n + b] = number[p]
                    for side in (a, b):
                        self.alone[side] |= self.rank[number[p]] <= self.rank[side]
        self.pair = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pair.tolist()], np.int32)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that each pair merges to, 0 for none."""
        key = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged[at], 0)


def _merge_words(t: Tables, sym: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after all merges, word after word, and their number in each word."""
    sizes = np.diff(np.r_[starts, len(sym)])
    word = np.repeat(np.arange(len(starts)), sizes)
    to = np.zeros(len(sym), np.int32)
    inside = np.flatnonzero(word[1:] == word[:-1])
    to[inside] = t.look_up(sym[inside], sym[inside + 1])
    done_word, done_sym = [], []
    while len(sym):
        rank = np.where(to > 0, t.rank[to], NONE)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[first, len(sym)])
        best = np.minimum.reduceat(rank, first)
        live = np.repeat(best < NONE, sizes)
        if not live.all():
            done_word.append(word[~live])
            done_sym.append(sym[~live])
            sym, to, word, rank = sym[live], to[live], word[live], rank[live]
            sizes, best = sizes[best < NONE], best[best < NONE]
            if not len(sym):
                break
            first = np.cumsum(sizes) - sizes
        hits = np.flatnonzero(rank == np.repeat(best, sizes))
        # overlapping occurrences: every second one of a run, from the left (a run never leaves its word: its last symbol has no pair)
        head = np.r_[True, np.diff(hits) > 1]
        place = np.arange(len(hits)) - np.maximum.accumulate(np.where(head, np.arange(len(hits)), 0))
        hits = hits[place % 2 == 0]
        at = word[hits]
        leads = np.r_[True, at[1:] != at[:-1]]
        alone = np.repeat(np.logical_or.reduceat(t.alone[to[hits]], np.flatnonzero(leads)), np.diff(np.r_[np.flatnonzero(leads), len(hits)]))
        sym, to, word = _apply(t, sym, to, word, hits[leads | ~alone])
    if not done_word:
        return sym, np.zeros(len(starts), np.int64)
    words, syms = np.concatenate(done_word), np.concatenate(done_sym)
    order = np.argsort(words, kind="stable")
    return syms[order], np.bincount(words, minlength=len(starts))


def _apply(t: Tables, sym: np.ndarray, to: np.ndarray, word: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the pairs that start at ``hits``, close the gaps and look up the pairs beside them anew."""
    sym = sym.copy()
    sym[hits] = to[hits]
    keep = np.ones(len(sym), bool)
    keep[hits + 1] = False
    at = hits - np.arange(len(hits))  # the places after the gaps are closed
    sym, to, word = sym[keep], to[keep], word[keep]
    changed = np.zeros(len(sym), bool)
    changed[at] = changed[at[at > 0] - 1] = True
    near = np.flatnonzero(changed)
    inside = near[near + 1 < len(sym)]
    inside = inside[word[inside] == word[inside + 1]]
    to[near] = 0
    to[inside] = t.look_up(sym[inside], sym[inside + 1])
    return sym, to, word


def _merge_long(t: Tables, sym: np.ndarray) -> np.ndarray:
    """Merges of one long word.

    A pair that comes first, by rank and place, among all pairs within twice the longest piece is merged before any merge from
    farther away can reach it, so all such pairs of a round are merged together.
    """
    word = np.zeros(len(sym), np.int32)
    to = np.r_[t.look_up(sym[:-1], sym[1:]), 0].astype(np.int32)
    reach = 2 * t.longest + 2
    for _ in range(LONG_ROUNDS):
        if not to.any():
            return sym
        key = np.where(to > 0, t.rank[to], NONE).astype(np.int64) << 32 | np.arange(len(sym))
        least, width = np.r_[key, np.full(2 * reach, np.iinfo(np.int64).max)], 1
        least = np.r_[np.full(reach, np.iinfo(np.int64).max), least]
        while width < 2 * reach + 1:  # the least of ever wider windows
            step = min(width, 2 * reach + 1 - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        sym, to, word = _apply(t, sym, to, word, np.flatnonzero((key == least[:len(key)]) & (to > 0)))
    return _merge_heap(t, sym)


def _merge_heap(t: Tables, sym: np.ndarray) -> np.ndarray:
    """One merge at a time, in the order of rank and place."""
    s = sym.tolist()
    n = len(s)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    table = dict(zip(t.pair.tolist(), t.merged.tolist()))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        if 0 <= i and j < n and (z := table.get(s[i] * t.n + s[j])) is not None:
            heapq.heappush(heap, (int(t.rank[z]), i, j, s[i], s[j]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, a, b = heapq.heappop(heap)
        if s[i] != a or j >= n or s[j] != b or after[i] != j:
            continue
        s[i], s[j] = table[a * t.n + b], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i], i)
        offer(i, after[i])
    return np.array([x for x in s if x >= 0], np.int32)


def _utf8(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of code points, and their number for each."""
    sizes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    return np.frombuffer("".join(map(chr, codes.tolist())).encode(), np.uint8), sizes


class Encoder:
    """Ids of texts, exactly as the sentencepiece library gives them without begin and end ids."""

    def __init__(self, model: Model):
        self.t = Tables(model)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out = []
        for t in texts:
            if t and len(t) > CHUNK:
                out.append(np.concatenate([self._lot([c])[0] for c in self._cut(SPACE_SIGN + t.replace(" ", SPACE_SIGN))]))
            else:
                out.append(t)
        short = [i for i, t in enumerate(out) if not isinstance(t, np.ndarray)]
        for i, ids in zip(short, self._lot([SPACE_SIGN + out[i].replace(" ", SPACE_SIGN) if out[i] else "" for i in short])):
            out[i] = ids
        return out

    def _cut(self, text: str) -> Iterator[str]:
        """A long text in parts between which nothing merges, as long as possible up to CHUNK characters."""
        at = 0
        while at < len(text):
            size = CHUNK
            while at + size < len(text):
                s = self.t.symbol[np.frombuffer(text[at:at + size + 1].encode("utf-32-le"), np.uint32)]
                free = np.flatnonzero(~self.t.joined[s[:-1], s[1:]])
                if len(free):
                    size = int(free[-1]) + 1
                    break
                size *= 2
            yield text[at:at + size]
            at += size

    def _lot(self, texts: list[str]) -> list[np.ndarray]:
        if not any(texts):
            return [np.zeros(0, np.int32) for _ in texts]
        t = self.t
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(x) for x in texts])
        sym = t.symbol[codes]
        cut = np.ones(len(codes), bool)
        cut[1:] = ~t.joined[sym[:-1], sym[1:]]
        ends = np.cumsum(sizes)
        cut[ends[:-1][ends[:-1] < len(codes)]] = True
        starts = np.flatnonzero(cut)
        which, of = distinct_runs(codes, starts, np.diff(np.r_[starts, len(codes)]))
        flat, counts = self._words(codes, sym, starts[which], np.diff(np.r_[starts, len(codes)])[which])
        begin = np.cumsum(counts) - counts
        ids = flat[ranges(begin[of], counts[of])]
        # ids of a text: those of its words
        total = np.r_[0, np.cumsum(counts[of])]
        first_word = np.searchsorted(starts, np.r_[0, ends])
        edges = total[first_word]
        return [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def _words(self, codes, sym, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given words, one after the other, and their numbers."""
        t = self.t
        single, long = sizes == 1, sizes > LONG_WORD
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, ids in each, ids
        lone = np.flatnonzero(single)
        s, c = sym[starts[lone]], codes[starts[lone]]
        known = t.ids[s] >= 0
        parts.append((lone[known], np.ones(int(known.sum()), np.int64), t.ids[s[known]]))
        if not known.all():
            data, n = _utf8(c[~known])
            parts.append((lone[~known], n, t.byte_ids[data]))
        middle = np.flatnonzero(~single & ~long)
        if len(middle):
            n = sizes[middle]
            at = ranges(starts[middle], n)
            merged, counts = _merge_words(t, sym[at].astype(np.int32), np.cumsum(n) - n)
            parts.append(self._spelled(middle, counts, merged))
        for w in np.flatnonzero(long):
            merged = _merge_long(t, sym[starts[w]:starts[w] + sizes[w]].astype(np.int32))
            parts.append(self._spelled(np.array([w]), np.array([len(merged)]), merged))
        words, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        flat = np.concatenate([p[2] for p in parts])
        begin = np.cumsum(counts) - counts
        back = np.argsort(words)
        return flat[ranges(begin[back], counts[back])], counts[back]

    def _spelled(self, words, counts, symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of merged symbols; characters that are no piece themselves are spelled in bytes."""
        ids = self.t.ids[symbols]
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return words, counts, ids
        char_of = np.zeros(self.t.n, np.uint32)
        known = np.flatnonzero(self.t.symbol)
        char_of[self.t.symbol[known]] = known
        data, n = _utf8(char_of[symbols[bare]])
        width = np.ones(len(ids), np.int64)
        width[bare] = n
        flat = np.repeat(ids, width)
        flat[flat < 0] = self.t.byte_ids[data]
        return words, np.add.reduceat(width, np.cumsum(counts) - counts), flat


class Decoder:
    """Texts of ids, as the library's decode gives them."""

    def __init__(self, model: Model):
        shown = {NORMAL: lambda p: p.replace(SPACE_SIGN, " ").encode(), BYTE: lambda p: bytes([int(p[1:-1], 16)]),
                 UNKNOWN: lambda p: model.unknown_text.encode(), CONTROL: lambda p: b""}
        self.bytes = [shown[k](p) for p, k in zip(model.pieces, model.kinds)]
        self.kinds = model.kinds

    def decode(self, ids: list[int]) -> str:
        data = b"".join([self.bytes[i] for i in ids])
        lead = next((i for i in ids if self.kinds[i] != CONTROL), None)
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._mended(ids)
        # the space before the text goes, unless its first piece stands for something else
        return text[1:] if lead is not None and self.kinds[lead] == NORMAL and text.startswith(" ") else text

    def _mended(self, ids: list[int]) -> str:
        """Each byte that is part of no character becomes a replacement sign; only runs of byte pieces form characters."""
        out, run = [], bytearray()

        def close() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[at:at + size].decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append(REPLACEMENT)
                    at += 1
            run.clear()

        for i in ids:
            if self.kinds[i] == BYTE:
                run += self.bytes[i]
            else:
                close()
                out.append(self.bytes[i].decode())
        close()
        return "".join(out)


@functools.lru_cache(2)
def _tools(data: bytes) -> tuple[Encoder, Decoder]:
    model = read_model(data)
    return Encoder(model), Decoder(model)


def _shared(df: DataFrame, model_path: str):
    """The model file, read by the driver; some 0.5 MB for 32,000 pieces, whatever the size of the data."""
    with open(model_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _own_name(df: DataFrame, name: str) -> None:
    if name.lower() in [c.lower() for c in df.columns]:
        raise ValueError(f"the input already has a column {name}")


def encode(docs: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """``doc_id`` and the ids of the whole ``text`` of every row, as ``array<int>``.

    Null and empty texts have no ids.  Null and repeated doc_ids, repeated rows and other columns make no difference: each row is
    encoded by itself.  An empty table gives no rows.
    """
    shared = _shared(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tools(shared.value)[0]
        for batch in batches:
            for part in slices(batch, size=LOT_BYTES):
                rows = encoder.encode(part.column("text").to_pylist())
                offsets = np.r_[0, np.cumsum([len(x) for x in rows])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(offsets, np.concatenate(rows).astype(np.int32))], ["doc_id", ids])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id long, `{ids}` array<int>")


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids; no ids and null give the empty text.

    Bytes that form no character become replacement signs, as in the library; an id outside the vocabulary fails.
    """
    _own_name(rows, text)
    shared = _shared(rows, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _tools(shared.value)[1]
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            texts = [decoder.decode(x.values.to_pylist() if x.is_valid else []) for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(text, StringType())]))


def query(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, through ``encode`` and ``decode``."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode(encode(docs, path), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
