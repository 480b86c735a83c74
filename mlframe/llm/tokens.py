"""Token ids in binary shards whose document boundaries are Elias-Fano coded."""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from mlframe.llm.common import distinct_runs, equal_runs, kinds, ranges, raw, run_hashes, slices
from mlframe.runtime import scratch_dir

END_ID = 1
# A shard is closed after so many ids or documents.
SHARD_IDS, SHARD_DOCS = 2_000_000, 500_000
# Texts are cut into words in lots of so many bytes.
LOT_BYTES = 3_000_000
# Words, and bytes of words and ids, that a Python worker remembers.
CACHE, CACHE_BYTES = 500_000, 20_000_000
# Rows of an Arrow batch while texts are encoded: the JVM's side of a batch of long texts lies outside its heap, twice while it grows.
BATCH_ROWS, BATCH = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
# Boundaries read at once.
PLACES = 4096
# New words are encoded so many at a time: the library keeps some hundred bytes a token while it works, and the worker never gives them back.
LEARN = 5_000
HEADER = struct.Struct("<4sHHqqqqq")
MAGIC = b"EFTK"
SAMPLE = 512
# Pre-tokens of the vocabulary; fixed pattern of the tokenizer file.
WHITE = np.zeros(256, bool)
MARK = np.zeros(256, bool)
MARK[list(b",.;:!?")] = True
WHITE[list(b" \t\n\v\f\r")] = True
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Words of these characters are the same after normalisation but for case, and hold no special token.
PLAIN = regex.compile(r"(?!.*<\|)[!-~¡-¬®-ÿ]+")


class EliasFano:
    """A non-decreasing sequence of integers from 0: low bits packed, high bits in unary, every SAMPLE-th one's place kept."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint64))
        v = values.astype(np.uint64)
        if (v[1:] < v[:-1]).any():
            raise ValueError("values must not decrease")
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = np.zeros(n * low_bits, np.uint8)
        for b in range(low_bits):
            bits[b::low_bits] = (v >> np.uint64(b)) & np.uint64(1)
        low = np.packbits(bits, bitorder="little")
        ones = (v >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE])

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it and the bits in between."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        chunk = np.unpackbits(self.high[byte:byte + 64], bitorder="little")
        chunk[:at & 7] = 0
        while (ones := int(chunk.sum())) <= left:
            left -= ones
            byte += 64
            chunk = np.unpackbits(self.high[byte:byte + 64], bitorder="little")
        one = byte * 8 + int(np.flatnonzero(chunk)[left])
        return ((one - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def select_range(self, start: int, stop: int) -> np.ndarray:
        """The values from the start-th to before the stop-th, as unsigned numbers; only their own bits are unpacked."""
        if not 0 <= start <= stop <= self.n:
            raise IndexError((start, stop))
        if start == stop:
            return np.zeros(0, np.uint64)
        head = start // SAMPLE
        first, after = int(self.samples[head]), -(-stop // SAMPLE)
        last = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[first >> 3:(last + 7) >> 3], bitorder="little")
        bits[:first & 7] = 0
        ones = np.flatnonzero(bits)[start - head * SAMPLE:stop - head * SAMPLE].astype(np.uint64) + np.uint64(first >> 3 << 3)
        i = np.arange(start, stop)
        return (ones - i.astype(np.uint64)) << np.uint64(self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        return self.select_range(0, self.n).astype(np.int64)

    def to_bytes(self) -> bytes:
        return b"".join([struct.pack("<qqqqq", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)),
                         self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u8").tobytes()])

    @classmethod
    def from_buffer(cls, view: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, a, b, c = struct.unpack_from("<qqqqq", view, at)
        at += 40
        low, high = np.frombuffer(view, np.uint8, a, at), np.frombuffer(view, np.uint8, b, at + a)
        return cls(n, low_bits, low, high, np.frombuffer(view, "<u8", c, at + a + b)), at + a + b + 8 * c


class Words:
    """Ids of words seen before, in flat arrays: sorted 64-bit hashes, the words themselves, which are compared, and their ids."""

    def __init__(self, width: int):
        self.letters, self.ids = np.zeros(0, np.uint8), np.zeros(0, f"<u{width}")
        self.table = np.zeros(0, [("hash", "u8"), ("at", "i8"), ("size", "i8"), ("ids", "i8"), ("n", "i8"), ("used", "i8")])
        self.lot = 0

    def find(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The rows of the given words, -1 for new ones."""
        self.lot += 1
        row = np.full(len(starts), -1)
        if not len(self.table):
            return row
        at = np.minimum(np.searchsorted(self.table["hash"], hashes), len(self.table) - 1)
        like = np.flatnonzero((self.table["hash"][at] == hashes) & (self.table["size"][at] == sizes))
        same = like[equal_runs(data, starts[like], self.letters, self.table["at"][at[like]], sizes[like])]
        row[same] = at[same]
        self.table["used"][at[same]] = self.lot
        return row

    def add(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Remember new words; of two with one hash only one is kept.  When there are too many, those unused for longest go."""
        if not len(hashes):
            return
        first = kinds(hashes)[0]
        at = np.searchsorted(self.table["hash"], hashes[first])
        first = first[np.r_[self.table["hash"], hashes[first[-1:]] + np.uint64(1)][at] != hashes[first]]
        new = np.zeros(len(first), self.table.dtype)
        new["hash"], new["size"], new["n"], new["used"] = hashes[first], sizes[first], counts[first], self.lot
        new["at"] = len(self.letters) + np.cumsum(sizes[first]) - sizes[first]
        new["ids"] = len(self.ids) + np.cumsum(counts[first]) - counts[first]
        self.letters = np.r_[self.letters, data[ranges(starts[first], sizes[first])]]
        self.ids = np.r_[self.ids, ids[ranges((np.cumsum(counts) - counts)[first], counts[first])]]
        table = np.r_[self.table, new]
        if len(table) > CACHE or len(self.letters) + self.ids.nbytes > CACHE_BYTES:
            table = table[np.argsort(-table["used"], kind="stable")][:CACHE // 2]
            fits = np.cumsum(table["size"] + table["n"] * self.ids.itemsize) <= CACHE_BYTES // 2
            table = table[fits]
            self.letters = self.letters[ranges(table["at"], table["size"])]
            self.ids = self.ids[ranges(table["ids"], table["n"])]
            table["at"] = np.cumsum(table["size"]) - table["size"]
            table["ids"] = np.cumsum(table["n"]) - table["n"]
        self.table = table[np.argsort(table["hash"])]


class Encoder:
    """Ids of texts by the tokenizers library.  No token crosses white space, so the distinct words of a lot are looked up, or encoded, once."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocab = self.tokenizer.get_vocab()
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.words = Words(self.width)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # the same vocabulary, held once, for single lower-case pre-tokens: nothing is left to normalise or to cut but spaces
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _simple(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words that are letters a to z and à to ÿ, or these and one mark behind: which they are, their ids in a row, and their numbers.

        All are handed over in one text: nothing is left to normalise but upper case à to ÿ, and to cut but the mark.
        """
        first = np.cumsum(sizes) - sizes
        place = ranges(starts, sizes)
        own = data[place]
        before = np.r_[np.uint8(0), own[:-1]]
        before[first] = 0
        second = (before == 0xC3) & (own >= 0x80) & (own <= 0xBF) & (own != 0x97) & (own != 0xB7)
        letter = ((own >= 97) & (own <= 122)) | second | ((own == 0xC3) & np.r_[second[1:], False])
        others = np.add.reduceat(~letter, first, dtype=np.int64)
        marked = (others == 1) & (sizes > 1) & MARK[own[first + sizes - 1]]
        which = np.flatnonzero((others == 0) | marked)
        if not len(which):
            return which, np.zeros(0, "<u4"), np.zeros(0, np.int64)
        own = np.where(second & (own <= 0x9E), own + 0x20, own).astype(np.uint8)
        n, extra = sizes[which], marked[which].astype(np.int64)
        room = n + 1 + extra
        out = np.full(int(room.sum()), 32, np.uint8)
        to = ranges(np.cumsum(room) - room, n)
        to[np.cumsum(n) - 1] += extra
        out[to] = own[ranges(first[which], n)]
        ids = self._ids(self.merger, out.tobytes().decode())
        stop = np.r_[0, np.flatnonzero(self.ends[ids]) + 1]
        pieces = np.cumsum(1 + extra)
        if len(stop) != pieces[-1] + 1:  # a token of the vocabulary that ends no pre-token where it should
            return which[:0], np.zeros(0, "<u4"), np.zeros(0, np.int64)
        return which, ids, np.diff(np.r_[0, stop[pieces]])

    def _new(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words, one word after the other, and their numbers."""
        which, ids, n = self._simple(data, starts, sizes)
        rest = np.setdiff1d(np.arange(len(starts)), which, assume_unique=True)
        coded = self._learn([data[a:a + k].tobytes() for a, k in zip(starts[rest].tolist(), sizes[rest].tolist())])
        counts, begin = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        counts[which], counts[rest] = n, [len(x) // 4 for x in coded]
        begin[which], begin[rest] = np.cumsum(n) - n, len(ids) + np.cumsum(counts[rest]) - counts[rest]
        flat = np.r_[ids, np.frombuffer(b"".join(coded), "<u4")].astype(f"<u{self.width}")
        return flat[ranges(begin, counts)], counts

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes."""
        out: list[bytes] = [b""] * len(new)
        plain, cut = [], []
        for i, w in enumerate(new):
            s = w.decode()
            if s.isascii() and s.isalpha():
                plain.append((i, 1))
                cut.append(s.lower())
            elif s.isascii() and s[:-1].isalpha() and s[-1] in ",.;:!?":
                plain.append((i, 2))
                cut += (s[:-1].lower(), s[-1])
            elif PLAIN.fullmatch(s):
                pieces = PRE_TOKEN.findall(s.lower())
                plain.append((i, len(pieces)))
                cut += pieces
            else:
                out[i] = self._ids(self.tokenizer, s).tobytes()
        ids = self._ids(self.merger, " ".join(cut))
        stop = np.r_[0, np.flatnonzero(self.ends[ids]) + 1]
        if len(stop) != len(cut) + 1:  # a token of the vocabulary that ends no pre-token where it should
            for i, _ in plain:
                out[i] = self._ids(self.tokenizer, new[i].decode()).tobytes()
            return out
        data, at = ids.tobytes(), (4 * stop[np.cumsum([0, *(n for _, n in plain)])]).tolist()
        for k, (i, _) in enumerate(plain):
            out[i] = data[at[k]:at[k + 1]]
        return out

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text, with the end id, as slices of one array per lot."""
        # the vocabulary knows no upper case; only special tokens, which start with <|, must keep theirs
        data = np.frombuffer(b"\n".join([(t if b"<|" in t else t.lower()) if t else b"" for t in texts]) + b"\n", np.uint8)
        sizes = np.array([len(t) if t else 0 for t in texts])
        ends = np.cumsum(sizes + 1)
        edge = np.flatnonzero(np.diff(np.r_[False, ~WHITE[data], False].view(np.int8)))
        starts, lengths = edge[::2], edge[1::2] - edge[::2]
        which, of = distinct_runs(data, starts, lengths)
        word_at, word_size = starts[which], lengths[which]
        hashes = run_hashes(data, word_at, word_size)
        row = self.words.find(data, word_at, word_size, hashes)
        known, fresh = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        coded = [self._new(data, word_at[part], word_size[part]) for part in np.split(fresh, range(LEARN, len(fresh), LEARN)) if len(part)]
        learned = np.concatenate([c[0] for c in coded]) if coded else self.words.ids[:0]
        table = self.words.table[row[known]]
        counts, begin = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
        counts[known] = table["n"]
        counts[fresh] = np.concatenate([c[1] for c in coded]) if coded else []
        flat = np.r_[self.words.ids, learned]
        begin[known], begin[fresh] = table["ids"], len(self.words.ids) + np.cumsum(counts[fresh]) - counts[fresh]
        self.words.add(data, word_at[fresh], word_size[fresh], hashes[fresh], learned, counts[fresh])
        per_word = counts[of]
        # word by word, with room for the end id after the last word of each text
        words = np.diff(np.searchsorted(starts, np.r_[0, ends]))
        total = np.add.reduceat(np.r_[per_word, 0], np.minimum(np.cumsum(words) - words, len(per_word))) * (words > 0) + 1
        stop = np.cumsum(total)
        out = np.empty(int(stop[-1]) if len(stop) else 0, f"<u{self.width}")
        last = np.zeros(len(out), bool)
        last[stop - 1] = True
        out[last] = END_ID
        out[~last] = flat[ranges(begin[of], per_word)]
        return [out[a:b] for a, b in zip((stop - total).tolist(), stop.tolist())]


@functools.lru_cache(1)
def _encoder(tokenizer_json: str) -> Encoder:
    return Encoder(tokenizer_json)


def shard(number: int, doc_ids: list[int | None], counts: list[int], body: bytes, width: int) -> bytes:
    """One shard: header, coded doc ids, coded document ends, ids of ``width`` bytes.  Null doc ids come first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    above = known.view(np.uint64) - np.uint64(least % (1 << 64))  # ids may lie more than 2^63 apart
    return b"".join([HEADER.pack(MAGIC, 1, width, number, len(doc_ids), len(body) // width, least, len(doc_ids) - len(known)),
                     EliasFano.encode(above).to_bytes(), EliasFano.encode(np.cumsum(counts)).to_bytes(), body])


class Shard:
    """A shard read back: ``ids(i)`` is the i-th document's."""

    def __init__(self, data: memoryview):
        magic, version, self.width, self.number, self.n_docs, self.n_ids, self.least, self.nulls = HEADER.unpack_from(data, 0)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token shard")
        self.doc_ids, at = EliasFano.from_buffer(data, HEADER.size)
        self.ends, at = EliasFano.from_buffer(data, at)
        if len(data) < at + self.n_ids * self.width:
            raise ValueError("token shard is cut")
        self.body = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.doc_ids.select(i - self.nulls)

    def ids(self, i: int) -> np.ndarray:
        return self.body[self.ends.select(i - 1) if i else 0:self.ends.select(i)]

    def places(self, start: int, stop: int) -> tuple[list[int | None], np.ndarray]:
        """Doc ids of the documents from ``start`` to before ``stop``, and their boundaries, one more than documents."""
        known = self.doc_ids.select_range(max(start, self.nulls) - self.nulls, max(stop, self.nulls) - self.nulls)
        ids = (known + np.uint64(self.least % (1 << 64))).view(np.int64).tolist()
        before = self.ends.select(start - 1) if start else 0
        return [None] * (stop - start - len(ids)) + ids, np.r_[before, self.ends.select_range(start, stop).astype(np.int64)]


def _write(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        number = TaskContext.get().partitionId() << 32
        docs, counts, body = [], [], bytearray()

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard(number, docs, counts, bytes(body), encoder.width)], pa.binary())], ["shard"])

        for batch in batches:
            for part in slices(batch, size=LOT_BYTES):
                for d, x in zip(part.column("doc_id").to_pylist(), encoder.encode(raw(part.column("text")))):
                    docs.append(d)
                    counts.append(len(x))
                    body += x.tobytes()
                    if len(body) >= SHARD_IDS * encoder.width or len(docs) >= SHARD_DOCS:
                        yield close()
                        docs, counts, body = [], [], bytearray()
                        number += 1
        if docs:
            yield close()
    return run


def write(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Encode ``docs (doc_id, text)`` and write shards in ascending order of doc_id (null first, ties by a hash of the text) below ``path``.

    Texts are range-partitioned before they are encoded, so encoding runs once; only ids and hashes are sampled for the ranges.  Null and empty texts hold the end id only.
    """
    with open(tokenizer_path, encoding="utf-8") as f:  # of the driver; the tasks get its content
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    conf = docs.sparkSession.conf
    before = conf.get(BATCH)
    conf.set(BATCH, min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS)
    try:
        rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text") \
            .mapInArrow(_write(shared), "shard binary").select(F.col("shard").cast("string")) \
            .write.option("maxRecordsPerFile", 1).text(path)
    finally:
        conf.set(BATCH, before)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [HEADER.unpack(h.as_py()) for h in batch.column("head")]
        yield pa.RecordBatch.from_arrays([pa.array([h[3] for h in heads], pa.int64()), pa.array([h[5] for h in heads], pa.int64())], ["shard", "n"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            s = Shard(memoryview(batch.column("content")[i].as_buffer()))
            for k in range(0, s.n_docs, PLACES):
                ids, at = s.places(k, min(k + PLACES, s.n_docs))
                crc = [zlib.crc32(s.body[a:b].astype("<u4")) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s.number] * len(ids)), pa.array(ids, pa.int64()), pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    ["shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document below ``path``.

    Shards hold starts of their own; what lies before a shard is the running total of the shards' sizes, one number each.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = files.select(F.substring("content", 1, HEADER.size).alias("head"))  # the ids stay in the JVM
    base = heads.mapInArrow(_totals, "shard long, n long").withColumn("before", before).drop("n")
    return files.mapInArrow(_documents, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long").join(base, "shard") \
        .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def query(docs: DataFrame) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back.  No documents: no shard, no rows."""
    import public_tokenizers

    spark = docs.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, path)
