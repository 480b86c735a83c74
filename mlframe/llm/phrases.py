"""Phrase collocations by three-way quicksort of suffix pointers.

Every word of a text starts a suffix of up to LONGEST words that ends with its piece.  Suffixes are routed over the cluster by their
leading words, so all that start alike meet in one bucket.  There a multikey quicksort splits them around pivots into less, equal
and greater, word by word: the size of an equal part is the count of a phrase, and parts below the least count are
abandoned.  A leading word that would fill more than its share of a bucket is routed by two leading words, or three, or four; counts of its shorter
phrases are then sums over buckets.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from mlframe.llm.common import group_starts, kinds, ranges, raw, slices, whole_groups
from mlframe.runtime import durable

LONGEST, LEAST = 4, 30
# A phrase falls where a longer one holds it in at least this share of its occurrences.
INSIDE = 80
TOP = 2000
# Bytes of text in a lot, and suffixes meant for a bucket.
LOT_BYTES, BUCKET = 3_000_000, 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What ends a piece, what parts words.
BREAKS, GAPS = b".,;:!?\n\v\f\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(GAPS)], _KIND[list(BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
HEAD = struct.Struct("<qqBB?")
_GAP = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_AHEAD = re.compile(rb"(?:[\x20\x09]*[^\x20\x09.,;:!?\x0A-\x0D]+){0,%d}" % (LONGEST - 1))


def _stretches(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A long text in stretches that end with a word, each with the words that its last suffixes need, and its own length."""
    at = 0
    while len(text) - at > LOT_BYTES and (m := _GAP.search(text, at + LOT_BYTES)):
        yield text[at:_AHEAD.match(text, m.start()).end()], m.start() - at
        at = m.start()
    yield text[at:] if at else text, len(text) - at


class Lot:
    """Distinct suffixes of some texts, sorted: ``lang`` and ``keys`` (LONGEST rows of word numbers from 1, 0 past the end), ``counts``."""

    def __init__(self, stretches: list[tuple[str, bytes, int]]):
        self.langs, lang_of = np.unique(np.array([s[0] for s in stretches], object), return_inverse=True)
        data = _LOWER[np.frombuffer(b"\n".join([s[1] for s in stretches]) + b"\n", np.uint8)]
        kind = _KIND[data]
        inner = kind == 0
        edge = np.flatnonzero(np.diff(np.r_[False, inner, False].view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        if len(starts) == 0:
            self.words, self.lang, self.counts = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.keys, self.total = np.zeros((LONGEST, 0), np.int32), 0
            return
        offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
        letters = data[inner]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self.words = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy().astype(np.int64) + 1
        piece = np.cumsum(kind == 2)[starts]
        begins = np.cumsum([0] + [len(s[1]) + 1 for s in stretches[:-1]])
        of = np.searchsorted(begins, starts, side="right") - 1
        own = np.flatnonzero(starts - begins[of] < np.array([s[2] for s in stretches])[of])
        base = len(self.words) + 1
        keys = [code[own]]
        for k in range(1, LONGEST):
            later = np.zeros(len(code), np.int64)
            later[:-k] = np.where(piece[k:] == piece[:-k], code[k:], 0)
            keys.append(later[own])
        high, low = (lang_of[of[own]] * base + keys[0]) * base + keys[1], keys[2] * base + keys[3]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        self.counts = np.diff(np.r_[first, len(own)])
        self.total = len(own)
        self.lang = high[first] // base // base
        self.keys = np.stack([high[first] // base % base, high[first] % base, low[first] // base, low[first] % base]).astype(np.int32)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the first 1, 2, .. words of every suffix with its language."""
        h = np.array([0] + [xxhash.xxh64_intdigest(w, 7) for w in self.words], np.uint64)
        seed = np.array([xxhash.xxh64_intdigest(x.encode(), 11) for x in self.langs], np.uint64)[self.lang]
        out = []
        with np.errstate(over="ignore"):
            for k in range(LONGEST):
                seed = (seed ^ (seed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[self.keys[k]]
                out.append(seed)
        return np.stack(out)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[Lot]:
    held, size = [], 0
    for batch in (part for whole in batches for part in slices(whole)):
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, raw(batch.column("text"))):
            for part, own in _stretches(text):
                held.append((lang, part, own))
                size += len(part)
                if size >= LOT_BYTES:
                    yield Lot(held)
                    held, size = [], 0
    if held:
        yield Lot(held)


def _scan(share: int):
    """Words of each language in a lot (hash null), and leading words that start more than one of ``share`` of the lot's suffixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _lots(batches):
            if not lot.total:
                continue
            sizes = np.bincount(lot.lang, lot.counts, len(lot.langs)).astype(np.int64)
            langs, hashes, counts = list(lot.langs), [None] * len(lot.langs), sizes.tolist()
            h = lot.hashes()
            for k in range(LONGEST - 1):
                new = np.r_[True, (np.diff(lot.lang) != 0) | (np.diff(lot.keys[:k + 1], axis=1) != 0).any(axis=0)]
                at = np.flatnonzero(new)
                n = np.add.reduceat(lot.counts, at)
                often = n * share >= lot.total
                langs += [None] * int(often.sum())
                hashes += h[k][at[often]].view(np.int64).tolist()
                counts += n[often].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(counts, pa.int64())], ["lang", "hash", "n"])
    return run


def _route(hot: np.ndarray, buckets: int):
    """A lot's suffixes by bucket: words, their numbers in each suffix, counts, and how many leading words count in several buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _lots(batches):
            if not lot.total:
                continue
            h = lot.hashes()
            parted = np.zeros(len(lot.counts), np.int8)
            for k in range(LONGEST - 1):
                parted[(parted == k) & np.isin(h[k], hot)] = k + 1
            bucket = (h[parted, np.arange(len(parted))] >> np.uint64(13)) % np.uint64(buckets)
            group = bucket.astype(np.int64) * len(lot.langs) + lot.lang
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0])
            lines = np.frombuffer(b"\n".join(lot.words) + b"\n", np.uint8)  # no word holds a line end
            sizes = np.array([len(w) + 1 for w in lot.words])
            places = np.cumsum(sizes) - sizes
            packer = zstandard.ZstdCompressor(1)
            rows_out: list[tuple[int, str, bytes]] = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                rows = order[a:b]
                g = int(group[rows[0]])
                data = packer.compress(_pack(lines, places, sizes, lot.keys[:, rows], lot.counts[rows], parted[rows]))
                rows_out.append((g // len(lot.langs), lot.langs[g % len(lot.langs)], data))
            bucket_of, lang_of, data = zip(*rows_out)
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of, pa.int64()), pa.array(lang_of, pa.string()), pa.array(data, pa.binary())],
                                             ["bucket", "lang", "data"])
    return run


PACKED = "bucket long, lang string, data binary"


def _pack(lines: np.ndarray, places: np.ndarray, sizes: np.ndarray, keys: np.ndarray, counts: np.ndarray, parted: np.ndarray) -> bytes:
    """Suffixes with the words they use: sizes, the words in lines, numbers of words by place, counts, and ``parted`` if any."""
    first, local = kinds(keys.ravel())
    used = keys.ravel()[first]
    used, local = (used, local) if used[0] == 0 else (np.r_[0, used], local + 1)
    text = lines[ranges(places[used[1:] - 1], sizes[used[1:] - 1])].tobytes()[:-1]
    width, size = 2 if len(used) < 1 << 16 else 4, next(k for k in (1, 2, 4, 8) if k == 8 or int(counts.max()) < 1 << 8 * k)
    some = parted.any()
    return b"".join([HEAD.pack(keys.shape[1], len(text), width, size, some), text, local.astype(f"<u{width}").tobytes(),
                     counts.astype(f"<u{size}").tobytes(), parted.tobytes() if some else b""])


def _unpack(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    n, n_text, width, size, some = HEAD.unpack_from(data)
    at = HEAD.size + n_text
    keys = np.frombuffer(data, f"<u{width}", LONGEST * n, at).reshape(LONGEST, n)
    counts = np.frombuffer(data, f"<u{size}", n, at + keys.nbytes)
    parted = np.frombuffer(data, np.int8, n, at + keys.nbytes + counts.nbytes) if some else np.zeros(n, np.int8)
    return data[HEAD.size:at], keys, counts.astype(np.int64), parted


def partition_sort(keys: np.ndarray, counts: np.ndarray, parted: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of pointers to the columns of ``keys``; all parts of a round are split at once.

    Row 0 of ``keys`` is the language, the others are words, 0 past the end of a suffix.  Returns a pointer, the number of words, and the
    count for every phrase of at least ``least`` occurrences, or whose first words count in several buckets (``parted``).
    """
    n = keys.shape[1]
    flat = keys.ravel()
    ptr, sizes, depth = np.arange(n), np.array([n]), np.zeros(1, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(ptr):
        starts = np.cumsum(sizes) - sizes
        key = flat[np.repeat(depth * n, sizes) + ptr]
        ends = np.sort(np.stack([key[starts], key[starts + sizes // 2], key[starts + sizes - 1]]), axis=0)
        pivot = ends[1]
        around = np.repeat(pivot, sizes)
        side = (key > around).astype(np.int64) - (key < around) + 1
        part = np.repeat(np.arange(len(sizes)), sizes) * 3 + side
        split = np.bincount(part, minlength=3 * len(sizes))
        place = np.cumsum(split) - split
        moved = np.empty_like(ptr)
        for s in (0, 1, 2):  # order within a side stays
            moved[ranges(place[s::3], split[s::3])] = ptr[side == s]
        filled = np.flatnonzero(split)
        at = place[filled]
        weight = np.add.reduceat(counts[moved], at)
        most = np.maximum.reduceat(parted[moved], at)
        equal, of = filled % 3 == 1, filled // 3
        deep = depth[of]
        whole = equal & (deep > 0) & (pivot[of] > 0) & ((weight >= least) | (most >= deep))
        found.append((moved[at[whole]], deep[whole], weight[whole]))
        on = np.where(equal, (deep < len(keys) - 1) & ((deep == 0) | (pivot[of] > 0)) & ((weight >= least) | (most > deep)),
                      (weight >= least) | (most >= np.maximum(deep, 1)))
        ptr = moved[np.repeat(on, split[filled])]
        sizes, depth = split[filled][on], (deep + equal)[on]
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table a bucket, so a task sorts no more than a bucket at a time."""
    for rows in whole_groups(batches, ["bucket"]):
        cuts = np.flatnonzero(group_starts(rows, ["bucket"])).tolist()
        for a, b in zip(cuts, [*cuts[1:], rows.num_rows]):
            yield rows.slice(a, b - a)


def _sorted_bucket(group: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    langs = group.column("lang").to_pylist()
    lang_no = {x: i for i, x in enumerate(dict.fromkeys(langs))}
    parts = [_unpack(unpacker.decompress(x.as_py())) for x in group.column("data")]
    # all words of the bucket, numbered anew
    buffer = np.frombuffer(b"\n".join([p[0] for p in parts]) + b"\n", np.uint8)
    ends = np.flatnonzero(buffer == 10)
    offsets = np.r_[0, ends + 1] - np.arange(len(ends) + 1)
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(buffer[buffer != 10])]).dictionary_encode()
    del buffer, ends, offsets
    number = coded.indices.to_numpy().astype(np.int32) + 1
    sizes = [p[1].shape[1] for p in parts]
    matrix = np.empty((1 + LONGEST, sum(sizes)), np.int32)
    counts, parted = np.empty(matrix.shape[1], np.int64), np.empty(matrix.shape[1], np.int8)
    at = to = 0
    for k, (lang, n) in enumerate(zip(langs, sizes)):
        text, local, counts[to:to + n], parted[to:to + n] = parts[k]
        parts[k] = None
        names = np.r_[np.int32(0), number[at:at + text.count(b"\n") + 1]]
        at += len(names) - 1
        matrix[0, to:to + n], matrix[1:, to:to + n] = lang_no[lang], names[local]
        to += n
    words, names = coded.dictionary, list(lang_no)
    del parts, number, coded
    ptr, depth, weight = partition_sort(matrix, counts, parted, least)
    for k in range(0, len(ptr), 50_000):
        p, d = ptr[k:k + 50_000], depth[k:k + 50_000]
        text = [words.take(pa.array(np.maximum(matrix[1 + j, p] - 1, 0))).to_pylist() for j in range(LONGEST)]
        phrases = [b" ".join(t[:n]).decode() for *t, n in zip(*text, d.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in matrix[0, p].tolist()], pa.string()), pa.array(phrases, pa.string()), pa.array(d, pa.int32()),
             pa.array(weight[k:k + 50_000])], ["lang", "phrase", "size", "f"])


def _sorted_buckets(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _buckets(batches):
            yield from _sorted_bucket(group, least)
    return run


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, f`` of all phrases of 1 to LONGEST words that occur at least ``least`` times, and ``lang, n`` of all words.

    Two passes over the texts.  The first counts words and finds leading words that start more than one of 4 x partitions of all
    suffixes: at most 12 x partitions 64-bit hashes, which go to the tasks.  They only spread the work; counts do not depend on them.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scanned = durable(rows.mapInArrow(_scan(4 * partitions), "lang string, hash long, n long").groupBy("lang", "hash").agg(F.sum("n").alias("n")))
    totals = scanned.where("hash IS NULL").select("lang", "n")
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot = [r.hash for r in scanned.where(F.col("hash").isNotNull() & (F.col("n") * 4 * partitions >= total)).select("hash").collect()]
    buckets = max(partitions, total // BUCKET + 1)
    routed = rows.mapInArrow(_route(np.array(hot, np.int64).view(np.uint64), buckets), PACKED)
    parts = routed.repartition(partitions, "bucket").sortWithinPartitions("bucket") \
        .mapInArrow(_sorted_buckets(least), "lang string, phrase string, size int, f long")
    return parts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least), totals


def _words(phrase: Column, start: int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, n), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to LONGEST words.

    Score: 2,000,000 a / (l + r), rounded down, at the cut where it is lowest (the first of equal ones).  A phrase inside a longer one of
    at least INSIDE percent of its count is dropped.  Null texts are empty, a null language is ``und``; repeated rows count again,
    doc_ids and other columns make no difference.  Equal scores are ranked by count, then by the bytes of the phrase, so ranks have no ties.
    No phrase often enough, or an empty table: no rows.
    """
    counted, totals = count_phrases(docs, least)
    counted = durable(counted)
    long = counted.where("size > 1")
    # frequencies of the two sides of every cut; a single word can be a side of very many phrases, so these are dealt by a salt
    salt = lambda c: F.when(F.size(F.split(c, " ")) == 1, F.pmod(F.xxhash64("phrase"), F.lit(16)).cast("int")).otherwise(F.lit(0))
    sides = counted.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"),
                           F.explode(F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(15))).otherwise(F.array(F.lit(0)))).alias("salt"))
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left = cuts.withColumn("part", _words(F.col("phrase"), 1, F.col("k"))).withColumn("salt", salt(F.col("part"))) \
        .join(sides, ["lang", "part", "salt"]).withColumnRenamed("part_f", "l").drop("part", "salt")
    both = left.withColumn("part", F.expr("array_join(slice(split(phrase, ' '), k + 1, size), ' ')")).withColumn("salt", salt(F.col("part"))) \
        .join(sides, ["lang", "part", "salt"]).withColumnRenamed("part_f", "r").drop("part", "salt")
    exact = F.expr("CAST(2000000 AS DECIMAL(8, 0)) * CAST(f AS DECIMAL(20, 0)) div (l + r)").cast("long")
    scored = both.withColumn("cut", F.struct(exact.alias("score"), "k", "l", "r")) \
        .groupBy("lang", "phrase", "f").agg(F.min("cut").alias("cut"))
    # every phrase of two or more words inside a longer one, with the largest count of those
    inner = long.where("size > 2").select("lang", F.col("f").alias("outer_f"), F.explode(F.expr(
        "array_distinct(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, m), ' ')))))")).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("outer_f").alias("outer_f"))
    hidden = F.col("outer_f").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * INSIDE
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("outer_f").isNull() | ~hidden) \
        .select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within parts of a language, so no task sorts more than a part and the tops of the parts
    some = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang),
placed AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (
  SELECT lang, s AS size, array_to_string(ws[i:i + s - 1], ' ') AS phrase
  FROM placed, (SELECT unnest(range(1, 5)) AS s) WHERE i + s - 1 <= len(ws)),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, size, phrase, f, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS ws FROM counted WHERE size > 1),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS outer_f
  FROM (SELECT DISTINCT lang, f, size, ws FROM cuts), (SELECT unnest(range(2, 4)) AS m), (SELECT unnest(range(1, 4)) AS i)
  WHERE m < size AND i + m - 1 <= size GROUP BY 1, 2),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_ o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.outer_f IS NULL OR 100::HUGEINT * o.outer_f < 80::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
