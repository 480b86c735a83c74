"""Quality rules: in-document repetition, and lines that too many documents of a host share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from mlframe.llm.common import free_names, raw, slices
from mlframe.runtime import durable

MIN_WORDS = 50
# A line is boilerplate of its host if more than this share of the host's different texts hold it; a few texts never make one.
LINE_DOCS, LINE_SHARE = 3, 0.02
# A document that keeps less than this share of its words without such lines is rejected.
KEPT_SHARE = 0.5
SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
INNER = bytes(range(0x80, 0xC0))  # bytes inside a UTF-8 character
DIGITS = re.compile(rb"[0-9]+")
SCANNED = ("doc_id long, host string, content long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, lines array<struct<line:long,words:int>>")


def normal_line(line: bytes) -> bytes:
    """Lower case in A-Z, single spaces, runs of digits as one 0."""
    return DIGITS.sub(b"0", b" ".join(line.lower().split()))


def _repeated(words: list[list[bytes]]) -> np.ndarray:
    """Per text, the number of words in 3-word windows found twice or more in it."""
    size = np.array([len(w) for w in words])
    h = np.fromiter((hash(w) for ws in words for w in ws), np.int64, int(size.sum())).view(np.uint64)
    owner = np.repeat(np.arange(len(words), dtype=np.int64), size)
    if len(h) < 3:
        return np.zeros(len(words), np.int64)
    m = np.uint64(0x9E3779B97F4A7C15)
    code = ((h[:-2] * m + h[1:-1]) * m + h[2:]) ^ (owner[2:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    at = np.flatnonzero(owner[2:] == owner[:-2])
    order = np.argsort(code[at])
    c = code[at][order]
    same = c[1:] == c[:-1]
    twice = at[order[np.r_[False, same] | np.r_[same, False]]] if len(c) else at
    cover = np.zeros(len(h), bool)
    for k in range(3):
        cover[twice + k] = True
    return np.bincount(owner[cover], minlength=len(words))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            texts = [t or b"" for t in raw(part.column("text"))]
            words = [t.split() for t in texts]
            chars = [len(t.translate(None, SPACES + INNER)) for t in texts]
            symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
            dups, lines = [], []
            for t in texts:
                seen, tally, dup = set(), {}, 0
                for line in t.split(b"\n"):
                    n = len(line.split())
                    if not n:
                        continue
                    dup += line in seen
                    seen.add(line)
                    key = xxhash.xxh64_intdigest(normal_line(line), 42)
                    tally[key] = tally.get(key, 0) + n
                dups.append(dup)
                lines.append(tally)
            keys = np.fromiter((k for x in lines for k in x), np.uint64).view(np.int64)
            inner = pa.StructArray.from_arrays([pa.array(keys), pa.array([n for x in lines for n in x.values()], pa.int32())], ["line", "words"])
            offsets = np.cumsum([0, *map(len, lines)]).astype(np.int32)
            content = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)
            counts = [list(map(len, words)), chars, symbols, dups, _repeated(words)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("host"), pa.array(content), *(pa.array(x, pa.int64()) for x in counts),
                 pa.ListArray.from_arrays(pa.array(offsets), inner)],
                ["doc_id", "host", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])


def judge(docs: DataFrame, host: str = "source", line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """One row per row of ``docs``: counts, ``n_removed`` (words in lines above the limits), ``base_failed``, ``kept``;
    and ``host``, ``content`` and ``cut``, the hash of the text and those of its lines above the limits.

    Lines are compared by hash after ``normal_line``.  A host's documents are its different texts, so copies of one text do
    not make its lines frequent.  Null and empty texts have no words and fail; a null host is a host.  Repeated rows get
    equal results.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                       F.col("text").cast("string").alias("text"))
    scanned = durable(rows.mapInArrow(_scan, SCANNED).withColumn("rid", F.monotonically_increasing_id()))
    texts = scanned.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    lines = scanned.select("rid", "host", "content", F.explode("lines").alias("l")).select("rid", "host", "content", "l.line", "l.words")
    often = lines.select("host", "line", "content").distinct().groupBy("host", "line").agg(F.count("*").alias("n")) \
        .where(F.col("n") > line_docs)
    t = texts.withColumnRenamed("host", "h")
    often = often.join(t, F.col("host").eqNullSafe(F.col("h"))).where(F.col("n") > line_share * F.col("texts")) \
        .select(F.col("host").alias("h"), F.col("line").alias("k"))
    removed = lines.join(often, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("k"))) \
        .groupBy("rid").agg(F.sum("words").alias("n_removed"), F.collect_set("line").alias("cut"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    n_removed = F.coalesce("n_removed", F.lit(0))
    return scanned.drop("lines").join(removed, "rid", "left").select(
        "doc_id", "host", "content", "cut", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", n_removed.alias("n_removed"),
        failed.alias("base_failed"), (~failed & (F.col("n_words") - n_removed >= KEPT_SHARE * F.col("n_words"))).alias("kept"))


def _strip(cut: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, lines in zip(raw(batch.column("text")), batch.column(cut).to_pylist()):
                if t and lines:
                    keys = {k & 0xFFFFFFFFFFFFFFFF for k in lines}
                    t = b"\n".join(x for x in t.split(b"\n") if not x.split() or xxhash.xxh64_intdigest(normal_line(x), 42) not in keys)
                texts.append(t)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.binary()).cast(pa.string()))
    return run


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, that pass, their texts without the lines above the limits (the rest in order).

    Rows are found again by id, host and text, so rows without an id are judged too, and rows that share an id each by their own text.
    ``n_chars``, if there is one, follows a text that lost a line.  An empty table gives no rows; columns of any name pass through.
    """
    rid, of, text, kept, cut = free_names(docs, "_judged_id", "_judged_host", "_judged_text", "_kept", "_cut")
    touched = judge(docs, host).where(~F.col("kept") | F.col("cut").isNotNull()) \
        .groupBy(F.col("doc_id").alias(rid), F.col("host").alias(of), F.col("content").alias(text)) \
        .agg(F.first("kept").alias(kept), F.first("cut").alias(cut))
    content = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col(rid)) & F.col(host).eqNullSafe(F.col(of)) & (content == F.col(text))
    good = docs.join(touched, same, "left").where(F.coalesce(kept, F.lit(True))).select(*docs.columns, cut)
    out = good.mapInArrow(_strip(cut), good.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(cut).isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.drop(cut)


def query(docs: DataFrame) -> DataFrame:
    return judge(docs).drop("host", "content", "cut")
