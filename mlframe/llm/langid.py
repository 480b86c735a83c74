"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from mlframe.llm.common import raw, remainder, slices

MODULUS, HELD_OUT = 4, 2
ORDER = 4
DISCOUNT = 0.75
# The models are fitted on whole training texts in the order of a hash: for each language up to the one that reaches so many characters.
SAMPLE_CHARS = 1_500_000
# Running totals over that order are taken by cells of it, 2 ** CELL_BITS for each language.
CELL_BITS = 12
# Share of the sample that is kept from the counts to calibrate rejection, and the share of it that may be rejected.
CALIBRATE, REJECT = 0.2, 0.001
SEED = 11


@functools.cache
def _symbols() -> np.ndarray:
    """Symbol of every code point: 0 for anything but a letter, else the code point folded to 16 bits."""
    at = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(letter, np.maximum(1, (at ^ (at >> 16) * 40503) & 0xFFFF), 0).astype(np.uint64)


def grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all character 4-grams, the text each belongs to, and the number of letters of each text.

    Texts are lower-cased; runs of other characters are one blank; each text starts with three blanks and ends with one.
    """
    parts = [("   " + t.decode().lower() + " ").encode("utf-32-le") if t else b"" for t in texts]
    flat = np.frombuffer(b"".join(parts), np.uint32)
    sym = _symbols()[flat]
    owner = np.repeat(np.arange(len(texts)), [len(p) // 4 for p in parts])
    letters = np.bincount(owner[sym > 0], minlength=len(texts))
    start = np.r_[True, owner[1:] != owner[:-1]][:len(owner)]
    back = np.zeros(len(owner), bool)  # the three leading blanks stay
    for k in range(3):
        back[np.flatnonzero(start) + k] = True
    keep = back | (sym > 0) | np.r_[True, sym[:-1] > 0][:len(sym)]
    sym, owner = sym[keep], owner[keep]
    if len(sym) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), letters
    code = (sym[:-3] << np.uint64(48)) | (sym[1:-2] << np.uint64(32)) | (sym[2:-1] << np.uint64(16)) | sym[3:]
    own = owner[3:] == owner[:-3]
    return code[own], owner[3:][own], letters


def _mask(k: int) -> np.uint64:
    return np.uint64((1 << (16 * k)) - 1)


@dataclass
class Model:
    """Interpolated log2 probabilities of n-grams seen in any language (sorted codes x languages), and back-off weights."""

    langs: list[str]
    keys: list[np.ndarray]  # by order, 1 first
    logp: list[np.ndarray]
    contexts: list[np.ndarray]  # of order + 1
    backoff: list[np.ndarray]
    floor: float
    limits: np.ndarray | None = None

    @staticmethod
    def fit(langs: list[str], lang: np.ndarray, code: np.ndarray, count: np.ndarray) -> Model:
        """From counts of the highest order.  Lower orders count the distinct symbols before an n-gram."""
        keys, at = np.unique(code, return_inverse=True)
        seen = np.zeros((len(keys), len(langs)))
        np.add.at(seen, (at, lang), count)
        levels = [(keys, seen)]
        for k in range(ORDER - 1, 0, -1):
            top, cnt = levels[0]
            low, at = np.unique(top & _mask(k), return_inverse=True)
            cont = np.zeros((len(low), len(langs)))
            np.add.at(cont, at, (cnt > 0).astype(float))
            levels.insert(0, (low, cont))
        floor = 1.0 / (len(levels[0][0]) + 1)
        out = Model(langs, [], [], [], [], float(np.log2(floor)))
        for k, (keys, cnt) in enumerate(levels):
            ctx, at = np.unique(keys >> np.uint64(16), return_inverse=True) if k else (np.zeros(1, np.uint64), np.zeros(len(keys), np.int64))
            total, kinds = np.zeros((len(ctx), len(langs))), np.zeros((len(ctx), len(langs)))
            np.add.at(total, at, cnt)
            np.add.at(kinds, at, (cnt > 0).astype(float))
            with np.errstate(divide="ignore", invalid="ignore"):
                gamma = np.where(total > 0, DISCOUNT * kinds / total, 1.0)
                own = np.where(total[at] > 0, np.maximum(cnt - DISCOUNT, 0) / total[at], 0.0)
            lower = 2.0 ** out.logp[k - 1][np.searchsorted(out.keys[k - 1], keys & _mask(k))] if k else floor
            out.keys.append(keys)
            out.logp.append(np.log2(own + gamma[at] * lower))
            out.contexts.append(ctx)
            out.backoff.append(np.log2(gamma))
        out.logp = [x.astype(np.float32) for x in out.logp]
        out.backoff = [x.astype(np.float32) for x in out.backoff]
        return out

    def bits(self, code: np.ndarray) -> np.ndarray:
        """log2 probability of the last symbol of each 4-gram after the others, for each language."""
        out = np.zeros((len(code), len(self.langs)), np.float32)
        rest = np.arange(len(code))
        for k in range(ORDER - 1, -1, -1):
            c = code[rest] & _mask(k + 1) if k < ORDER - 1 else code
            at = np.minimum(np.searchsorted(self.keys[k], c), len(self.keys[k]) - 1)
            hit = self.keys[k][at] == c
            if hit.all():
                out[rest] += self.logp[k][at]
                return out
            out[rest[hit]] += self.logp[k][at[hit]]
            rest, c = rest[~hit], c[~hit]
            ctx = c >> np.uint64(16)
            at = np.minimum(np.searchsorted(self.contexts[k], ctx), len(self.contexts[k]) - 1)
            here = self.contexts[k][at] == ctx
            out[rest[here]] += self.backoff[k][at[here]]
        out[rest] += self.floor
        return out

    def entropy(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy in bits a symbol (texts x languages), the number of symbols, and of letters."""
        code, owner, letters = grams(texts)
        n = np.bincount(owner, minlength=len(texts))
        total = np.zeros((len(texts), len(self.langs)))
        step = 1 << 19
        for i in range(0, len(code), step):  # long texts are summed piece by piece
            got, who = self.bits(code[i:i + step]), owner[i:i + step]
            first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            total[who[first]] += np.add.reduceat(got, first, axis=0, dtype=np.float64)
        return -total / np.maximum(n, 1)[:, None], n, letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            langs = np.array(part.column("lang").to_pylist())
            texts = raw(part.column("text"))
            for lang in np.unique(langs):
                code, _, _ = grams([t for t, x in zip(texts, langs) if x == lang])
                keys, count = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([str(lang)] * len(keys)), pa.array(keys.view(np.int64)), pa.array(count)],
                                                 ["lang", "code", "n"])


def _counted(rows: DataFrame) -> pa.Table:
    return rows.select("lang", "text").mapInArrow(_count, "lang string, code long, n long") \
        .groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()


def _placed(rows: DataFrame) -> DataFrame:
    """Texts with a letter and their place in the order of a hash."""
    return rows.where(F.col("text").rlike(r"\p{L}")).withColumn("place", F.xxhash64("doc_id", "text", F.lit(SEED)))


def bounds(rows: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, int]:
    """For each language of ``rows (doc_id, text, lang)`` the place of the text whose characters bring the running total to ``chars``.

    It is the last place if there are fewer.  Characters are summed by cells of the order; only the cell in which the
    bound is reached is summed text by text.
    """
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sized = _placed(rows).select("lang", "place", F.length("text").alias("size"), F.shiftright("place", 64 - CELL_BITS).alias("cell"))
    cells = sized.groupBy("lang", "cell").agg(F.sum("size").alias("size"))
    reached = cells.withColumn("before", before(Window.partitionBy("lang").orderBy("cell"))).where(F.col("before") < chars) \
        .groupBy("lang").agg(F.max(F.struct("cell", "before")).alias("m")).select("lang", "m.cell", "m.before")
    inside = sized.join(F.broadcast(reached), ["lang", "cell"]) \
        .withColumn("before", F.col("before") + before(Window.partitionBy("lang").orderBy("place")))
    last = inside.where(F.col("before") < chars).groupBy("lang").agg(F.max("place").alias("place"))
    return {r.lang: r.place for r in last.toLocalIterator()}


def train(docs: DataFrame) -> Model | None:
    """Models of every language of the training rows ``(doc_id, text, lang)``; None if there is none.

    Held-out rows and rows without text or lang are never looked at.  A language's texts in the order of a hash are taken up to
    the one that reaches SAMPLE_CHARS characters (a language with fewer brings all), so counts, models and calibration are
    bounded.  About a fifth of them calibrates; a language of which nothing else is left is counted from those too.
    """
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .where((remainder(F.col("doc_id"), MODULUS) != HELD_OUT) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    last = bounds(rows)
    if not last:
        return None
    drawn = _placed(rows).where(F.col("place") <= F.create_map(*[F.lit(x) for kv in sorted(last.items()) for x in kv])[F.col("lang")])
    spared = F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED + 1)), F.lit(1 << 30)) < int(CALIBRATE * (1 << 30))
    shown, tested = drawn.where(~spared), drawn.where(spared)
    counts = _counted(shown)
    left = sorted(set(last) - set(counts.column("lang").to_pylist()))
    if left:  # languages of a handful of texts: nothing is left for calibration
        counts = pa.concat_tables([counts, _counted(tested.where(F.col("lang").isin(left)))])
    if not counts.num_rows:
        return None
    names = sorted(set(counts.column("lang").to_pylist()))
    index = {x: i for i, x in enumerate(names)}
    model = Model.fit(names, np.array([index[x] for x in counts.column("lang").to_pylist()]),
                      counts.column("code").to_numpy().view(np.uint64), counts.column("n").to_numpy())
    got = tested.select("text", F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out")) \
        .mapInArrow(_predict(model, docs), PREDICTED).where("lang_pred <> 'und'").select("lang_pred", "bits").toArrow()
    lang, bits = np.array(got.column("lang_pred").to_pylist()), got.column("bits").to_numpy()
    model.limits = np.array([np.quantile(bits[lang == x], 1 - REJECT) * 1.1 if (lang == x).any() else np.inf for x in names])
    return model


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, bits double, accepted boolean"


def _predict(model: Model | None, docs: DataFrame):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch):
                texts = raw(part.column("text"))
                if model is None:
                    lang, score, bits, ok = ["und"] * len(texts), np.zeros(len(texts)), [None] * len(texts), [False] * len(texts)
                else:
                    h, n, letters = model.entropy(texts)
                    best = h.argmin(1)
                    low = h[np.arange(len(h)), best]
                    odds = np.exp2(-np.minimum((h - low[:, None]) * np.minimum(n, 200)[:, None], 500))
                    taken = np.ones(len(h), bool) if model.limits is None else low <= model.limits[best]
                    score = np.where(taken, 1.0, 0.5) / odds.sum(1)
                    und = letters == 0
                    lang = ["und" if u else model.langs[b] for u, b in zip(und, best)]
                    score, ok = np.where(und, 0.0, score), taken & ~und
                    bits = pa.array(low, mask=und)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(bits, pa.float64()), pa.array(ok, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "bits", "accepted"])
    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits, accepted`` for every row; lang and source are not read.

    The language of the lowest cross-entropy a symbol wins (ties: first name).  ``score`` is its share of the likelihoods over
    at most 200 symbols, halved for a text whose entropy is above what the language's calibration texts reach (``accepted``
    false).  Texts that are null or hold no letter, and all texts if nothing was learned: 'und' with score 0.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out")) \
        .mapInArrow(_predict(model, docs), PREDICTED)


def query(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
