"""Language-model scores from a lattice of subwords: every segmentation of a text counts.

The pieces and their first weights come from an existing vocabulary; expectation-maximisation over all training words fits
the weights to the corpus.  Pieces do not cross words, so the probability of a text is the product over its words of the
sum over each word's segmentations, and the probability of the end.  A word is worked on once for the corpus, not once for
each place where it stands: Spark counts words, scores the distinct ones, and joins the scores back.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from mlframe.llm.common import raw, remainder, slices
from mlframe.runtime import durable

MODULUS, HELD_OUT = 7, 2
EM_ROUNDS = 1
# Words that travel to the tasks as a table; all others are joined.  Longer words are never among them.
FREQUENT, FREQUENT_BYTES = 50_000, 32
# A task sends its word counts on when it holds so many.
HELD_WORDS = 400_000
START = "▁"
# Words of at most so many characters are tried on probabilities, which hold if their total is above LEAST.
SHORT, LEAST = 200, 1e-280


def vocabulary(path: str) -> tuple[dict[str, int], np.ndarray]:
    """Pieces with their ids, and their first log weights.

    Merge-ranked vocabularies score a piece by minus its rank; such scores become 1 / (rank + 2), those of unigram models are log
    probabilities already.  Byte pieces, which spell characters without a piece, get the least weight.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores = {}, np.full(model.get_piece_size() + 1, -math.inf)
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            ids[f"<{i}>"] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e8:
            ids[model.id_to_piece(i)] = i
            scores[i] = model.get_score(i)
    byte = sorted((int(model.id_to_piece(i)[3:5], 16), i) for k, i in ids.items() if k == f"<{i}>")
    for i in [i for _, i in byte]:
        del ids[f"<{i}>"]
    known = np.isfinite(scores)
    if known.any() and np.median(scores[known]) < -100:
        scores[known] = -np.log(2 - scores[known])
    floor = scores[known].min() if known.any() else 0.0
    for b, i in byte:
        ids[f"\0{b}"] = i
        scores[i] = floor
    scores[-1] = math.log(0.01)  # the end of a text
    return ids, scores - np.log(np.exp(scores[np.isfinite(scores)]).sum())


class Lattice:
    """Forward and forward-backward recursions over the segmentations of one word.

    Both first run on plain probabilities, with one look-up per character and start.  All terms are positive, so what gets
    lost below the least double is less than LEAST / 1e-308 of a total above LEAST; words of a smaller total run on logs.
    """

    def __init__(self, ids: dict[str, int], logp: np.ndarray):
        self.logp = logp.tolist()
        self.ids = {k: v for k, v in ids.items() if k[:1] != "\0"}
        self.bytes = {int(k[1:]): v for k, v in ids.items() if k[:1] == "\0"}
        self.steps: dict[str, int] = {}  # every prefix of a piece; -1 if it is none itself
        for k in self.ids:
            for j in range(1, len(k)):
                self.steps.setdefault(k[:j], -1)
        self.steps |= self.ids
        # the same pieces by characters: what may follow, the id or -1, the probability
        self.tree: dict[str, tuple[dict, int, float]] = {}
        nodes = {"": self.tree}
        for k in sorted(self.steps):
            p = self.steps[k]
            nodes[k] = below = {}
            nodes[k[:-1]][k[-1]] = (below, p, math.exp(self.logp[p]) if p >= 0 else 0.0)

    def spelled(self, c: str) -> tuple[tuple[int, ...], float]:
        """The byte pieces of a character, and their log weight."""
        pieces = tuple(self.bytes[b] for b in c.encode())
        return pieces, sum(self.logp[p] for p in pieces)

    def edges(self, s: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For every start, (end, log weight, pieces).  A character without a piece of its own is spelled in bytes."""
        out, steps, logp = [], self.steps.get, self.logp
        for i in range(len(s)):
            here, j = [], i + 1
            while (p := steps(s[i:j])) is not None:
                if p >= 0:
                    here.append((j, logp[p], (p,)))
                j += 1
                if j > len(s):
                    break
            if s[i] not in self.ids:
                pieces, lp = self.spelled(s[i])
                here.append((i + 1, lp, pieces))
            out.append(here)
        return out

    def forward(self, s: str) -> float:
        """Log of the summed probability of all segmentations."""
        n, ids = len(s), self.ids
        if n <= SHORT:
            alpha = [1.0] + [0.0] * n
            for i in range(n):
                a, node = alpha[i], self.tree
                for j in range(i, n):
                    if (got := node.get(s[j])) is None:
                        break
                    node, p, q = got
                    if p >= 0:
                        alpha[j + 1] += a * q
                if s[i] not in ids:
                    alpha[i + 1] += a * math.exp(self.spelled(s[i])[1])
            if alpha[n] > LEAST:
                return math.log(alpha[n])
        return self.forward_log(s)

    def forward_log(self, s: str) -> float:
        n, exp, log = len(s), math.exp, math.log
        into: list[list[float]] = [[] for _ in range(n + 1)]
        into[0].append(0.0)
        steps, ids, logp = self.steps.get, self.ids, self.logp
        for i in range(n):
            got = into[i]
            m = max(got)
            a = m + log(sum([exp(x - m) for x in got])) if len(got) > 1 else m
            into[i] = ()
            j = i + 1
            while (p := steps(s[i:j])) is not None:
                if p >= 0:
                    into[j].append(a + logp[p])
                j += 1
                if j > n:
                    break
            if s[i] not in ids:
                into[i + 1].append(a + self.spelled(s[i])[1])
        m = max(into[n])
        return m + log(sum([exp(x - m) for x in into[n]]))

    def expect(self, s: str, weight: float, into: np.ndarray | list[float]) -> None:
        """Add ``weight`` times the expected uses of each piece in ``s`` to ``into``."""
        n, ids = len(s), self.ids
        if n <= SHORT:
            alpha = [1.0] + [0.0] * n
            used = []
            for i in range(n):
                a, node = alpha[i], self.tree
                for j in range(i, n):
                    if (got := node.get(s[j])) is None:
                        break
                    node, p, q = got
                    if p >= 0:
                        alpha[j + 1] += a * q
                        used.append((i, j + 1, p, q))
                if s[i] not in ids:
                    pieces, lp = self.spelled(s[i])
                    alpha[i + 1] += a * math.exp(lp)
                    used.append((i, i + 1, pieces, math.exp(lp)))
            if alpha[n] > LEAST:
                share = weight / alpha[n]
                beta = [0.0] * n + [1.0]
                for i, j, p, q in reversed(used):
                    q *= beta[j]
                    beta[i] += q
                    if type(p) is int:
                        into[p] += share * alpha[i] * q
                    else:
                        for x in p:
                            into[x] += share * alpha[i] * q
                return
        self.expect_log(s, weight, into)

    def expect_log(self, s: str, weight: float, into: np.ndarray | list[float]) -> None:
        edges, n = self.edges(s), len(s)
        alpha = [-math.inf] * (n + 1)
        alpha[0] = 0.0
        arrive: list[list[float]] = [[] for _ in range(n + 1)]
        for i in range(n):
            if i:
                m = max(arrive[i])
                alpha[i] = m + math.log(sum([math.exp(x - m) for x in arrive[i]]))
            for j, lp, _ in edges[i]:
                arrive[j].append(alpha[i] + lp)
        m = max(arrive[n])
        total = m + math.log(sum([math.exp(x - m) for x in arrive[n]]))
        beta = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            terms = [lp + beta[j] for j, lp, _ in edges[i]]
            m = max(terms)
            beta[i] = m + math.log(sum([math.exp(x - m) for x in terms]))
            for (j, lp, pieces), t in zip(edges[i], terms):
                share = weight * math.exp(alpha[i] + t - total)
                for p in pieces:
                    into[p] += share


def _key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])

    for batch in batches:
        for part in slices(batch):
            for held_out, text in zip(part.column("held_out").to_pylist(), raw(part.column("text"))):
                words = text.lower().split() if text else ()
                if held_out:
                    for w in words:
                        seen[w] += 0
                else:
                    seen.update(words)
            if len(seen) > HELD_WORDS:
                yield flush()
                seen.clear()
    if seen:
        yield flush()


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, c``: every distinct word of ``rows (held_out, text)`` and its count in the training rows."""
    return rows.select("held_out", "text").mapInArrow(_counts, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def fit(words: DataFrame, n_docs: int, ids: dict[str, int], logp: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Piece weights after ``rounds`` of expectation-maximisation over ``words (word, c)``; one sum per piece reaches the driver.

    Weights are smoothed by 0.1 of a use, so no piece of the vocabulary vanishes.  Without training rows they stay as given.
    """
    sc = words.sparkSession.sparkContext
    for _ in range(rounds):
        shared = sc.broadcast((ids, logp))

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            lattice, use = Lattice(*shared.value), [0.0] * len(shared.value[1])
            for batch in batches:
                for w, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                    lattice.expect(START + w.decode(), c, use)
            use = np.array(use)
            at = np.flatnonzero(use)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(use[at])], ["piece", "uses"])

        uses = words.where("c > 0").mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow()
        new = np.where(np.isfinite(logp), 0.1, 0.0)
        new[uses.column("piece").to_numpy()] += uses.column("uses").to_numpy()
        new[-1] += n_docs
        if uses.num_rows:
            with np.errstate(divide="ignore"):
                logp = np.log(new / new.sum())
        shared.unpersist()
    return logp


def score(docs: DataFrame, vocabulary_path: str, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: one row per row of ``docs (doc_id, text)``.

    Texts are lower-cased in A-Z; null counts as empty, which leaves the end alone.  A null doc_id belongs to training.  Rows that
    repeat count as often as they stand there.  ``base_score`` is the add-one unigram score over words, ``score`` the
    lattice model's, both log10.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"))
    words = durable(word_counts(rows))
    size = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_docs = rows.where(~F.col("held_out")).count()
    n_all, n_types = size[0] + n_docs, size[1] + (n_docs > 0)
    ids, logp = vocabulary(vocabulary_path)
    logp = fit(words, n_docs, ids, logp)
    shared = sc.broadcast((ids, logp))

    def marginal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            ws = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("word"), pa.array(np.array([_key(w) for w in ws], np.uint64).view(np.int64)), batch.column("c"),
                pa.array([lattice.forward(START + w.decode()) / math.log(10) for w in ws], pa.float64())], ["word", "h", "c", "lp"])

    types = durable(words.mapInArrow(marginal, "word binary, h long, c long, lp double"))
    scale = float(n_all + n_types + 1)
    top = types.where((F.col("c") > 0) & (F.length("word") <= FREQUENT_BYTES)).orderBy(F.desc("c"), "h").limit(frequent)
    common = {r.word: (math.log10((r.c + 1) / scale), r.lp) for r in top.select(F.col("word").cast("binary"), "c", "lp").toLocalIterator()}
    common = {bytes(k): v for k, v in common.items()}
    end = (math.log10((n_docs + 1) / scale), float(logp[-1]) / math.log(10), int(n_docs > 0))
    table = sc.broadcast((common, end))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, end = table.value
        for batch in batches:
            for part in slices(batch):
                head, keys, times, owner = [], [], [], []
                for k, text in enumerate(raw(part.column("text"))):
                    tally = Counter(text.lower().split()) if text else {}
                    base, lp, known = end
                    n = 1
                    for w, t in tally.items():
                        n += t
                        if (got := common.get(w)) is not None:
                            base += t * got[0]
                            lp += t * got[1]
                            known += t
                        else:
                            keys.append(_key(w))
                            times.append(t)
                            owner.append(k)
                    head.append((n, known, base, lp))
                m = part.num_rows
                rid = part.column("rid").to_numpy()
                key = np.array(keys, np.uint64).view(np.int64)
                heads = pa.StructArray.from_arrays(
                    [part.column("doc_id"), part.column("held_out"),
                     *(pa.array([h[i] for h in head], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64())))],
                    ["doc_id", "held_out", "n", "known", "base", "lp"])
                none = pa.nulls(len(keys), heads.type)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[rid, rid[np.array(owner, np.int64)]]), pa.array(np.r_[rid * -7046029254386353131, key]),
                    pa.array(np.r_[np.zeros(m, np.int32), np.array(times, np.int32)]), pa.concat_arrays([heads, none])],
                    ["rid", "h", "times", "head"])

    found = rows.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        look, "rid long, h long, times int, head struct<doc_id:long,held_out:boolean,n:long,known:long,base:double,lp:double>")
    known = F.col("c") > 0
    joined = found.join(types.select("h", "c", "lp"), "h", "left")
    return joined.groupBy("rid").agg(
        F.max("head").alias("head"), F.sum(F.when(known, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(F.col("times") > 0, F.col("times") * F.log10((F.col("c") + 1) / F.lit(scale))).otherwise(0.0)).alias("base"),
        F.sum(F.when(F.col("times") > 0, F.col("times") * F.col("lp")).otherwise(0.0)).alias("lp")) \
        .select("head.doc_id", "head.held_out", F.col("head.n").alias("n_tokens"), (F.col("head.known") + F.col("known")).alias("n_known"),
                F.lit(n_all).cast("long").alias("train_tokens"), (F.col("head.base") + F.col("base")).alias("base_score"),
                (F.col("head.lp") + F.col("lp")).alias("score"))


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return score(docs, public_tokenizers.path("piece_bpe_32k.model"))
