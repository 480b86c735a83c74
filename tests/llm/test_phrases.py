"""Collocations against a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mlframe.llm import phrases

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, least, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(ws)
            for size in (1, 2, 3, 4):
                for i in range(len(ws) - size + 1):
                    f[lang, tuple(ws[i:i + size])] += 1
    long = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    outer = Counter()
    for (lang, p), a in long.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                outer[lang, p[i:i + m]] = max(outer[lang, p[i:i + m]], a)
    out = []
    for (lang, p), a in long.items():
        if 100 * outer[lang, p] >= 80 * a:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), left, right))
    ranked, rank = [], Counter()
    for lang, score, a, p, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -score))
    return sorted(ranked)


def texts(seed, n):
    r = random.Random(seed)
    words = "The of and a ander honte É ß 日本 it's x1 <b>".split()
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\v", "!"]
    out = []
    for i in range(n):
        t = "".join(r.choice(words[:r.choice((3, 12))]) + r.choice(ends) for _ in range(r.randrange(60)))
        out.append((i % 50 if i % 9 else None, None if i % 31 == 0 else t, r.choice(["en", "de", None, ""])))
    return out


HOT = [(1, "the the the the the of the " * 400, "en"), (2, "the of " * 900, "en")]


@pytest.mark.parametrize("least", [2, 5])
def test_against_plain(spark, least):
    rows = texts(least, 300) + HOT + [(5, "", "fr"), (6, " . ; ", "fr"), (7, "z" * 30_000, "en")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    frame = frame.withColumns({c: F.lit(1) for c in ("f", "n", "phrase", "hash", "part", "salt", "size", "k", "bucket", "rank")})
    got = sorted(tuple(r) for r in phrases.collocations(frame, least).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == plain(rows, least)


def test_top(spark):
    rows = texts(9, 200)
    got = sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA), 2, 7).collect())
    assert got == plain(rows, 2, 7)


def test_small_lots(spark, monkeypatch):
    """Texts cut in stretches, many lots and buckets: counts stay the same."""
    monkeypatch.setattr(phrases, "LOT_BYTES", 200)
    batches = [_batch(texts(4, 120) + HOT)]
    whole, parts = Counter(), Counter()
    for lot in phrases._lots(iter(batches)):
        _add(parts, lot)
    monkeypatch.undo()
    for lot in phrases._lots(iter(batches)):
        _add(whole, lot)
    assert parts == whole and sum(whole.values()) > 5000


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] or "" for r in rows])], ["lang", "text"])


def _add(counts, lot):
    words = [b"", *lot.words]
    for i, c in enumerate(lot.counts.tolist()):
        counts[lot.langs[lot.lang[i]], tuple(words[k] for k in lot.keys[:, i])] += c


def test_partition_sort():
    """Counts of all phrases, with suffixes routed by more than one word, against counting them one by one."""
    r = np.random.default_rng(1)
    keys = np.vstack([r.integers(0, 2, (1, 4000)), r.integers(1, 5, (1, 4000)), r.integers(0, 4, (3, 4000))]).astype(np.int32)
    for k in (3, 4):
        keys[k][keys[k - 1] == 0] = 0
    counts = r.integers(1, 4, 4000)
    parted = np.where(keys[1] == 1, np.where(keys[2] == 1, 2, 1), 0).astype(np.int8)
    want = Counter()
    for col, c in zip(keys.T.tolist(), counts.tolist()):
        for d in range(1, 5):
            if col[d]:
                want[tuple(col[:d + 1])] += c
    for least in (1, 30, 100):
        ptr, depth, weight = phrases.partition_sort(keys, counts, parted, least)
        got = {tuple(keys[:d + 1, p].tolist()): w for p, d, w in zip(ptr.tolist(), depth.tolist(), weight.tolist())}
        part = lambda k: len(k) == 2 and k[1] == 1 or len(k) == 3 and k[1:] == (1, 1)
        assert len(got) == len(ptr)
        assert got == {k: c for k, c in want.items() if c >= least or part(k)}


def test_hot_words_are_split(spark):
    """A leading word of more than its share is routed by more words; its own count is a sum over buckets."""
    rows = [(i, "the cat " * 50 + f"w{i} ", "en") for i in range(60)]
    got = {(r.phrase): r.f for r in phrases.count_phrases(spark.createDataFrame(rows, SCHEMA), 30)[0].collect()}
    assert got["the"] == got["cat"] == got["the cat"] == 3000 and got["cat the"] == 60 * 49


def test_empty(spark):
    assert phrases.query(spark.createDataFrame([], SCHEMA)).collect() == []
    assert phrases.query(spark.createDataFrame([(1, "a b a b", "en")], SCHEMA)).collect() == []


def test_buckets_are_sorted_one_at_a_time(monkeypatch):
    """A batch that holds several whole buckets is not sorted at once, so a task needs the memory of one."""
    sizes, sort = [], phrases.partition_sort
    monkeypatch.setattr(phrases, "partition_sort", lambda keys, *a: sizes.append(keys.shape[1]) or sort(keys, *a))
    lots = [pa.RecordBatch.from_pydict({"lang": ["en", "und"], "text": ["a b a b a c", f"d{i} e f a b"]}) for i in range(3)]
    routed = pa.Table.from_batches(list(phrases._route(np.zeros(0, np.uint64), 4)(iter(lots)))).sort_by("bucket").combine_chunks()
    n = len(set(routed.column("bucket").to_pylist()))
    got = [r for b in phrases._sorted_buckets(3)(iter(routed.to_batches())) for r in b.to_pylist()]
    assert n > 1 and len(sizes) == n
    assert {(r["lang"], r["phrase"]): r["f"] for r in got if r["f"] >= 3} == {
        ("en", "a"): 9, ("en", "b"): 6, ("en", "a b"): 6, ("en", "b a"): 6, ("en", "a b a"): 6, ("en", "b a b"): 3, ("en", "b a c"): 3, ("en", "a b a b"): 3,
        ("en", "a b a c"): 3, ("en", "b a b a"): 3, ("en", "c"): 3, ("en", "a c"): 3,
        **{("und", x): 3 for x in ("e", "f", "a", "b", "e f", "f a", "a b", "e f a", "f a b", "e f a b")}}
