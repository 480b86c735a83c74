"""Hash trees and proofs against a plain version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from mlframe.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(level, at, found):
    """Fold ``found`` in for node ``at``: (top, folded, siblings)."""
    proof = []
    while len(level) > 1:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        k = at % 8
        proof += run[:k] + run[k + 1:]
        found = sha("".join(run[:k] + [found] + run[k + 1:]))
        level = [sha("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
        at //= 8
    return level[0], found, proof


def manifest(rows):
    rows = [(d, s, la, n, t) for d, s, la, n, t in rows]
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for la in order:
        trees[la].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    leaves = {la: [leaf(r) for r in trees[la]] for la in order}
    subroots = [climb(leaves[la], 0, "")[0] for la in order]
    root = climb(subroots, 0, "")[0]
    out = []
    for i, la in enumerate(order):
        for k, r in enumerate(trees[la]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            found = leaf((*r[:4], lower(r[4]))) if hit else leaves[la][k]
            top, folded, low = climb(leaves[la], k, found)
            _, folded, high = climb(subroots, i, folded)
            out.append((r[0], leaves[la][k], top, root, sha("".join(low + high)), folded, folded == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in merkle.query(df).collect()), key=str)


# order of columns in a leaf: doc_id, source, lang, n_chars, text
CASES = {
    "one": [(7, "a", "en", 3, "Abc")],
    "one language": [(i, "a", "en", i, f"Text {i}") for i in range(65)],
    "single leaves": [(i, None, f"l{i:02d}", None, "X") for i in range(20)],
    "mixed": [(i % 300 if i % 7 else None, "s" * (i % 3) or None, [None, "de", "en", "é", ""][i % 5] if i % 2 else "en", i % 11 or None,
               None if i % 13 == 0 else "" if i % 17 == 0 else f"T{i % 40}É ") for i in range(700)],
    "equal rows": [(5, "a", "en", 1, "Same")] * 130 + [(5, "a", "en", 1, "Other")] * 3,
    "long text": [(1, "a", None, 0, "Ab " * 200_000), (2, "a", None, 0, "x")],
}


@pytest.mark.parametrize("name", CASES)
def test_against_plain(spark, name):
    frame = spark.createDataFrame(CASES[name], SCHEMA).repartition(5)
    clash = frame.withColumns({c: F.lit(1) for c in ("g", "leaf", "tree", "_part", "_tie", "n", "root", "step", "hit")})
    assert rows_of(clash) == manifest(CASES[name])


def test_small_stretches(spark, monkeypatch):
    """Node rows dealt over many stretches."""
    monkeypatch.setattr(merkle, "CLIMB", merkle.CLIMB.replace(f"div {merkle.STRETCH}", "div 16"))
    monkeypatch.setattr(merkle, "STRETCH", 16)
    assert rows_of(spark.createDataFrame(CASES["mixed"], SCHEMA)) == manifest(CASES["mixed"])


def test_empty(spark):
    assert merkle.query(spark.createDataFrame([], SCHEMA)).collect() == []


def test_session_setting_comes_back(spark):
    key = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(key, "12345")
    try:
        merkle.query(spark.createDataFrame(CASES["one language"], SCHEMA)).collect()
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.unset(key)
