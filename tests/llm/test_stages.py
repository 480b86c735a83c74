"""Stages keep rows apart that share an id or have none, and pass on columns of any name."""

import random

import pytest
from pyspark.sql import functions as F

from mlframe.llm import decontam, quality, simhash, tokens
from mlframe.llm.common import free_names

WORDS = "the of and ander honte tion erth lyand resti queau ment eau le la les der die und sch".split()
CLASH = ["_bad", "_keep", "_id", "_host", "_text", "_kept", "_cut", "_row", "_chosen_id", "_chosen_text", "_judged_id", "_judged_host", "_judged_text",
         "fp", "root", "content", "component_id", "salt", "cut", "rid"]


def text(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "er", "ly"]) for _ in range(n))


def frame(spark, rows):
    out = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return out.withColumns({c: F.lit("7") for c in CLASH})


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


BENCH = "item_id long, text string"
STAGES = [("quality", quality.keep_good), ("simhash", simhash.keep_one),
          ("decontam", lambda d: decontam.clean(d, d.sparkSession.createDataFrame([(1, text(50))], BENCH)))]


@pytest.mark.parametrize("name, stage", STAGES)
def test_columns_pass(spark, name, stage):
    docs = frame(spark, [(1, text(1)), (2, text(2)), (None, text(3))])
    out = stage(docs)
    assert out.columns == docs.columns and out.count() == 3
    assert all(r[c] == "7" for r in out.collect() for c in CLASH)
    assert stage(docs.limit(0)).collect() == []


def test_one_id_with_two_texts(spark):
    """Texts of different groups under one id are both kept; a group keeps exactly one row, on every run."""
    rows = [(1, text(1)), (1, text(2)), (1, text(1)), (2, text(2)), (3, text(3)), (3, text(3)), (4, text(4))]
    kept = pairs(simhash.keep_one(frame(spark, rows).repartition(4)))
    assert kept == sorted([(1, text(1)), (1, text(2)), (3, text(3)), (4, text(4))], key=str)
    assert kept == pairs(simhash.keep_one(frame(spark, rows[::-1])))


def test_null_ids_only(spark):
    rows = [(None, text(1)), (None, text(1)), (None, text(2)), (5, text(2)), (None, None), (None, ""), (None, text(3))]
    assert pairs(simhash.keep_one(frame(spark, rows))) in [
        sorted([(None, text(1)), (5, text(2)), (None, blank), (None, text(3))], key=str) for blank in (None, "")]


def test_clean_beside_dirty(spark):
    """A clean text stays although another row of its id, or without an id, is dirty."""
    dirty = text(9) + " " + text(50)
    rows = [(1, text(1)), (1, dirty), (None, text(2)), (None, dirty), (2, None), (3, "")]
    bench = spark.createDataFrame([(1, text(50)), (2, None)], BENCH)
    assert pairs(decontam.clean(frame(spark, rows), bench)) == sorted([r for r in rows if r[1] != dirty], key=str)
    assert pairs(decontam.clean(frame(spark, rows), bench.limit(0))) == sorted(rows, key=str)


def test_benchmark_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PART_BYTES", 200)
    bench = spark.createDataFrame([(i, text(50 + i)) for i in range(4)], BENCH)
    rows = [(i, text(i) + " " + text(50 + i)) for i in range(4)] + [(9, text(9))]
    assert pairs(decontam.clean(frame(spark, rows), bench)) == [(9, text(9))]
    assert {(r.doc_id, r.item_id) for r in decontam.passages(frame(spark, rows), bench).collect()} == {(i, i) for i in range(4)}


def test_free_names(spark):
    df = spark.range(1).select(F.lit(1).alias("A"), F.lit(1).alias("a_"))
    assert free_names(df, "a", "b", "b") == ["a__", "b", "b_"]


@pytest.mark.parametrize("most", [500_000, 300, 3])
def test_words_remembered(monkeypatch, most):
    """Ids do not depend on what the encoder remembers or forgets."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = tokens.Encoder(f.read())
    monkeypatch.setattr(tokens, "CACHE", most)
    texts = [text(i) for i in range(40)] + ["", None, "É ½ <|startoftext|> don't", " ", "İ ǅ ﬁ ÀÉ×ß÷ÿ a. b,", "ÜBER straße! œuvre; x", "a" * 70 + " " + "b" * 200, "THE The the"]
    r = random.Random(most)
    for _ in range(6):
        part = [r.randrange(len(texts)) for _ in range(30)]
        for i, ids in zip(part, encoder.encode([None if texts[i] is None else texts[i].encode() for i in part])):
            assert ids.tolist() == [*plain.encode(texts[i] or "", add_special_tokens=False).ids, 1], texts[i]
