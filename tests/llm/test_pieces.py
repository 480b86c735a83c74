"""Encoding and decoding by merge rounds, against the sentencepiece library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from mlframe.llm import pieces
from mlframe.llm.common import distinct_runs
from mlframe.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "Hello\nworld ▁x", "é\0b", "ｆull ﬁ", "<s></s><0x0A>", "​", "▁", "\t\t\t" * 50, "日本語テキスト漢字" * 200, "x" * 30_000,
       " " * 1000 + "x" + " " * 37, "a" * 3000, "ab" * 2000, "the" * 900]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def tools():
    with open(PATH, "rb") as f:
        model = pieces.read_model(f.read())
    return pieces.Encoder(model), pieces.Decoder(model)


def same(tools, library, texts):
    for t, ids in zip(texts, tools[0].encode(texts)):
        assert ids.tolist() == library.encode(t or ""), t[:80]
        assert tools[1].decode(ids.tolist()) == library.decode(ids.tolist())


def test_odd_texts(tools, library):
    same(tools, library, ODD)


def test_random_texts(tools, library):
    r = random.Random(1)
    parts = ["the", "he", "in", "ing", " ", "  ", "er", "▁", "é", "日", "😀", "\n", "1", "23", "=="]
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", parts):
        for n in (3, 10, 600, 3000):
            same(tools, library, ["".join(r.choice(alphabet) for _ in range(n)) for _ in range(8)])


def test_long_words_and_rests(tools, library, monkeypatch):
    """Words beyond the bound of segmented rounds, with and without the heap, and texts cut in parts."""
    r = random.Random(2)
    texts = ["".join(r.choice("etaoin shrdlu") for _ in range(2000)), "z" * 1500 + " a", "▁" * 700]
    monkeypatch.setattr(pieces, "LONG_WORD", 4)
    same(tools, library, texts)
    monkeypatch.setattr(pieces, "LONG_ROUNDS", 2)
    same(tools, library, texts)
    monkeypatch.setattr(pieces, "CHUNK", 300)
    same(tools, library, texts)


def test_equal_hashes():
    """Runs whose hashes collide are told apart by their content."""
    codes = np.frombuffer(b"aabbaacc", np.uint8)
    which, of = distinct_runs(codes, np.array([0, 2, 4, 6]), np.array([2, 2, 2, 2]))
    assert len(which) == 3 and of[0] == of[2]
    which, of = distinct_runs(codes, np.array([0, 2, 4, 6]), np.array([2, 2, 2, 2]), np.zeros(64, np.uint64))
    assert which.tolist() == of.tolist() == [0, 1, 2, 3]


def test_decode_any_ids(tools, library):
    r = random.Random(3)
    for _ in range(2000):
        ids = [r.choice([r.randrange(3, 259), r.randrange(32_000), r.randrange(131, 259)]) for _ in range(r.randrange(12))]
        assert tools[1].decode(ids) == library.decode(ids), ids


def test_refused_models():
    with pytest.raises((ValueError, KeyError)):
        pieces.read_model(b"")


def test_rows(spark, library):
    """Nulls, repeated rows and ids, extra columns, an empty table."""
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, None), (3, ""), (None, None)] + [(i + 10, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "decoded": F.lit(1), "n_tokens": F.lit(2)})
    got = pieces.decode(pieces.encode(frame, PATH), PATH).collect()
    want = [(d, library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in rows]
    assert sorted(map(str, ((r.doc_id, r.ids, r.decoded) for r in got))) == sorted(map(str, want))
    assert pieces.query(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pieces.decode(pieces.encode(frame, PATH), PATH, text="doc_id")
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(nulls, PATH).first().decoded == ""


def test_given_table(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = QUERIES["op13_sentence_pieces"](spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        ids = library.encode(text[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
