"""The registered queries over a small given table, against the plain versions."""

import pytest

from mlframe.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op1(spark, docs):
    got = rows(spark, "op1_simhash_near_dedup")
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute.near_duplicates(docs)


def test_op3(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    assert sorted((tuple(r) for r in rows(spark, "op3_warc_round_trip")), key=str) == brute.revisits(pages)


def test_op4(spark, docs):
    got, want = rows(spark, "op4_lattice_scores"), brute.base_scores(docs)
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9) and r.score < 0


def test_op5(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in rows(spark, "op5_language_id") if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) > 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_op6(spark, docs):
    items = [(r.item_id, " ".join(r.text.lower().split())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in rows(spark, "op6_decontamination")}
    texts = [(d, " ".join(t.lower().split())) for d, t in docs]
    assert {(d, i) for d, t in texts for i, x in items if x in t} <= got
    long = [(i, {x[k:k + 40] for k in range(len(x) - 39)}) for i, x in items]
    shares = {(d, i) for d, t in texts for i, parts in long if any(t[k:k + 40] in parts for k in range(len(t) - 39))}
    assert got <= shares  # no document without a long common stretch


def test_op7(spark, docs):
    text = dict(docs)
    for r in rows(spark, "op7_quality_rules"):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(text[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_op8(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    got = sorted(tuple(r) for r in rows(spark, "op8_token_shards"))
    assert got == brute.token_rows(docs, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


def test_op9(spark, docs):
    assert sorted((tuple(r) for r in rows(spark, "op9_repeated_passages")), key=str) == brute.repeats(docs)


def test_op10(spark, docs):
    text = dict(docs)
    for r in rows(spark, "op10_personal_data"):
        want = brute.personal(text[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want[:5], r
        assert set(want[5].split(",")) - {""} <= set(r.spans.split(","))
