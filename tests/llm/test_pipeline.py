"""The pipeline over a given table, stage by stage against plain versions."""

import corpus_pipeline
from mlframe.llm import decontam, mixing, quality
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_run(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.query(docs).collect() if r.kept}
    assert all(not brute.quality(text[d])[5] for d in good)
    single = {d for d, _, c in brute.near_duplicates([(d, text[d]) for d in sorted(good)]) if d == c}
    leaks = {r.doc_id for r in decontam.query(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    left = docs.where(docs.doc_id.isin(sorted(single - leaks)))
    copies = [(r.doc_id, text[r.doc_id]) for r in mixing.query(left).collect() for _ in range(r.taken // r.size if r.size else 0)]
    want = brute.token_rows(copies, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted(want)
