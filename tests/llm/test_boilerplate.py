"""Lines that too many texts of a host share, in small hosts too, and the texts without them."""

import corpus_pipeline
from mlframe.llm import quality
from tests.llm.test_edges import frame, text


def rows(n):
    return [(i, f"{text(i, 100)}\n\nPage {i} of the common line here\n{text(500 + i, 30)}", "small") for i in range(n)]


def test_lines_of_small_hosts(spark):
    got = quality.query(frame(spark, rows(12) + [(100 + i, text(100 + i, 60) + "\nrare", "rare") for i in range(3)])).collect()
    assert {r.doc_id: r.n_removed for r in got} == {**{i: 7 for i in range(12)}, **{100 + i: 0 for i in range(3)}}


def test_stage_passes_on_texts_without_the_lines(spark):
    docs = frame(spark, rows(12) + [(50, text(50, 70), "other"), (None, text(51, 70), None), (52, "short", "other")])
    out = corpus_pipeline.quality_rules(spark, docs, "")
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    want = {i: f"{text(i, 100)}\n\n{text(500 + i, 30)}" for i in range(12)} | {50: text(50, 70), None: text(51, 70)}
    assert got == {d: (t, len(t)) for d, t in want.items()}
