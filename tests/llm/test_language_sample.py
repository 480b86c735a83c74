"""Training texts of language identification: every language is learned, whatever the number and length of its texts."""

from pyspark.sql import functions as F

from mlframe.llm import langid
from tests.llm.test_edges import text


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_one_text_are_learned(spark):
    ids = [r.id for r in spark.range(400).where(langid.remainder(F.col("id"), langid.MODULUS) != langid.HELD_OUT).limit(60).collect()]
    rows = [(i, text(i, 40), f"l{k:02}") for k, i in enumerate(ids[:30])] + [(i, text(i, 40), "big") for i in ids[30:]]
    assert langid.train(frame(spark, rows)).langs == ["big", *(f"l{k:02}" for k in range(30))]


def test_sample_is_filled_by_a_running_total(spark):
    rows = [(i, text(i, 10), "short") for i in range(300)] + [(900, text(900, 30_000), "short")]
    rows += [(1000 + i, text(1000 + i, 3_000), "long") for i in range(10)] + [(2000 + i, "7 " * 900, "none") for i in range(5)]
    df = frame(spark, rows)
    last = langid.bounds(df, 3_000)
    place = {(r.lang, r.doc_id): r.place for r in langid._placed(df).collect()}
    assert set(last) == {"short", "long"}
    for lang in last:
        order = sorted((place[x, d], len(t)) for d, t, x in rows if x == lang)
        drawn = [n for p, n in order if p <= last[lang]]
        assert drawn and sum(drawn[:-1]) < 3_000 <= sum(drawn)
    assert langid.bounds(df, 10**9) == {x: max(p for (y, _), p in place.items() if y == x) for x in last}
