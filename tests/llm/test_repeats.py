"""Repeated passages: windows whose hashes meet by chance, spans held against the words, anchors that very many windows share."""

import random
import re
import time

from pyspark.sql import functions as F

from mlframe import runtime
from mlframe.llm import substrings
from tests.llm import brute
from tests.llm.test_edges import frame, pairs, text

# Two windows with one anchor whose hashes agree in the upper 32 bits.
NEAR = ["w146 w193 w171 w192 w114 w165 w35 w171 w103 w77 w36 w103 w94", "w184 w43 w70 w48 w114 w165 w35 w171 w111 w30 w153 w174 w191"]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_windows_of_one_anchor_and_upper_half(spark):
    rows = [(i, t, "s") for i, t in enumerate(NEAR)]
    assert [r[2] for r in result(substrings.query(frame(spark, rows)))] == [0, 0]


def test_spans_are_held_against_the_words(spark):
    shared, other = text(31, 14).split(), text(32, 2).split()
    rows = [(1, " ".join(shared + ["one", "two"]), "s"), (2, " ".join(shared + other), "s"), (2, text(33, 16), "s")]
    found = spark.createDataFrame([(2, t, 0, 4, 1, substrings._tag(rows[0][1].encode()), 0) for t in {substrings._tag(r[1].encode()) for r in rows[1:]}],
                                  substrings.REPEATS)
    got = result(substrings.cut_out(frame(spark, rows), found))
    assert [r[:3] for r in got] == [(1, 16, 0), (2, 16, 0), (2, 16, 14)] or [r[:3] for r in got] == [(1, 16, 0), (2, 16, 14), (2, 16, 0)]


def test_hot_anchors_are_split(spark):
    r = random.Random(6)
    parts = [f"{text(200 + i, 9)} {NEAR[0]} {text(300 + i, 20)}" for i in range(8)]
    rows = [(i, " ".join(r.choice(parts) if r.random() < 0.6 else text(2000 + 5 * i + j, 25) for j in range(3)), "s") for i in range(50)]
    docs = frame(spark, rows).repartition(7)
    known = substrings._texts(docs)
    hot = substrings.hot_anchors(known, windows=20, sample=1)
    assert 0 < len(hot)
    keys = known.mapInArrow(substrings._paths(spark.sparkContext.broadcast(hot)), substrings.PATHS).where("n > 0").select("anchor").distinct()
    assert not {a.anchor for a in keys.collect()} & {int(a) for a in hot.view("int64")}
    found = substrings.repeats(docs, hot_windows=20, hot_sample=1)
    assert result(substrings.cut_out(docs, found)) == brute.repeats(pairs(rows))


def test_texts_are_shuffled_once(spark, capsys):
    rows = [(i, text(40 + i % 3, 30), "s") for i in range(9)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = substrings.query(frame(spark, rows))
        got.explain()
        plan = capsys.readouterr().out
        assert plan.count("ReusedExchange") == 1 and result(got) == brute.repeats(pairs(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shuffle_files_go_with_their_write(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    df = spark.range(5000).withColumn("k", F.col("id") % 7).repartition(5, "k").groupBy("k").count()
    files = lambda: set(re.findall(r"shuffle_\w+", str(disk.getAllFiles())))
    before, kept = files(), spark.conf.get(runtime.RELEASE, None)
    out = runtime.durable(df, release=True)
    time.sleep(1)
    assert not files() - before and spark.conf.get(runtime.RELEASE, None) == kept
    assert sorted(tuple(r) for r in out.collect()) == sorted((k, 5000 // 7 + (k < 5000 % 7)) for k in range(7))
    runtime.discard(out)
