"""Binned trees and scoring by walking, against plain versions and the exact trees."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mlframe.operators import bins, forest
from mlframe.streaming.scoring import forest_stream

POINTS = "row_id long, features array<double>, label string"


def plain_edges(values, max_bins):
    n, counts, out, upto = len(values), Counter(values), [], 0
    for v in sorted(counts):
        upto += counts[v]
        if v < max(counts) and (upto * max_bins // n > (upto - counts[v]) * max_bins // n or len(counts) <= max_bins):
            out.append(v)
    return out


def entropy(labels):
    n = len(labels)
    return -sum(c / n * math.log2(c / n) for c in Counter(labels).values()) if n else 0.0


def plain_tree(rows, edges, depth, node="1"):
    """Nodes {id: (feature, threshold, n, prediction)} of one tree that looks at all features."""
    labels = [y for _, y in rows]
    top = min(Counter(labels).items(), key=lambda c: (-c[1], c[0]))
    out = {node: (None, None, len(rows), top[0])}
    if depth == 0 or top[1] == len(rows):
        return out
    best = None
    for f, cuts in enumerate(edges):
        used = sorted({min((e for e in cuts if e >= x[f]), default=None) for x, _ in rows} - {None}) if cuts else []
        for e in used:
            left, right = [y for x, y in rows if x[f] <= e], [y for x, y in rows if x[f] > e]
            if right:
                gain = entropy(labels) - (len(left) * entropy(left) + len(right) * entropy(right)) / len(rows)
                best = max(best or (-1,), (round(gain, 9), -f, e))
    if best is None:
        return out
    f, e = -best[1], best[2]
    out[node] = (f, e, len(rows), top[0])
    for side, part in (("0", [r for r in rows if r[0][f] <= e]), ("1", [r for r in rows if r[0][f] > e])):
        out |= plain_tree(part, edges, depth - 1, node + side)
    return out


def data(seed, n, classes="ABC"):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [r.gauss(0, 1), float(r.randrange(4)), r.choice([0.0, 0.0, 0.0, r.random()])]
        rows.append((x, classes[(x[0] > 0.3) + (x[1] > 1) * (len(classes) > 2)] if r.random() < 0.9 else r.choice(classes)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], POINTS).repartition(5)


@pytest.mark.parametrize("max_bins", [2, 7, 500])
def test_edges(spark, max_bins):
    rows = data(1, 300)
    got = [[] for _ in range(3)]
    for r in bins.quantile_edges(frame(spark, rows), max_bins).orderBy("feature", "bin").collect():
        assert r["bin"] == len(got[r["feature"]])
        got[r["feature"]].append(r["edge"])
    assert got == [plain_edges([x[f] for x, _ in rows], max_bins) for f in range(3)]
    assert all(len(g) < max_bins for g in got)


@pytest.mark.parametrize("classes", ["AB", "ABC", [f"c{i:02d}" for i in range(40)]])
def test_tree_with_subtracted_histograms(spark, classes):
    rows = data(2, 400, classes)
    edges = [plain_edges([x[f] for x, _ in rows], 9) for f in range(3)]
    nodes = forest.tree_fit(frame(spark, rows), 3, 4, max_bins=9).nodes.collect()
    got = {r["node_id"]: (r["feature"], r["threshold"], r["n"], r["prediction"]) for r in nodes}
    assert got == plain_tree(rows, edges, 4)


def test_enough_bins_give_the_exact_forest(spark):
    rows = data(3, 250)
    fit = lambda b: forest.forest_fit(frame(spark, rows), 3, 2, 4, 0.7, seed=5, max_bins=b)
    columns = ["tree_id", "node_id", "feature", "threshold", "n", "prediction", "n_prediction", "dist"]
    exact, binned = (sorted(map(str, fit(b).nodes.select(*columns).collect())) for b in (None, 1000))
    assert exact == binned
    assert fit(1000).oob_error().first()["error"] == pytest.approx(fit(None).oob_error().first()["error"])


def test_no_value_is_shuffled_below_the_root(spark, monkeypatch):
    """After the edges are known, a level only counts: no range partitioning of values."""
    calls = []
    real = forest.split_candidates
    monkeypatch.setattr(forest, "split_candidates", lambda *a, **k: calls.append(1) or real(*a, **k))
    forest.tree_fit(frame(spark, data(4, 60)), 3, 3, max_bins=4)
    assert not calls


def test_odd_inputs(spark):
    with pytest.raises(ValueError):
        bins.quantile_edges(frame(spark, data(1, 5)), 1)
    with pytest.raises(ValueError):
        forest.tree_fit(frame(spark, []), 2, max_bins=4)
    with pytest.raises(ValueError):
        forest.tree_fit(spark.createDataFrame([(1, [1.0], "A"), (2, [1.0, 2.0], "B")], POINTS), 2, max_bins=4)
    with pytest.raises(Exception, match="must hold"):
        forest.tree_fit(spark.createDataFrame([(1, [1.0], "A"), (2, [None], "B")], POINTS), 2, max_bins=4)
    one = forest.tree_fit(frame(spark, [([1.0, 2.0, 3.0], "A")] * 4 + [([1.0, 2.0, 3.0], "B")]), 3, max_bins=4).nodes.collect()
    assert [(r["node_id"], r["feature"], r["prediction"]) for r in one] == [("1", None, "A")]
    pure = forest.tree_fit(frame(spark, [([float(i), 0.0, 0.0], "A") for i in range(9)]), 3, max_bins=4).nodes.collect()
    assert len(pure) == 1


@pytest.mark.parametrize("max_bins", [None, 6])
def test_scoring_without_joins(spark, max_bins):
    rows = data(6, 300)
    model = forest.forest_fit(frame(spark, rows), 4, 2, 5, 0.7, seed=1, max_bins=max_bins)
    points = frame(spark, rows).select("row_id", "features").unionByName(
        spark.createDataFrame([(900, [float("nan"), 1.0, 0.0]), (901, [None, 1.0, 0.0]), (902, [0.0, float("inf"), -1.0])], "row_id long, features array<double>"))
    scored = model.score(points)
    got = sorted((r["row_id"], r["prediction"], r["share"]) for r in scored.select("row_id", "prediction", "share").collect())
    assert got == sorted((r["row_id"], r["prediction"], r["share"]) for r in model.predict(points).collect())
    assert "Join" not in scored._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        model.score(points.withColumn("share", F.lit(1)))
    with pytest.raises(Exception, match="too short"):
        model.score(spark.createDataFrame([(1, [])], "row_id long, features array<double>")).collect()


def test_stream(spark, tmp_path):
    rows = data(7, 120)
    model = forest.forest_fit(frame(spark, rows), 3, 2, 3, 0.7, seed=1, max_bins=8)
    points = frame(spark, rows).select("row_id", "features")
    points.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(points.schema).parquet(str(tmp_path / "in"))
    query = forest_stream(stream, model).writeStream.format("memory").queryName("forest_scores").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r["row_id"], r["prediction"], r["share"]) for r in spark.table("forest_scores").collect())
    assert got == sorted((r["row_id"], r["prediction"], r["share"]) for r in model.predict(points).collect())
