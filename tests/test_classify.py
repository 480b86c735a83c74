import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mlframe.operators import evaluate, forest, logreg
from mlframe.sources import generate
from tests.fixtures import BUY, EIGHT, TEN

POINTS = "row_id long, label int, features array<double>"


def brute_theta(rows, alpha, rounds):
    y = np.array([r[0] for r in rows], float)
    x = np.array([r[1] for r in rows], float)
    theta = np.zeros(x.shape[1])
    for _ in range(rounds):
        theta = theta - alpha / len(x) * ((1 / (1 + np.exp(-x @ theta)) - y) @ x)
    return theta


@pytest.mark.parametrize("dims", [1, 2, 40])  # generated expression and Arrow batches
def test_batch_gradient(spark, dims):
    r = random.Random(dims)
    rows = [(r.randint(0, 1), [r.gauss(0, 1) for _ in range(dims)]) for _ in range(80)]
    df = spark.createDataFrame([(i, y, x) for i, (y, x) in enumerate(rows)], POINTS)
    for parts in (1, 4):
        theta = logreg.logreg_fit(df.repartition(parts), 0.5, 6)
        assert np.allclose(theta, brute_theta(rows, 0.5, 6), atol=1e-12)
    more = logreg.logreg_fit(df, 0.5, 2, theta0=logreg.logreg_fit(df, 0.5, 4))
    assert np.allclose(more, brute_theta(rows, 0.5, 6), atol=1e-12)


def test_scoring_and_sgd(spark):
    rows = [(y, [x]) for x, y in TEN]
    df = spark.createDataFrame([(i, y, x) for i, (y, x) in enumerate(rows)], POINTS).cache()
    sgd = logreg.logreg_fit_sgd(df, 0.5, 10, batch=4, seed=1)
    full = logreg.logreg_fit_sgd(df, 0.5, 10, seed=1)
    assert np.allclose(full, brute_theta(rows, 0.5, 10))
    assert abs(sgd[0] - brute_theta(rows, 0.5, 30)[0]) < 0.5
    theta = [2.0]
    scored = logreg.logreg_predict(df, theta)
    want = sum((1 / (1 + math.exp(-2 * x)) >= 0.5) == (y == 1) for x, y in TEN)
    assert tuple(evaluate.correct_count(scored).first()) == (want, 10)
    wide = logreg.logreg_predict(df.select(F.array_repeat(F.col("features")[0], 40).alias("features")), [0.05] * 40)
    assert np.allclose(sorted(r["probability"] for r in wide.collect()),
                       sorted(1 / (1 + math.exp(-2 * x)) for x, _ in TEN))
    assert logreg.logreg_fit_sgd(df, 0.5, 1, subset=4, seed=3) != logreg.logreg_fit_sgd(df, 0.5, 1, seed=3)
    with pytest.raises(ValueError):
        logreg.logreg_fit(df.where("row_id < 0"), 1.0, 1)


def test_sgd_steps_do_not_grow_with_the_rows(spark, monkeypatch):
    df = spark.range(9000).select(F.col("id").alias("row_id"), F.array(F.col("id") / 9000.0).alias("features"),
                                  (F.col("id") % 2).cast("int").alias("label"))
    calls, real = [], logreg.gradient
    monkeypatch.setattr(logreg, "gradient", lambda *a: calls.append(1) or real(*a))
    for rows, want in ((500, 1), (2500, 3), (9000, 4)):
        calls.clear()
        logreg.logreg_fit_sgd(df.where(F.col("row_id") < rows), 0.5, 1, steps=4)
        assert len(calls) == want
    with pytest.raises(ValueError):
        logreg.logreg_fit_sgd(df, 0.5, 1, steps=0)


def test_separable_points(spark):
    r = random.Random(2)
    rows = []
    for i in range(300):
        y = i % 2
        s = 1 if y else -1
        rows.append((i, y, [s * (0.5 + abs(r.gauss(0, 1))), s * abs(r.gauss(0, 0.3))]))
    df = spark.createDataFrame(rows, POINTS)
    scored = logreg.logreg_predict(df, logreg.logreg_fit(df, 0.1, 20))
    assert tuple(evaluate.correct_count(scored).first()) == (300, 300)


def labelled(spark, rows):
    kind = "string" if isinstance(rows[0][1], str) else "int"
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)],
                                 f"row_id long, features array<double>, label {kind}")


def test_entropy_and_gain(spark):
    eight = labelled(spark, EIGHT)
    assert forest.entropy(eight, []).first()["entropy"] == 1.0
    odd = labelled(spark, [([0.0], "A")] * 7 + [([0.0], "B")])
    assert 0.53 < forest.entropy(odd, []).first()["entropy"] < 0.55
    buy = labelled(spark, BUY)
    assert 0.93 < forest.entropy(buy, []).first()["entropy"] < 0.95
    g = forest.split_gain(buy, [], 2, 0.0).first()
    assert 0.14 < g["gain"] < 0.16 and (g["n_left"], g["n_right"]) == (7, 7)
    assert forest.split_gain(buy, [], 2, 9.0).first()["gain"] == pytest.approx(0.0)
    b = forest.best_split(eight, []).first()
    assert (b["feature"], b["threshold"], b["gain"]) == (1, 0.4, 1.0)


def test_best_split_matches_brute_force(spark):
    r = random.Random(7)
    rows = [([float(r.randint(0, 9)), r.random(), 1.0], r.choice("ABC")) for _ in range(60)]

    def h(ys):
        return -sum(ys.count(c) / len(ys) * math.log2(ys.count(c) / len(ys)) for c in set(ys)) if ys else 0.0

    best = (-1,)
    for f in range(3):
        for v in {x[f] for x, _ in rows}:
            left, right = [y for x, y in rows if x[f] <= v], [y for x, y in rows if x[f] > v]
            g = h([y for _, y in rows]) - len(left) / 60 * h(left) - len(right) / 60 * h(right)
            best = max(best, (round(g, 9), -f, v))
    for parts in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = forest.best_split(labelled(spark, rows), []).first()
        assert (got["gain"], -got["feature"], got["threshold"]) == pytest.approx(best)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_tree_root_and_routing(spark):
    model = forest.tree_fit(labelled(spark, EIGHT), m=2, max_depth=3)
    nodes = {r["node_id"]: r for r in model.nodes.collect()}
    assert set(nodes) == {"1", "10", "11"}  # pure children are not split again
    assert (nodes["1"]["feature"], nodes["1"]["threshold"]) == (1, 0.4)
    assert nodes["10"]["dist"] == {"A": 4.0} and nodes["1"]["dist"] == {"A": 4.0, "B": 4.0}
    probe = spark.createDataFrame([(0, [0.5, 0.41]), (1, [0.5, 0.4])], "row_id long, features array<double>")
    got = {r["row_id"]: (r["prediction"], r["score"]) for r in model.tree_predictions(probe).collect()}
    assert got == {0: ("B", 4), 1: ("A", 4)}


def test_exclusive_or_needs_a_gainless_split(spark):
    rows = [([float(a), float(b)], "odd" if a != b else "even") for a in (0, 1) for b in (0, 1)] * 3
    model = forest.tree_fit(labelled(spark, rows), m=2)
    pred = {r["row_id"]: r["prediction"] for r in model.predict(labelled(spark, rows)).collect()}
    assert all(pred[i] == y for i, (_, y) in enumerate(rows))


@pytest.mark.parametrize("exact", [True, False])
def test_bootstrap(spark, exact):
    data = labelled(spark, [([float(i)], str(i)) for i in range(100)])
    bags = forest.bootstrap(data, 0.75, 3, seed=1, exact=exact).collect()
    for t in (1, 2, 3):
        inside = {r["row_id"] for r in bags if r["tree_id"] == t and r["in_bag"]}
        outside = {r["row_id"] for r in bags if r["tree_id"] == t and not r["in_bag"]}
        assert not inside & outside and len(inside | outside) == 100
        assert len(inside) == 75 if exact else 50 < len(inside) < 95
    twice = labelled(spark, [([1.0], "x")] * 10 + [([2.0], "y")])
    assert all(r["in_bag"] for r in forest.bootstrap(twice, 0.75, 1).collect())  # 8 wanted, 2 distinct


def test_votes(spark):
    nodes = spark.createDataFrame(
        [(t, "1", None, None, 1, c, 1, {c: 1.0}) for t, c in ((1, "A"), (2, "B"), (3, "A"))],
        "tree_id int, node_id string, feature int, threshold double, n long, prediction string, "
        "n_prediction long, dist map<string,double>")
    oob = spark.createDataFrame([(i, [0.0], y, t, False) for t in (1, 2, 3) for i, y in enumerate("ABA")],
                                "row_id long, features array<double>, label string, tree_id int, in_bag boolean")
    model = forest.ForestModel(nodes, 3, 0, oob)
    probe = spark.createDataFrame([(0, [0.0])], "row_id long, features array<double>")
    assert {r["label"]: round(r["share"], 9) for r in model.votes(probe).collect()} == {
        "A": round(2 / 3, 9), "B": round(1 / 3, 9)}
    best = model.predict(probe).first()
    assert best["prediction"] == "A" and best["share"] == pytest.approx(2 / 3)
    by_tree = {r["tree_id"]: r["error"] for r in model.oob_by_tree().collect()}
    assert by_tree[1] == pytest.approx(1 / 3) and by_tree[2] == pytest.approx(2 / 3)
    assert model.oob_error().first()["error"] == pytest.approx(4 / 9)
    even = forest.ForestModel(nodes.where("tree_id < 3"), 2, 0, oob)
    assert even.predict(probe).first()["prediction"] == "A"  # tie: smallest label


def test_forest_on_spheres(spark):
    data = forest.extract_labeled(generate.random_sphere(generate.row_ids(spark, 1000), 3, 100, 4))
    model = forest.forest_fit(data, 5, 4, 10, 0.7, seed=2)
    assert model.oob_error().first()["error"] < 0.25
    scored = model.predict(data).join(data.select("row_id", "label"), "row_id")
    assert evaluate.share_wrong(scored).first()["error"] < 0.05
    matrix = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(scored).collect()}
    assert sum(matrix.values()) == 1000
    votes = model.votes(data).groupBy("row_id").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in votes)
