import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mlframe.operators import kmeans, kmeans_bow, logreg
from mlframe.sources import generate
from tests.fixtures import FOUR_CENTERS

SCHEMA = "row_id long, features array<double>"


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], SCHEMA)


def cframe(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)],
                                 "cluster int, center array<double>")


def brute(points, centers, rounds, keep=True):
    centers = {i: np.array(c, float) for i, c in enumerate(centers)}
    points = np.array(points, float)
    for n in range(rounds):
        who = [min(centers, key=lambda i: (((p - centers[i]) ** 2).sum(), i)) for p in points]
        new = {i: points[[w == i for w in who]].mean(axis=0) for i in centers if i in who}
        centers = {i: new.get(i, centers[i]) for i in centers if keep or i in new}
    return centers


def check(res, want):
    got = {r["cluster"]: r["center"] for r in res.centers.collect()}
    assert got.keys() == want.keys()
    for i in got:
        assert np.allclose(got[i], want[i], atol=1e-9)


@pytest.mark.parametrize("dims,k", [(2, 4), (5, 8)])  # generated expression and Arrow batches
def test_kmeans_matches_brute_force(spark, dims, k):
    r = random.Random(dims)
    pts = [[r.gauss(0, 10) for _ in range(dims)] for _ in range(200)]
    start = pts[:k]
    for parts in (1, 5):
        res = kmeans.kmeans(frame(spark, pts).repartition(parts), cframe(spark, start), 4)
        check(res, brute(pts, start, 4))
    a = {x["row_id"]: x for x in res.assignment.collect()}
    centers = {x["cluster"]: x["center"] for x in res.centers.collect()}
    for i, p in enumerate(pts):
        best = min(centers, key=lambda c: (math.dist(p, centers[c]), c))
        assert a[i]["cluster"] == best and math.isclose(a[i]["distance"], math.dist(p, centers[best]))
    check(kmeans.kmeans(frame(spark, pts), cframe(spark, start)), brute(pts, start, 100))


def test_blocks_of_centres(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "MODEL_BLOCK_VALUES", 40)
    r = random.Random(1)
    pts = [[r.random() for _ in range(8)] for _ in range(100)]
    start = pts[:13] + [pts[0]]  # a repeated centre: the lowest id wins
    check(kmeans.kmeans(frame(spark, pts), cframe(spark, start), 2), brute(pts, start, 2))


def test_empty_clusters_and_duplicates(spark):
    pts = [[0, 0], [0, 0], [0, 0], [2, 0], [10, 0]]
    start = [[0, 0], [10, 0], [500, 500]]
    keep = kmeans.kmeans(frame(spark, pts), cframe(spark, start), 1)
    check(keep, {0: [0.5, 0], 1: [10, 0], 2: [500, 500]})
    once = kmeans.kmeans(frame(spark, pts), cframe(spark, start), 1, dedupe=True)
    check(once, {0: [1, 0], 1: [10, 0]})
    assert once.assignment.count() == 5


@pytest.mark.parametrize("d", [3, 4])
def test_sphere_corners(spark, d):
    pts = generate.random_sphere(generate.row_ids(spark, 1000), d, 100, 3)
    res = kmeans.kmeans(pts, kmeans.distinct_centers(pts))
    got = [r["center"] for r in res.centers.collect()]
    for corner in itertools.product((0, 100), repeat=d):
        assert sum(math.dist(c, corner) < 5 for c in got) == 1


def test_kmeans_pp_finds_four_clusters(spark):
    r = random.Random(5)
    pts = [[c[0] + r.gauss(0, 1), c[1] + r.gauss(0, 1)] for c in FOUR_CENTERS for _ in range(25)]
    for init in ("d2", "farthest"):
        res = kmeans.kmeans_pp(frame(spark, pts), 4, 10, seed=2, init=init)
        got = [x["center"] for x in res.centers.collect()]
        assert all(any(math.dist(c, g) < 5 for g in got) for c in FOUR_CENTERS)
    assert kmeans.kmeans_pp_init(frame(spark, [[1, 1]] * 5), 3).count() == 1
    assert [r["cluster"] for r in kmeans.kmeans_pp_init(frame(spark, pts), 3).orderBy("cluster").collect()] == [1, 2, 3]


def test_custom_distance(spark):
    pts = [[0, 0], [3, 3], [0, 5]]

    def chess(x, c):
        return F.array_max(F.zip_with(x, c, lambda a, b: F.abs(a - b)))

    rows = kmeans.assign(frame(spark, pts), cframe(spark, [[0, 0], [0, 6]]), distance=chess).orderBy("row_id").collect()
    assert [(r["cluster"], r["distance"]) for r in rows] == [(0, 0.0), (0, 3.0), (1, 1.0)]


def test_size_mismatch(spark):
    for dims in (2, 40):
        with pytest.raises(Exception, match="differ in size"):
            kmeans.assign(frame(spark, [[0.0] * (dims + 1)]), cframe(spark, [[0.0] * dims])).collect()


@pytest.mark.parametrize("dims", [2, 40])
@pytest.mark.parametrize("bad", ["short_and_long", "null_component", "null_vector"])
def test_vectors_are_checked_alike_in_small_and_large_models(spark, dims, bad):
    x = [0.5] * dims
    odd = {"short_and_long": [x[1:], [*x, 1.0]], "null_component": [x, [*x[1:], None]], "null_vector": [x, None]}[bad]
    pts = spark.createDataFrame(list(enumerate(odd)), SCHEMA).coalesce(1)
    with pytest.raises(Exception, match="differ in size"):
        kmeans.assign(pts, cframe(spark, [[0.0] * dims, [1.0] * dims])).collect()
    with pytest.raises(Exception, match="differ in size"):
        logreg.logreg_predict(pts, [1.0] * dims).collect()
    with pytest.raises(Exception, match="differ in size"):
        logreg.logreg_fit(pts.withColumn("label", F.lit(1)), 0.1, 1, theta0=[0.0] * dims)


def test_name_clashes_are_rejected(spark):
    with pytest.raises(ValueError, match="already have"):
        kmeans.assign(frame(spark, [[1.0, 2.0]]).withColumn("cluster", F.lit(1)), cframe(spark, [[0.0, 0.0]]))


def test_custom_distance_rejects_odd_vectors(spark):
    both = lambda x, c: F.abs(x[0] - c[0]) + F.abs(x[1] - c[1])
    for odd in ([1.0], [1.0, 2.0, 3.0], [1.0, None], None):
        points = spark.createDataFrame([(1, [0.0, 0.0]), (2, odd)], "row_id long, features array<double>")
        with pytest.raises(Exception):
            kmeans.assign(points, cframe(spark, [[0, 0], [1, 1]]), distance=both).collect()


def test_tolerance(spark):
    pts = frame(spark, [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [9.0, 0.0], [10.0, 0.0], [30.0, 0.0]])
    start = cframe(spark, [[0, 0], [1, 0]])
    full = kmeans.kmeans(pts, start)
    steps = [kmeans.kmeans(pts, start, n) for n in range(full.rounds + 1)]
    value = lambda r: [c["center"][0] for c in r.centers.orderBy("cluster").collect()]
    centers = [value(r) for r in steps]
    for tol in (0.0, 0.5, 3.0, 100.0):
        got = kmeans.kmeans(pts, start, tol=tol)
        want = next(i for i in range(1, len(centers)) if max(abs(a - b) for a, b in zip(centers[i], centers[i - 1])) <= tol)
        assert got.rounds == want and value(got) == centers[want]


def test_custom_distance_with_many_centres(spark):
    many = cframe(spark, [[float(i), 0.0] for i in range(1000)])
    rows = kmeans.assign(frame(spark, [[700.2, 0.0], [3.6, 0.0]]), many,
                         distance=lambda x, c: F.abs(x[0] - c[0]) + F.abs(x[1] - c[1])).orderBy("row_id").collect()
    assert [r["cluster"] for r in rows] == [700, 4]


def test_negative_counts_are_rejected(spark):
    docs = spark.createDataFrame([(1, 2, -1.0)], "doc_id long, term_id long, cnt double")
    centers = spark.createDataFrame([(1, 1, 2.0)], "cluster int, term_id long, weight double")
    with pytest.raises(Exception, match="must not be negative"):
        kmeans_bow.bow_step(docs, centers).collect()


def test_stream(spark, tmp_path):
    from mlframe.streaming.scoring import assign_stream, score_stream

    frame(spark, [[0, 0], [9, 9]]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    df = score_stream(assign_stream(stream, cframe(spark, [[0, 0], [10, 10]])), [1.0, -1.0])
    q = df.writeStream.format("memory").queryName("scored").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    rows = spark.sql("select * from scored order by row_id").collect()
    assert [(r["cluster"], r["probability"]) for r in rows] == [(0, 0.5), (1, 0.5)]


@pytest.mark.parametrize("init", ["d2", "farthest"])
def test_distances_so_far_change_no_draw(spark, monkeypatch, init):
    r = random.Random(8)
    pts = frame(spark, [[r.gauss(0, 9), r.gauss(0, 9)] for _ in range(200)]).repartition(3)
    bow = spark.createDataFrame([(i, r.randint(0, 30), float(r.randint(1, 5))) for i in range(60) for _ in range(4)],
                                "doc_id long, term_id long, cnt double")
    got = []
    for fold in (1000, 3):
        monkeypatch.setattr(kmeans, "FOLD", fold)
        got.append((kmeans.kmeans_pp_init(pts, 9, 4, init).orderBy("cluster").collect(),
                    kmeans_bow.bow_init(bow, 8, 4, init).orderBy("cluster").collect()))
    assert got[0] == got[1] and len(got[0][0]) == 9 and len(got[0][1]) == 8


def test_planted_documents(spark):
    r = random.Random(14839204302832)
    rows = []
    for c in range(5):
        base = {t: r.randint(0, 9999) for t in range(200)}
        radius = r.randint(1, 200)
        for i in range(30):
            rows += [(c * 30 + i, t, float(max(1, v + r.randint(0, radius)))) for t, v in base.items()]
    bow = spark.createDataFrame(rows, "doc_id long, term_id long, cnt double")
    res = kmeans_bow.kmeans_pp_bow(bow, 5, 3, seed=1)
    groups = {}
    for x in res.assignment.collect():
        groups.setdefault(x["cluster"], set()).add(x["doc_id"])
    assert sorted(map(sorted, groups.values())) == [list(range(c * 30, c * 30 + 30)) for c in range(5)]


def test_sparse_matches_dense(spark):
    r = random.Random(3)
    dense = [[float(r.choice([0, 0, 0, 1, 2, 5])) for _ in range(9)] for _ in range(60)]
    dense = [d if any(d) else [1.0] + d[1:] for d in dense]
    rows = [(i, j, v) for i, d in enumerate(dense) for j, v in enumerate(d) if v]
    bow = spark.createDataFrame(rows, "doc_id long, term_id int, cnt double")
    start = dense[:3]
    centers = spark.createDataFrame([(c, j, v) for c, d in enumerate(start) for j, v in enumerate(d) if v],
                                    "cluster int, term_id int, weight double")
    got = {}
    for x in kmeans_bow.bow_step(bow, centers).collect():
        got.setdefault(x["cluster"], [0.0] * 9)[x["term_id"]] = x["weight"]
    want = brute(dense, start, 1)
    assert all(np.allclose(got[i], want[i]) for i in got) and got.keys() == want.keys()
    assert kmeans_bow.bow_init(bow, 3, init="farthest").count() == 3
