import math

import pytest

from mlframe.operators.evaluate import vector_sum
from pyspark.sql import Observation, functions as F

from mlframe.functions import rng, vec
from mlframe.sources import generate, sinks, text


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def arr(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_vectors(spark):
    a, b = arr(1, 2, 2), arr(3, 0, 1)
    r = one(spark, d=vec.euclidean(a, b), s=vec.sq_dist(a, b), dot=vec.dot(a, b), add=vec.vadd(a, b),
            sub=vec.vsub(a, b), sc=vec.vscale(a, 2), n=vec.vnorm(a), e=vec.velement(a, 1), eq=vec.vequal(a, a),
            ne=vec.vequal(a, b), sg=vec.sigmoid(F.lit(0.0)))
    assert r["d"] == 3.0 and r["s"] == 9.0 and r["dot"] == 5.0 and r["n"] == 3.0 and r["e"] == 2.0
    assert r["add"] == [4, 2, 3] and r["sub"] == [-2, 2, 1] and r["sc"] == [2, 4, 4]
    assert r["eq"] and not r["ne"] and r["sg"] == 0.5


@pytest.mark.parametrize("fn", [vec.sq_dist, vec.dot, vec.vadd, vec.vsub])
def test_size_mismatch(spark, fn):
    with pytest.raises(Exception, match="differ in size"):
        one(spark, x=fn(arr(1, 2), arr(1, 2, 3)))


def test_jaccard_and_strings(spark):
    a, b = F.array(F.lit("x"), F.lit("y")), F.array(F.lit("y"), F.lit("z"), F.lit("w"))
    empty = F.array().cast("array<string>")
    r = one(spark, j=vec.jaccard(a, b), z=vec.jaccard(empty, empty), p=vec.pack(a, "-"),
            u=vec.unpack(F.lit("1| 2||3|"), "|"))
    assert r["j"] == 0.25 and r["z"] == 0.0 and r["p"] == "x-y" and r["u"] == ["1", "2", "3"]


def test_uniform_is_partition_independent(spark):
    for portable in (False, True):
        q = lambda p: sorted(r[0] for r in spark.range(0, 500, 1, p).select(
            rng.uniform("id", 3, "s", portable)).collect())
        xs = q(1)
        assert xs == q(7) and 0 <= xs[0] and xs[-1] < 1 and 0.45 < sum(xs) / 500 < 0.55


def test_exact_sample(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    u = rng.uniform("id", 5, "t")
    for buckets in (1, 16, 4096):
        cut = rng.cut_points(df, 37, u, "id", ["g"], buckets)
        below = F.struct(u.alias("u"), F.col("id").alias("id")) <= F.col("cut")
        assert [r["count"] for r in df.join(cut, "g").where(below).groupBy("g").count().collect()] == [37, 37]
    assert rng.exact_sample(df, 37, u, "id").count() == 37
    assert rng.exact_sample(df, 5000, u, "id").count() == 1000
    want = [r[0] for r in df.orderBy(u, "id").limit(37).select("id").collect()]
    got = [r[0] for r in rng.exact_sample(df, 37, u, "id").select("id").collect()]
    assert sorted(want) == sorted(got)
    assert rng.shuffled_subset(df, 0, 1, "id").count() == 1000


def test_weighted_pick_follows_weights(spark):
    df = spark.range(4).withColumn("w", F.col("id").cast("double"))  # weight 0 is never drawn
    picks = [rng.weighted_pick(df, "w", s, "id").first()["id"] for s in range(40)]
    assert 0 not in picks and picks.count(3) > picks.count(1)


def test_readers(spark, tmp_path):
    def write(name, body):
        p = tmp_path / name
        p.write_text(body)
        return str(p)

    v = text.read_labeled_vectors(spark, write("v", "1.5, 2, 0, 100, a|b\n3,4,100,0,c\n"), 2).orderBy("label").collect()
    assert [tuple(r) for r in v] == [([1.5, 2.0], [0.0, 100.0], "a|b"), ([3.0, 4.0], [100.0, 0.0], "c")]
    p = text.read_labeled_points(spark, write("p", "0.5, 3, 10\n,1.5,2\n"), 2, 3).orderBy("label").collect()
    assert [tuple(r) for r in p] == [(2, [1.5, 0.0]), (10, [0.5, 3.0])]
    b = text.read_bow(spark, write("b", "6\n450\n547\n1 61 2\n1 61 3\n2 7 1\n"), ).orderBy("doc_id").collect()
    assert [tuple(r) for r in b] == [(1, 61, 5.0), (2, 7, 1.0)]
    w = text.read_word_sets(spark, write("w", "9\n1 61 2\n1 61 3\n2 7\n")).orderBy("doc_id").collect()
    assert [tuple(r) for r in w] == [(1, 61), (2, 7)]
    q = text.read_points(spark, write("q", "1|-4.5|2|\n2|0|1e1|\n"), "|", 2, True).orderBy("row_id").collect()
    assert [tuple(r) for r in q] == [(1, [-4.5, 2.0]), (2, [0.0, 10.0])]
    s = text.read_points(spark, write("s", "1.5 2.5\n"), " ", 2, False).collect()
    assert s[0]["features"] == [1.5, 2.5]
    c = text.read_centers(spark, write("c", "3 1.5 2.5\n")).collect()
    assert tuple(c[0]) == (3, [1.5, 2.5])
    for body in ("7 x 2\n", "1 61\n", "1 61 2 9\n"):
        with pytest.raises(Exception, match="malformed line"):
            text.read_bow(spark, write("bad", "6\n1 61 2\n" + body)).collect()
        seen = Observation()
        assert text.read_bow(spark, write("bad", "6\n\n1 61 2\n" + body), malformed="drop", counts=seen).count() == 1
        assert seen.get == {"lines": 2, "malformed": 1}
    bad = [(lambda p: text.read_points(spark, p, "|", 2, True), ("1|x|2|", "1|2|", "a|1|2|")),
           (lambda p: text.read_labeled_points(spark, p, 2, 3), ("1,2,1.7", "1,y,2", "1,2")),
           (lambda p: text.read_labeled_vectors(spark, p, 1), ("1,b,c", "3,4")),
           (lambda p: text.read_word_sets(spark, p), ("7 x", "word")),
           (lambda p: text.parse_theta(text.read_lines(spark, p)), ("1.0,x,2", "Theta 1.0,2", "1,,2 3", ","))]
    for read, bodies in bad:
        for body in bodies:
            with pytest.raises(Exception, match="malformed line"):
                read(write("bad", body + "\n")).collect()
    assert text.read_theta(spark, write("t", "1.0E-5,-2.5,3\n")) == [1e-5, -2.5, 3.0]
    assert text.read_theta(spark, write("t", "a,b\n 1, 2 ,\n"), malformed="drop") == [1.0, 2.0]
    with pytest.raises(ValueError):
        text.read_theta(spark, write("t", "a\n"), malformed="drop")


def test_sinks(spark, tmp_path):
    centers = spark.createDataFrame([(1, [0.0, 1.0]), (2, [5.0, 5.0])], "cluster int, center array<double>")
    members = spark.createDataFrame([(2, [1.0, 1.0], 1), (1, [0.25, 2.0], 1)],
                                    "row_id long, features array<double>, cluster int")
    lines = {r["cluster"]: r["value"] for r in sinks.cluster_lines(centers, members).collect()}
    assert lines == {1: "0.0, 1.0, 0.25, 2.0, 1.0, 1.0", 2: "5.0, 5.0"}
    assert sorted(r[0] for r in sinks.assignment_lines(members).collect()) == ["1,0.3,2.0", "1,1.0,1.0"]
    for fmt in ("parquet", "text"):
        sinks.write_clusters(centers, members, str(tmp_path / fmt), fmt)
    assert spark.read.parquet(str(tmp_path / "parquet/centers")).count() == 2
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "text/centers")).collect()) == ["1|0.0|1.0", "2|5.0|5.0"]
    sinks.write_theta(spark, [1e-5, 2.0], str(tmp_path / "theta"))
    assert text.read_theta(spark, str(tmp_path / "theta")) == [1e-5, 2.0]
    can = spark.createDataFrame([(1, 3), (1, 11), (2, 2)], "canopy_id long, doc_id long")
    assert sorted(r["value"] for r in sinks.canopy_lines(can).collect()) == ["2", "3,11"]
    level = spark.createDataFrame([(3, 1), (3, 3), (2, 2)], "cluster_id long, doc_id long")
    assert {r["cluster_id"]: r["value"] for r in sinks.membership_lines(level).collect()} == {3: "1,3", 2: "2"}
    hist = spark.createDataFrame([(2, 3, 4, 1.0), (1, 1, 2, 2.0)], "step long, old_id long, new_id long, sim double")
    assert sinks.history_line(hist).first()[0] == "[1; 2][3; 4]"
    scored = spark.createDataFrame([(0.5, 1, [1.0, 2.0])], "probability double, label int, features array<double>")
    assert sinks.scored_lines(scored).first()[0] == "0.5,1,1.0,2.0"


def test_generators(spark, tmp_path):
    pts = generate.random_sphere(generate.row_ids(spark, 300), 3, 100, 1).collect()
    for r in pts:
        assert set(r["center"]) <= {0, 100}
        assert math.isclose(math.dist(r["features"], r["center"]), 10.0, rel_tol=1e-9)
    assert len({r["label"] for r in pts}) == 8
    cube = generate.random_hypercube(generate.row_ids(spark, 300), 2, 100, 1).collect()
    assert all(abs(x - c) <= 10 for r in cube for x, c in zip(r["features"], r["center"]))
    for r in generate.labels_2d(generate.row_ids(spark, 100), 0.4, 0.3, 2).collect():
        x, y = r["features"]
        assert r["label"] == ("1" if x > 0.4 and y > 0.3 else "-1")
    assert {r["label"] for r in generate.labels_1d(generate.row_ids(spark, 100), 0.4).collect()} == {"1", "-1"}
    path = str(tmp_path / "gen")
    gen = generate.random_sphere(generate.row_ids(spark, 20), 3, 100, 1)
    sinks.write_table(sinks.generated_lines(gen), path, "text")
    back = text.read_labeled_vectors(spark, path, 3)
    assert back.count() == 20
    key = lambda df: sorted(tuple(r["features"]) for r in df.collect())
    assert key(back) == key(gen)


@pytest.mark.parametrize("bad", [[1.0, 2.0, 3.0], [1.0], [1.0, None], None])
def test_vector_sum_rejects_other_vectors(spark, bad):
    df = spark.createDataFrame([([1.0, 2.0],), (bad,)], "features array<double>")
    with pytest.raises(Exception, match="components"):
        vector_sum(df, 2).collect()
