"""What is written and moved by the jobs that compare documents."""

import itertools
from collections import Counter

import pytest

from mlframe.operators import pairs
from tests.test_clusters import bow_frame, dots, rand_docs


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_block_pairs_write_no_copies(spark):
    """Block pairs are tasks of a cartesian product of one row a block, not groups of copied documents."""
    docs = rand_docs(21, 90, 40, 4)
    got = pairs.dot_similarities(bow_frame(spark, docs), 5)
    plan = plan_of(got)
    assert "FlatMapGroupsInArrow" not in plan and "MapInArrow" in plan
    assert sorted(map(tuple, got.collect())) == dots(docs)
    placed = pairs._by_norm(pairs.pack_documents(bow_frame(spark, docs)), 5)
    packed = pairs.packed_blocks(placed)
    assert packed.count() == placed.select("blk").distinct().count() > 10


@pytest.mark.parametrize("dense", [1, 4, 10 ** 9])
def test_products_by_matrix_and_by_entry(spark, monkeypatch, dense):
    """Frequent terms multiplied as columns, rare ones one by one, or all in one way: the same sums."""
    monkeypatch.setattr(pairs, "DENSE", dense)
    monkeypatch.setattr(pairs, "COLUMNS", 3)
    monkeypatch.setattr(pairs, "CHUNK", 7)
    docs = rand_docs(22, 40, 15, 3)
    docs |= {100 + i: Counter({10_000: 2, 20_000 + i: 1}) for i in range(20)}
    rows = bow_frame(spark, docs)
    for n in (16, 1024):
        placed = pairs._by_norm(pairs.pack_documents(rows), n)
        sides = [pairs._side(pairs.pa.py_buffer(bytes(r["body"]))) for r in pairs.packed_blocks(placed).collect()]
        got = set()
        for l, r in itertools.combinations_with_replacement(sides, 2):
            got |= set(zip(*map(lambda x: x.tolist(), pairs._ordered_pairs(pairs._product(l, r), l[0], r[0]))))
        assert sorted(got) == dots(docs)


def test_a_bag_of_words_moves_texts(spark):
    """Texts are dealt by document once; counting and packing need no further shuffle."""
    from mlframe.operators import bow

    docs = spark.createDataFrame([(1, "a b a"), (2, None), (1, "b c"), (3, " ")], "doc_id long, text string")
    packed = pairs.pack_documents(bow.bag_of_words(docs))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = packed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange") == 1
    assert [(r["doc_id"], r["terms"], r["cnts"]) for r in packed.collect()] == [(1, ["a", "b", "c"], [2.0, 2.0, 1.0])]


def test_canopies_end_with_the_centres_asked_for(spark, monkeypatch):
    """Runs of the smallest undecided ids are decided in turn, and no more of them than give the centres asked for."""
    from mlframe.operators import canopy

    monkeypatch.setattr(canopy, "LEADERS", 4)
    monkeypatch.setattr(canopy, "PAIRS_PER_DOC", 0)
    ran = []
    plain = canopy.first_mis
    monkeypatch.setattr(canopy, "first_mis", lambda nodes, edges: ran.append(nodes.count()) or plain(nodes, edges))
    docs = {i: Counter({f"a{i // 5}": 1, f"b{i // 5}": 1, f"own{i}": 1}) for i in range(40)}
    got = {tuple(r) for r in canopy.canopy_jaccard(bow_frame(spark, docs), 0.3, 0.5, max_rounds=2, batch=8).collect()}
    assert got == {(0, i) for i in range(5)} | {(5, i) for i in range(5, 10)} | {(None, i) for i in range(10, 40)}
    assert len(ran) == 2 and max(ran) <= 4


@pytest.mark.parametrize("linkage", ["single", "min_similarity"])
def test_first_merges_multiply_few_blocks(spark, monkeypatch, linkage):
    """The first merges are those of the whole forest, copies included, and take the blocks that can hold them only."""
    import random

    from mlframe.operators import hac
    from tests.test_clusters import kruskal

    r = random.Random(31)
    size = lambda i: 30 if i % 20 == 0 else r.randint(2, 6)
    docs = {i: Counter(f"t{min(int(r.expovariate(0.15)), 30)}" for _ in range(size(i))) for i in range(200)}
    docs |= {200 + i: docs[i * 10] for i in range(20)} | {300 + i: docs[7] for i in range(5)}
    pairs_made = []
    plain = pairs.block_products
    monkeypatch.setattr(pairs, "block_products", lambda l, r, p, *rest: pairs_made.append(p.count()) or plain(l, r, p, *rest))
    want = kruskal(dots(docs), linkage == "single")
    for n in (1, 8, 12):
        pairs_made.clear()
        got = hac.hac_documents(bow_frame(spark, docs), n, linkage, block_docs=16).history
        assert sorted(tuple(x) for x in got.select("step", "old_id", "new_id", "sim").collect()) == want[:n]
        assert sum(pairs_made) < 13 * 14 / 4  # of the pairs of some 13 blocks


@pytest.mark.parametrize("dims", [2, 40])
def test_many_batches_are_walked_in_runs(spark, monkeypatch, dims):
    """The same descent as a job per batch, with a job per run of batches; a missing label counts as a row only."""
    import random

    from mlframe.operators import logreg

    r = random.Random(41)
    rows = [(i, [r.uniform(-1, 1) for _ in range(dims)], r.randint(0, 1)) for i in range(400)]
    if dims == 2:
        rows += [(1000 + i, [0.5, 0.5], None) for i in range(9)]
    df = spark.createDataFrame(rows, "row_id long, features array<double>, label int").repartition(5)
    jobs = []
    plain = logreg.gradient
    monkeypatch.setattr(logreg, "gradient", lambda *a: jobs.append(1) or plain(*a))
    want = logreg.logreg_fit_sgd(df, 0.5, 2, batch=20, seed=3, portable=True)
    assert len(jobs) == 2 * -(-len(rows) // 20)
    jobs.clear()
    monkeypatch.setattr(logreg, "STEP_JOBS", 4)
    monkeypatch.setattr(logreg, "RUN_VALUES", 20 * (dims + 1) * 6)
    got = logreg.logreg_fit_sgd(df, 0.5, 2, batch=20, seed=3, portable=True)
    assert got == pytest.approx(want, rel=1e-9) and not jobs


def test_rounds_run_on_packed_batches(spark, monkeypatch):
    """Rounds read rows of plain numbers; near ties are decided by the differences, as before."""
    import numpy as np

    from mlframe.operators import kmeans

    r = np.random.default_rng(51)
    values = r.normal(size=(9, 8)) * 100
    x = np.concatenate([r.normal(size=(400, 8)) * 100, (values[2] + values[5])[None] / 2, values, r.integers(-1, 2, size=(200, 8)) + 1e8])
    values = np.concatenate([values, values[:2], np.full((1, 8), 1e8)])  # two centres twice
    assert kmeans._nearest_fast(x, values).tolist() == kmeans._nearest_numpy(x, values)[0].tolist()
    monkeypatch.setattr(kmeans, "PACKED_BYTES", 640)
    for rows in (x, np.round(x[:400])):  # 8 and 4 bytes a number
        df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "row_id long, features array<double>").repartition(3)
        packed = kmeans._packed(df, 8, "features")
        assert packed.columns == ["x", "h"] and packed.count() >= len(rows) / 10
        centers = spark.createDataFrame([(i, v) for i, v in enumerate(rows[:12].tolist())], "cluster int, center array<double>")
        seen, last, c = 0, None, rows[:12]
        while True:  # plain rounds
            near = kmeans._nearest_numpy(rows, c)[0]
            seen += 1
            c = np.array([rows[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(12)])
            if last is not None and (near == last).all():
                break
            last = near
        got = kmeans.kmeans(df, centers)
        assert {q["row_id"]: q["cluster"] for q in got.assignment.collect()} == dict(enumerate(kmeans._nearest_numpy(rows, c)[0].tolist()))
        assert got.rounds == seen


def test_sparse_kmeans_keeps_no_cache_of_postings(spark, monkeypatch):
    """Documents are held as one written row each and given up at the end."""
    from mlframe.operators import kmeans_bow

    held = []
    plain = kmeans_bow._held
    monkeypatch.setattr(kmeans_bow, "_held", lambda b: held.append(plain(b)) or held[-1])
    docs = rand_docs(61, 30, 12, 3)
    docs[90] = Counter({"none": 0})
    res = kmeans_bow.kmeans_pp_bow(bow_frame(spark, docs), 3, 2, 1, portable=True)
    assert sorted(r["doc_id"] for r in res.assignment.collect()) == sorted(d for d in docs if d != 90)
    table, _ = held[0]
    with pytest.raises(Exception):  # its files are gone
        table.count()


def test_prefixes_grow_with_the_terms(spark, monkeypatch):
    """A prefix term is one short row; the way is chosen from some documents and both ways find the same pairs."""
    from tests.test_clusters import jac

    docs = {i: Counter([f"r{i // 2}a", f"r{i // 2}b", f"r{i // 2}c", "all"]) for i in range(60)}
    sets = {d: set(c) for d, c in docs.items()}
    want = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if jac(sets[a], sets[b]) >= 0.5]
    frame = bow_frame(spark, docs | {100: docs[3]})
    words = pairs.word_sets(frame.where("doc_id < 100"))
    reps, _ = pairs.distinct_sets(words)
    assert pairs.prefix_table(reps, 0.5).columns == ["doc_id", "n", "pos", "term_id"]
    monkeypatch.setattr(pairs, "DRAWN", 10)
    rare = words.withColumn("terms", pairs.F.filter("terms", lambda t: t != "all"))
    assert pairs.prefixes(rare, 0.9) is not None  # words of two documents each: the join is short
    assert pairs.prefixes(words.withColumn("terms", pairs.F.array(pairs.F.lit("all"))), 0.9) is None
    got = sorted((r["a"], r["b"]) for r in pairs.jaccard_pairs(frame, 0.5).collect())
    assert got == sorted(want + [(2, 100), (3, 100)])
