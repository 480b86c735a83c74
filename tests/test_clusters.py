import itertools
import math
import random
from collections import Counter

import pytest

from mlframe.operators import bow, canopy, graph, hac, pairs
from tests.fixtures import DOC_SIMS, EDGES, MIN_LEVELS, SINGLE_LEVELS

EDGE = "a long, b long, sim double"


def kruskal(edges, descending):
    order = sorted(edges, key=lambda e: (-e[2] if descending else e[2], e[0], e[1]))
    top, out = {}, []

    def find(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b, s in order:
        x, y = sorted((find(a), find(b)))
        if x != y:
            top[x] = y
            out.append((len(out) + 1, x, y, s))
    return out


def brute_hac(nodes, edges, t, descending):
    """Literal simulation: merge the best pair, combine similarities by max or min."""
    pick = max if descending else min
    sims = {(a, b): s for a, b, s in edges}
    label = {n: n for n in nodes}
    for _ in range(t):
        if not sims:
            break
        best = pick(sims.values())
        old, new = min(k for k, s in sims.items() if s == best)
        label = {n: new if c == old else c for n, c in label.items()}
        nxt = {}
        for (x, y), s in sims.items():
            x, y = sorted(new if v == old else v for v in (x, y))
            if x != y:
                nxt[(x, y)] = pick(s, nxt.get((x, y), s))
        sims = nxt
    return label


def rand_edges(seed, n, m, weights):
    r = random.Random(seed)
    pool = list(itertools.combinations(range(n), 2))
    return [(a, b, float(r.choice(weights))) for a, b in r.sample(pool, m)]


@pytest.mark.parametrize("descending", [True, False])
def test_forest_and_history(spark, descending):
    edges = rand_edges(4, 40, 70, range(12))  # ties and several components
    want = kruskal(edges, descending)
    df = spark.createDataFrame(edges, EDGE).repartition(3)
    nodes = spark.range(40).withColumnRenamed("id", "doc_id")
    for replay in (5, 1000):  # several runs of steps, and one
        res = hac.hac(df, nodes, 10 ** 9, "single" if descending else "min_similarity", replay)
        got = sorted(tuple(r) for r in res.history.select("step", "old_id", "new_id", "sim").collect())
        assert got == want


@pytest.mark.parametrize("linkage,levels", [("single", SINGLE_LEVELS), ("min_similarity", MIN_LEVELS)])
def test_golden_levels(spark, linkage, levels):
    edges = spark.createDataFrame([(a, b, float(s)) for (a, b), s in DOC_SIMS.items()], EDGE)
    nodes = spark.range(1, 7).withColumnRenamed("id", "doc_id")
    res = hac.hac(edges, nodes, 5, linkage)
    for t in (0, 2, 5):
        got = {r["doc_id"]: r["cluster_id"] for r in res.membership(t).collect()}
        assert "".join(str(got[d]) for d in range(1, 7)) == levels[t]
    sims = [(a, b, float(s)) for (a, b), s in DOC_SIMS.items()]
    for t, level in enumerate(levels):
        label = brute_hac(range(1, 7), sims, t, linkage == "single")
        assert "".join(str(label[d]) for d in range(1, 7)) == level


def test_level_changes(spark):
    merges = [(1, 1, 4), (2, 2, 3), (3, 4, 6), (4, 3, 6), (5, 5, 9), (6, 6, 9)]
    name, want = {d: d for d in range(1, 10)}, []
    for step, old, new in merges:
        for d in [d for d, c in name.items() if c == old]:
            name[d] = new
            want.append((step, new, d))
    got = hac.level_changes(spark.createDataFrame(merges, "step long, old_id long, new_id long"))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert hac.level_changes(spark.createDataFrame([], "step long, old_id long, new_id long")).count() == 0


def test_small_edge_list(spark):
    res = hac.hac(spark.createDataFrame(EDGES, EDGE), spark.range(4).withColumnRenamed("id", "doc_id"), 3)
    assert [(r["old_id"], r["new_id"]) for r in res.history.orderBy("step").collect()] == [(2, 3), (0, 3), (1, 3)]
    with pytest.raises(ValueError):
        hac.hac(spark.createDataFrame(EDGES, EDGE), spark.range(4), 3, "average")


def rand_docs(seed, n, vocab, copies):
    r = random.Random(seed)
    docs = {}
    for i in range(n):
        docs[i] = Counter(r.choice(range(vocab)) for _ in range(r.randint(1, 8)))
    for i in range(copies):  # a third of all rows may be one document
        docs[n + i] = docs[3]
    return docs


def bow_frame(spark, docs):
    rows = [(d, f"t{t}", float(c)) for d, cnt in docs.items() for t, c in cnt.items()]
    return spark.createDataFrame(rows, "doc_id long, term_id string, cnt double")


def dots(docs):
    out = []
    for a, b in itertools.combinations(sorted(docs), 2):
        s = sum(c * docs[b][t] for t, c in docs[a].items())
        if s:
            out.append((a, b, float(s)))
    return out


def test_dot_similarities(spark):
    docs = rand_docs(1, 50, 40, 6)
    want = dots(docs)
    for block in (7, 1024):
        got = sorted(tuple(r) for r in pairs.dot_similarities(bow_frame(spark, docs), block).collect())
        assert got == want


@pytest.mark.parametrize("linkage", ["single", "min_similarity"])
def test_hac_documents_with_copies(spark, linkage):
    docs = rand_docs(2, 40, 30, 20)
    want = kruskal(dots(docs), linkage == "single")
    res = hac.hac_documents(bow_frame(spark, docs), 10 ** 9, linkage, block_docs=9)
    got = sorted(tuple(r) for r in res.history.select("step", "old_id", "new_id", "sim").collect())
    assert got == want


def test_dot_similarities_from_a_least_one(spark):
    docs = rand_docs(11, 60, 40, 6)
    for least in (3.0, 12.0):
        got = sorted(tuple(r) for r in pairs.dot_similarities(bow_frame(spark, docs), 7, least).collect())
        assert got == [e for e in dots(docs) if e[2] >= least]


def skewed_docs(seed, n):
    """Many short documents and a few long ones, as texts are; two kinds of words that never meet; one word of their own for some."""
    r = random.Random(seed)
    docs = {}
    for i in range(n):
        kind = i % 2
        size = r.choice([2, 3, 4, 5, 60]) if i % 10 == 0 else r.choice([1, 2, 3])
        docs[i] = Counter(f"{kind}:{min(int(r.expovariate(0.3)), 12)}" for _ in range(size))
        if i % 17 == 0:
            docs[i][f"own{i}"] += 1
    return docs


def products(block_pairs, sizes):
    return sum(sizes[r["x"]] * sizes[r["y"]] for r in block_pairs.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_forest_by_bounds(spark, seed):
    """The hub's levels spare products, and the forest stays the same, ties and unconnected documents included."""
    docs = skewed_docs(seed, 400)
    want = kruskal(dots(docs), True)
    res = hac.hac_documents(bow_frame(spark, docs), 10 ** 9, "single", block_docs=16)
    assert sorted(tuple(r) for r in res.history.select("step", "old_id", "new_id", "sim").collect()) == want


def test_bounds_skip_most_products(spark):
    r = random.Random(5)
    docs = {i: Counter({f"t{r.randrange(30)}": r.randint(50, 90) for _ in range(20)}) for i in range(30)}
    docs |= {i: Counter(f"t{r.randrange(30)}" for _ in range(4)) for i in range(30, 1200)}
    packed = pairs._by_norm(pairs.pack_documents(bow_frame(spark, docs)), 32)
    none = lambda sums, ids_l, ids_r, *rest: pairs.local_forest(*pairs._signed(pairs._ordered_pairs(sums, ids_l, ids_r), -1.0))
    _, levels = pairs.hub_levels(packed, none)
    placed, rest = pairs.rest_pairs(packed, levels, 32)
    sizes = Counter(r["blk"] for r in placed.collect())
    assert sum(sizes.values()) == 1200
    assert products(rest, sizes) + 32 * 1200 < 0.3 * 1200 ** 2


def jac(x, y):
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("products", [True, False])
@pytest.mark.parametrize("t", [0.2, 0.5, 1.0])
def test_jaccard_pairs(spark, monkeypatch, products, t):
    docs = rand_docs(5, 60, 25, 5)
    sets = {d: set(c) for d, c in docs.items()}
    want = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if jac(sets[a], sets[b]) >= t]
    frame = bow_frame(spark, docs)
    reps, _ = pairs.distinct_sets(pairs.word_sets(frame))
    prefix = pairs.prefix_table(reps, t)
    if products:
        assert sorted((r["a"], r["b"]) for r in pairs.jaccard_pairs(frame, t).collect()) == want
    else:
        cand = pairs.candidate_pairs(prefix, prefix, t).where("a < b")
        got = pairs.verify_pairs(cand, reps, reps, t, False).collect()
        ids = {r["doc_id"] for r in reps.collect()}
        assert sorted((r["a"], r["b"]) for r in got) == [p for p in want if p[0] in ids and p[1] in ids]


@pytest.mark.parametrize("least, block", [(0.3, 7), (0.7, 5), (1.0, 9)])
def test_one_term_in_every_document(spark, monkeypatch, least, block):
    """A term that all documents share, sub-lists of two documents, and both ways of finding pairs."""
    docs = {d: c + Counter({10_000: 1}) for d, c in rand_docs(8, 70, 25, 9).items()}
    docs |= {200 + i: Counter({10_000: 1, 500 + i // 2: 1}) for i in range(20)}
    sets = {d: set(c) for d, c in docs.items()}
    want = {(a, b): jac(sets[a], sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if jac(sets[a], sets[b]) >= least}
    reps, _ = pairs.distinct_sets(pairs.word_sets(bow_frame(spark, docs)))
    prefix = pairs.prefix_table(reps, least)
    ids = {r["doc_id"] for r in reps.collect()}
    own = {p: s for p, s in want.items() if set(p) <= ids}
    monkeypatch.setattr(pairs, "LIST", 2)
    cand = pairs.candidate_pairs(prefix, prefix, least)
    assert cand.count() == cand.distinct().count()
    got = pairs.verify_pairs(cand.where("a < b"), reps, reps, least, False).collect()
    assert {(r["a"], r["b"]): r["sim"] for r in got} == pytest.approx(own)
    ones = reps.withColumn("cnts", pairs.F.transform("terms", lambda x: pairs.F.lit(1.0)))
    blocks = pairs.in_blocks(ones, [pairs.F.size("terms").desc()], block)
    near, n = pairs._near_sizes(blocks, None, least)
    got = pairs.block_products(blocks, None, near, pairs._jaccard_emit(least, False, True)).collect()
    assert {(r["a"], r["b"]): r["sim"] for r in got} == pytest.approx(own)
    assert n < len(ids) ** 2


def test_jaccard_canopies_at_the_ends(spark):
    """Nothing is more similar than 1, equal sets neither; above 0 lies every shared word."""
    docs = {1: Counter("ab"), 2: Counter("ab"), 3: Counter("bc"), 4: Counter("d"), 5: Counter("d")}
    rows = lambda t: sorted((r["canopy_id"], r["doc_id"]) for r in canopy.canopy_jaccard(bow_frame(spark, docs), t, 1.0).collect())
    assert rows(1.0) == [(i, i) for i in range(1, 6)]
    assert rows(0.0) == [(1, 1), (1, 2), (1, 3), (4, 4), (4, 5)]


def greedy(ids, near):
    kept = []
    for i in sorted(ids):
        if not any(near(i, c) for c in kept):
            kept.append(i)
    return kept


def test_first_mis(spark):
    edges = {(a, b) for a, b, _ in rand_edges(9, 60, 120, [1])}
    near = lambda x, y: (x, y) in edges or (y, x) in edges
    got = graph.first_mis(spark.range(60).withColumnRenamed("id", "v"),
                          spark.createDataFrame(sorted(edges), "a long, b long"))
    assert sorted(r["v"] for r in got.collect()) == greedy(range(60), near)


def test_first_mis_by_hash(spark):
    """An ordered chain takes logarithmic rounds; the set is the greedy one in the order of the numbers."""
    chain = spark.range(100_000).withColumnRenamed("id", "v")
    links = spark.range(99_999).selectExpr("id AS a", "id + 1 AS b")
    rounds = []
    kept = {r["v"] for r in graph.first_mis(chain, links, "hash", 3, rounds=rounds).collect()}
    assert rounds[0] < 40
    assert all(v + 1 not in kept for v in kept) and all(v in kept or v - 1 in kept or v + 1 in kept for v in range(100_000))
    edges = {(a, b) for a, b, _ in rand_edges(9, 60, 120, [1])}
    drawn = {r["v"]: r["u"] for r in spark.range(60).select(graph.F.col("id").alias("v"), graph.uniform("id", 3, "mis").alias("u")).collect()}
    order = sorted(drawn, key=lambda v: (drawn[v], v))
    place = {v: i for i, v in enumerate(order)}
    near = lambda x, y: (order[x], order[y]) in edges or (order[y], order[x]) in edges
    got = graph.first_mis(spark.range(60).withColumnRenamed("id", "v"), spark.createDataFrame(sorted(edges), "a long, b long"), "hash", 3)
    assert sorted(place[r["v"]] for r in got.collect()) == greedy(range(60), near)
    with pytest.raises(ValueError):
        graph.first_mis(chain, links, "other")


def test_memberships_and_levels_of_a_long_chain(spark):
    """A chain of merges renames a document once a merge; any step is found by doubling."""
    n = 70
    edges = spark.createDataFrame([(i, i + 1, float(1000 - i)) for i in range(n)], EDGE)
    nodes = spark.range(n + 1).withColumnRenamed("id", "doc_id")
    res = hac.hac(edges, nodes, 10 ** 9)
    assert len(hac.lifted(res.history)) == 7
    steps = spark.createDataFrame([(0,), (1,), (13,), (69,), (70,), (500,)], "step long")
    got = {}
    for r in res.memberships(steps).collect():
        got.setdefault(r["step"], {})[r["doc_id"]] = r["cluster_id"]
    for t in got:
        assert got[t] == {r["doc_id"]: r["cluster_id"] for r in res.membership(t).collect()}
    assert set(got) == {0, 1, 13, 69, 70, 500}
    levels = sorted(tuple(r) for r in hac.level_changes(res.history).collect())
    assert levels == sorted((s, s, d) for s in range(1, n + 1) for d in range(s))


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9)], "a long, b long")
    got = graph.components(edges, spark.range(1, 8).withColumnRenamed("id", "v"))
    assert {r["v"]: r["label"] for r in got.collect()} == {1: 3, 2: 3, 3: 3, 4: 5, 5: 5, 6: 6, 7: 7}


def sequential_canopy(points, t1, t2):
    """Literal head-of-the-list loop; equal points leave together."""
    first = {}
    for i, p in points:
        first.setdefault(tuple(p), i)
    left = sorted((i, p) for p, i in first.items())
    out = set()
    while left:
        c, head = left[0]
        left = [x for x in left if x[0] != c]
        near = [(i, math.dist(p, head)) for i, p in left]
        members = {i for i, d in near if d <= t1}
        out |= {(c, i) for i in members} or {(c, None)}
        gone = {i for i, d in near if d <= t2}
        left = [x for x in left if x[0] not in gone]
    return out


@pytest.mark.parametrize("dims", [1, 2, 3, 7])
def test_canopy_euclidean(spark, dims):
    r = random.Random(dims)
    pts = [(i, [float(r.randint(0, 14)) for _ in range(dims)]) for i in range(90)]
    pts += [(90 + i, pts[4][1]) for i in range(40)]  # copies of one point
    df = spark.createDataFrame(pts, "row_id long, features array<double>").repartition(3)
    got = {(x["canopy_id"], x["row_id"]) for x in canopy.canopy_euclidean(df, 7, 3).collect()}
    assert got == sequential_canopy(pts, 7, 3)
    with pytest.raises(ValueError):
        canopy.canopy_euclidean(df, 2, 3)


@pytest.mark.parametrize("batch,leaders", [(0, 2), (0, 64), (10 ** 6, 64)])
def test_canopy_jaccard(spark, monkeypatch, batch, leaders):
    monkeypatch.setattr(canopy, "LEADERS", leaders)
    monkeypatch.setattr(canopy, "PAIRS_PER_DOC", 0)
    docs = rand_docs(8, 60, 20, 15)
    sets = {d: frozenset(c) for d, c in docs.items()}
    t1 = 0.3
    kept = greedy(sets, lambda x, c: jac(sets[x], sets[c]) > t1)
    want = {(c, d) for c in kept for d in sets if c == d or jac(sets[c], sets[d]) > t1}
    frame = bow_frame(spark, docs)
    assert {tuple(r) for r in canopy.canopy_jaccard(frame, t1, 0.5, batch=batch).collect()} == want
    if batch:
        some = {tuple(r) for r in canopy.canopy_jaccard(frame, t1, 0.5, max_rounds=2, batch=batch).collect()}
        in_two = {(c, d) for c, d in want if c in kept[:2]}
        rest = set(sets) - {d for _, d in in_two}
        assert some == in_two | {(None, d) for d in rest}


def brute_centroid(points):
    cl = [(i, 1, list(p)) for i, p in points]
    nxt, out = max(i for i, _ in points) + 1, []
    while len(cl) > 1:
        mean = lambda c: [x / c[1] for x in c[2]]
        d, i, j = min((math.dist(mean(cl[i]), mean(cl[j])), i, j) for i, j in itertools.combinations(range(len(cl)), 2))
        a, b = cl[i], cl[j]
        out.append((a[0], b[0], round(d, 9)))
        cl = [c for k, c in enumerate(cl) if k not in (i, j)] + [(nxt, a[1] + b[1], [x + y for x, y in zip(a[2], b[2])])]
        nxt += 1
    return out


def test_hac_centroid(spark):
    r = random.Random(6)
    pts = [(i, [r.random(), r.random()]) for i in range(9)]
    df = spark.createDataFrame(pts, "row_id long, features array<double>")
    for block in (512, 2):
        got = [(x["a"], x["b"], round(x["distance"], 9)) for x in hac.hac_centroid(df, block_points=block).collect()]
        assert got == brute_centroid(pts)
    two = spark.createDataFrame([(0, [24.0, 44.0]), (1, [57.0, 14.0]), (2, [20.0, 47.0]), (3, [57.3, 10.0])],
                                "row_id long, features array<double>")
    first = hac.hac_centroid(two, until=3).collect()
    assert [(x["a"], x["b"]) for x in first] == [(1, 3)]


def test_bag_of_words(spark):
    docs = spark.createDataFrame([(1, "a b  a"), (2, "A\nb c")], "doc_id long, text string")
    got = {(r["doc_id"], r["term"]): r["cnt"] for r in bow.term_counts(docs).collect()}
    assert got == {(1, "a"): 2, (1, "b"): 1, (2, "A\nb"): 1, (2, "c"): 1}
    maps = {r["doc_id"]: r["terms"] for r in bow.document_maps(bow.bag_of_words(docs)).collect()}
    assert maps[1] == {"a": 2.0, "b": 1.0}
