"""The same queries in plain SQL, written independently of the Spark operators."""

from __future__ import annotations

SEED = 7


def u(id_sql: str, stream: str) -> str:
    """md5 uniform number; ``stream`` is an SQL expression."""
    return f"(('0x' || substr(md5('{SEED}:' || ({stream}) || ':' || ({id_sql})), 1, 8))::BIGINT / 4294967296.0)"


def rnd(x: str, digits: int = 6) -> str:
    return f"round(({x})::DOUBLE, {digits}) + 0.0"


LI_ID = "(l_orderkey * 10 + l_linenumber)"
TINY = "1.1641532182693481e-10"

EMB = """pts AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id AS row_id, embedding::DOUBLE[] AS f, label FROM embeddings)"""
MEANS = """c0 AS (SELECT label AS cluster, list(m ORDER BY j) AS c FROM (
  SELECT label, j, avg(f[j]) AS m FROM pts, range(1, 65) t(j) GROUP BY 1, 2) GROUP BY 1)"""
ORDERS2D = """pts AS MATERIALIZED (SELECT row_number() OVER () AS rid, o_orderkey AS row_id, [o_totalprice / 1000.0,
  date_diff('day', DATE '1992-01-01', o_orderdate::DATE) / 7.0]::DOUBLE[] AS f FROM orders)"""
ITEMS = f"""pts AS MATERIALIZED (SELECT row_number() OVER () AS rid, {LI_ID} AS row_id, [l_quantity / 50.0, l_discount * 10.0]::DOUBLE[] AS f,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)"""
SMALL = """c0(cluster, c) AS (VALUES (1, [0.1, 0.5]::DOUBLE[]), (2, [0.35, 0.2]::DOUBLE[]),
  (3, [0.6, 0.8]::DOUBLE[]), (4, [0.9, 0.4]::DOUBLE[]))"""
BOW = """tok AS (SELECT doc_id, unnest(string_split(text, ' ')) AS term FROM documents),
bow AS MATERIALIZED (SELECT doc_id, term, count(*) AS cnt FROM tok WHERE term <> '' GROUP BY 1, 2)"""


def nearest(points: str, centers: str, dist: str = "list_distance(p.f, c.c)") -> str:
    return f"""SELECT p.*, c.cluster, {dist} AS dist FROM {points} p CROSS JOIN {centers} c
  QUALIFY row_number() OVER (PARTITION BY p.rid ORDER BY {dist}, c.cluster) = 1"""


def means(assigned: str, dims: int) -> str:
    return f"""SELECT cluster, list(m ORDER BY j) AS c FROM (
  SELECT cluster, j, avg(f[j]) AS m FROM {assigned}, range(1, {dims + 1}) t(j) GROUP BY 1, 2) GROUP BY 1"""


def lloyd(rounds: int, dims: int, points: str = "pts", keep: bool = True, start: int = 0) -> str:
    out = []
    for i in range(start + 1, start + rounds + 1):
        out.append(f"a{i} AS MATERIALIZED ({nearest(points, f'c{i - 1}')})")
        if keep:
            out.append(f"n{i} AS ({means(f'a{i}', dims)})")
            out.append(f"c{i} AS MATERIALIZED (SELECT o.cluster, coalesce(n.c, o.c) AS c FROM c{i - 1} o LEFT JOIN n{i} n USING (cluster))")
        else:
            out.append(f"c{i} AS MATERIALIZED ({means(f'a{i}', dims)})")
    return ",\n".join(out)


def flat(centers: str, dims: int, extra: str = "") -> str:
    return f"SELECT cluster, {extra} (j - 1)::INTEGER AS pos, {rnd('c[j]')} AS value FROM {centers}, range(1, {dims + 1}) t(j)"


def pp_init(k: int, first: str, weight: str = "d2") -> str:
    """CTEs c1..ck of chosen centres; the last one is the start."""
    out = [f"p1 AS MATERIALIZED (SELECT 1 AS cluster, f AS c FROM pts ORDER BY {first} LIMIT 1)"]
    for i in range(1, k):
        key = f"-ln({u('row_id', repr('d' + str(i)))} + {TINY}) / d2" if weight == "d2" else "-d2"
        out.append(f"""p{i + 1} AS MATERIALIZED (SELECT * FROM p{i} UNION ALL (SELECT {i + 1}, f FROM (
  SELECT p.row_id, p.f, min(list_distance(p.f, c.c)) ** 2 AS d2 FROM pts p CROSS JOIN p{i} c GROUP BY 1, 2)
  WHERE d2 > 0 ORDER BY {key}, row_id LIMIT 1))""")
    return ",\n".join(out)


DOC_FEATURES = """docs AS MATERIALIZED (SELECT d.doc_id AS row_id, [n_chars::DOUBLE, len(list_filter(string_split(text, ' '), lambda w: w <> ''))::DOUBLE,
  (length(text) - length(replace(text, '.', '')))::DOUBLE, toxic::DOUBLE] AS f, quality AS label
  FROM documents d JOIN labels l USING (doc_id))"""
DISTINCT_DOCS = "uni AS MATERIALIZED (SELECT f, label, min(row_id) AS row_id FROM docs GROUP BY 1, 2)"


def bags(n_trees: int, ratio: float) -> str:
    stream = "'bag' || tree_id"
    return f"""bags AS MATERIALIZED (SELECT row_id, f, label, tree_id, row_number() OVER (
    PARTITION BY tree_id ORDER BY {u('row_id', stream)}, row_id)
    <= floor({ratio} * (SELECT count(*) FROM docs) + 0.5) AS in_bag
  FROM uni, (SELECT range::INTEGER AS tree_id FROM range(1, {n_trees + 1})))"""


def h(parts: list[str], total: str) -> str:
    return "-(" + " + ".join(
        f"(CASE WHEN {p} > 0 THEN ({p} / {total}::DOUBLE) * log2({p} / {total}::DOUBLE) ELSE 0 END)" for p in parts) + ")"


def gain_sql(left: list[str], right: list[str]) -> str:
    nl, nr = (f"({' + '.join(x)})" for x in (left, right))
    tot = [f"({a} + {b})" for a, b in zip(left, right)]
    n = f"({nl} + {nr})"
    hr = f"(CASE WHEN {nr} > 0 THEN {h(right, f'greatest({nr}, 1)')} ELSE 0 END)"
    return f"({h(tot, n)} - ({nl} / {n}::DOUBLE * {h(left, nl)} + {nr} / {n}::DOUBLE * {hr}))"


def tree_levels(rows: str, depth: int, m: int, dims: int = 4, classes: tuple = (0, 1)) -> str:
    """CTEs w1.. (rows per level), s1.. (node statistics) and b1.. (splits), and ``nodes``."""
    ks = range(len(classes))
    counts = ", ".join(f"count(*) FILTER (label = {c!r}) AS k{i}" for i, c in enumerate(classes))
    out = [f"w1 AS MATERIALIZED (SELECT tree_id, '1' AS node_id, f, label FROM {rows})"]
    for i in range(1, depth + 2):
        out.append(f"s{i} AS MATERIALIZED (SELECT tree_id, node_id, count(*) AS n, {counts} FROM w{i} GROUP BY 1, 2)")
        if i > depth:
            break
        key = "tree_id || '/' || node_id"
        uf = u(key, "'feature' || fno")
        out.append(f"""f{i} AS MATERIALIZED (SELECT tree_id, node_id, fno FROM s{i}, (SELECT range AS fno FROM range(0, {dims}))
  WHERE greatest({', '.join(f'k{k}' for k in ks)}) < n
  QUALIFY row_number() OVER (PARTITION BY tree_id, node_id ORDER BY {uf}, fno) <= {m})""")
        out.append(f"""h{i} AS (SELECT tree_id, node_id, fno, f[fno + 1] AS v, {counts} FROM w{i} JOIN f{i} USING (tree_id, node_id) GROUP BY 1, 2, 3, 4)""")
        sums = ", ".join(f"sum(k{k}) OVER o AS l{k}, sum(k{k}) OVER p - sum(k{k}) OVER o AS q{k}" for k in ks)
        out.append(f"""r{i} AS (SELECT tree_id, node_id, fno, v, {sums} FROM h{i}
  WINDOW o AS (PARTITION BY tree_id, node_id, fno ORDER BY v), p AS (PARTITION BY tree_id, node_id, fno))""")
        g = gain_sql([f"l{k}" for k in ks], [f"q{k}" for k in ks])
        out.append(f"""b{i} AS MATERIALIZED (SELECT tree_id, node_id, fno::INTEGER AS feature, v AS threshold FROM r{i}
  WHERE {' + '.join(f'q{k}' for k in ks)} > 0
  QUALIFY row_number() OVER (PARTITION BY tree_id, node_id ORDER BY round({g}, 9) DESC, fno, v DESC) = 1)""")
        out.append(f"""w{i + 1} AS MATERIALIZED (SELECT w.tree_id,
  node_id || CASE WHEN w.f[b.feature + 1] > b.threshold THEN '1' ELSE '0' END AS node_id, w.f, w.label
  FROM w{i} w JOIN b{i} b USING (tree_id, node_id))""")
    most = f"greatest({', '.join(f'k{k}' for k in ks)})"
    label = "CASE " + " ".join(f"WHEN k{i} = {most} THEN {c!r}" for i, c in enumerate(classes)) + " END"
    parts = []
    for i in range(1, depth + 2):
        split = f"LEFT JOIN b{i} USING (tree_id, node_id)" if i <= depth else ""
        cols = "feature, threshold" if i <= depth else "NULL::INTEGER AS feature, NULL::DOUBLE AS threshold"
        parts.append(f"SELECT tree_id, node_id, {cols}, n, {label} AS prediction, {most} AS n_prediction FROM s{i} {split}")
    out.append("nodes AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")")
    return ",\n".join(out)


def binned(rows: str, keep: str, max_bins: int, dims: int = 4) -> str:
    """CTEs ``edges`` (quantiles of docs.f) and ``inbins``: ``rows`` with f replaced by the numbers of edges below."""
    return f"""vals AS (SELECT fno, f[fno + 1] AS v, count(*) AS c FROM docs, (SELECT range AS fno FROM range(0, {dims})) GROUP BY 1, 2),
upto AS (SELECT fno, v, c, sum(c) OVER (PARTITION BY fno ORDER BY v)::BIGINT AS r, sum(c) OVER (PARTITION BY fno)::BIGINT AS n,
  count(*) OVER (PARTITION BY fno) AS k, max(v) OVER (PARTITION BY fno) AS top FROM vals),
edges AS MATERIALIZED (SELECT fno, row_number() OVER (PARTITION BY fno ORDER BY v) - 1 AS bin, v AS edge FROM upto
  WHERE v < top AND ((r * {max_bins}) // n > ((r - c) * {max_bins}) // n OR k <= {max_bins})),
inbins AS MATERIALIZED (SELECT {keep}, [{', '.join(
    f"len(list_filter((SELECT list(edge) FROM edges WHERE fno = {j}), lambda e: e < f[{j + 1}]))" for j in range(dims))}] AS f FROM {rows})"""


EDGE_NODES = """edged AS MATERIALIZED (SELECT tree_id, node_id, feature, edge AS threshold, n, prediction, n_prediction
  FROM nodes LEFT JOIN edges ON fno = feature AND bin = nodes.threshold)"""


def route(rows: str, depth: int) -> str:
    """CTE ``leafs``: rows (row_id, tree_id, f, ...) with their final node."""
    out, prev = [f"g0 AS (SELECT *, '1' AS node_id FROM {rows})"], "g0"
    for i in range(1, depth + 1):
        out.append(f"""g{i} AS (SELECT p.* EXCLUDE (node_id), CASE WHEN t.feature IS NULL THEN p.node_id
  WHEN p.f[t.feature + 1] > t.threshold THEN p.node_id || '1' ELSE p.node_id || '0' END AS node_id
  FROM {prev} p LEFT JOIN nodes t ON t.tree_id = p.tree_id AND t.node_id = p.node_id)""")
        prev = f"g{i}"
    out.append(f"leafs AS (SELECT p.*, t.prediction FROM {prev} p JOIN nodes t ON t.tree_id = p.tree_id AND t.node_id = p.node_id)")
    return ",\n".join(out)


FOREST = f"{DOC_FEATURES},\n{DISTINCT_DOCS},\n{bags(3, 0.7)},\n{tree_levels('bags WHERE in_bag', 2, 2)}"
ALL_TREES = "(SELECT row_id, f, label, tree_id FROM docs, (SELECT range::INTEGER AS tree_id FROM range(1, 4)))"
EVERY_DOC = ALL_TREES.replace("FROM docs,", """FROM (SELECT d.doc_id AS row_id, [n_chars::DOUBLE,
  len(list_filter(string_split(text, ' '), lambda w: w <> ''))::DOUBLE, (length(text) - length(replace(text, '.', '')))::DOUBLE,
  coalesce(toxic, 0)::DOUBLE] AS f, quality AS label FROM documents d LEFT JOIN labels l USING (doc_id)),""")
BINNED_FOREST = f"""{DOC_FEATURES},\n{DISTINCT_DOCS},\n{bags(3, 0.7)},\n{binned('bags', 'row_id, label, tree_id, in_bag', 8)},
{tree_levels('inbins WHERE in_bag', 3, 2)},\n{EDGE_NODES}"""
BINNED_TREE = f"""{DOC_FEATURES},\n{binned('docs', 'row_id, label, 1 AS tree_id', 32)},\n{tree_levels('inbins', 4, 4)},\n{EDGE_NODES}"""
LINEITEM = f"""docs AS MATERIALIZED (SELECT ({LI_ID} * 100000 + l_partkey) * 10000 + l_suppkey AS row_id, [l_quantity, l_extendedprice, l_discount, l_tax]::DOUBLE[] AS f,
  l_returnflag AS label FROM lineitem),\n{DISTINCT_DOCS},\n{bags(3, 0.66)}"""
FLAGS = ("A", "N", "R")
OOB_BY_TREE = f"SELECT tree_id, count(*) AS n, {rnd('avg(CASE WHEN prediction <> label THEN 1.0 ELSE 0.0 END)')} AS error FROM leafs GROUP BY 1"
VOTES = """votes AS (SELECT row_id, prediction AS label, count(*) / 3.0 AS share FROM leafs GROUP BY 1, 2),
pred AS (SELECT row_id, label AS prediction, share FROM votes
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY share DESC, label) = 1)"""

SETS = """sz AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM bow GROUP BY 1),
sim AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM bow a JOIN bow b
  ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2),
jac AS MATERIALIZED (SELECT a, b, shared / (x.n + y.n - shared)::DOUBLE AS sim FROM sim
  JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b)"""

# greedy independent set: a vertex is taken once all smaller neighbours are out, and is out next to a taken one
MIS = """st(r, id, s) AS (
  SELECT 0, id, 'u' FROM verts
  UNION ALL
  SELECT st.r + 1, st.id, CASE WHEN st.s <> 'u' THEN st.s WHEN n.taken THEN 'x' WHEN coalesce(n.wait, false) THEN 'u' ELSE 'c' END
  FROM st LEFT JOIN (SELECT e.a, bool_or(t.s = 'c') AS taken, bool_or(t.s = 'u' AND e.b < e.a) AS wait
    FROM both_ways e JOIN st t ON t.id = e.b GROUP BY e.a) n ON n.a = st.id
  WHERE EXISTS (SELECT 1 FROM st WHERE s = 'u')),
centers AS MATERIALIZED (SELECT id FROM st WHERE r = (SELECT max(r) FROM st) AND s = 'c')"""


def jaccard_canopies(t1: float) -> str:
    return f"""WITH RECURSIVE {BOW}, {SETS},
both_ways AS MATERIALIZED (SELECT a, b FROM jac WHERE sim > {t1} UNION ALL SELECT b, a FROM jac WHERE sim > {t1}),
verts AS (SELECT doc_id AS id FROM sz), {MIS},
canopies AS (SELECT id AS canopy_id, id AS doc_id FROM centers
  UNION ALL SELECT e.a, e.b FROM both_ways e JOIN centers c ON c.id = e.a)"""


DOT_EDGES = f"""{BOW},
e AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.cnt * b.cnt)::DOUBLE AS s FROM bow a JOIN bow b
  ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2),
ids AS (SELECT DISTINCT doc_id FROM bow)"""
ORDER_EDGES = """e AS MATERIALIZED (SELECT l_suppkey AS a, l_partkey + 10000000000 AS b, sum(l_quantity)::DOUBLE AS s FROM lineitem GROUP BY 1, 2),
ids AS (SELECT a AS doc_id FROM e UNION SELECT b FROM e)"""


def merges(edges: str, order: str, t: int) -> str:
    """CTE ``st``: the cluster of every document after each of up to t merges, best pair first."""
    return f"""WITH RECURSIVE {edges},
st(step, doc, cl, o, n, s) AS (
  SELECT 0::BIGINT, doc_id, doc_id, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM ids
  UNION ALL
  SELECT st.step + 1, st.doc, CASE WHEN st.cl = m.o THEN m.n ELSE st.cl END, m.o, m.n, m.s
  FROM st, (SELECT least(x.cl, y.cl) AS o, greatest(x.cl, y.cl) AS n, e.s FROM e JOIN st x ON x.doc = e.a
    JOIN st y ON y.doc = e.b WHERE x.cl <> y.cl ORDER BY e.s {order}, e.a, e.b LIMIT 1) m
  WHERE st.step < {t})"""


def forest_first(edges: str) -> str:
    """``edges`` with ``e`` cut down to its maximum spanning forest, which Prim's algorithm grows document by document."""
    return edges.replace("e AS MATERIALIZED", "every AS MATERIALIZED", 1) + """,
two_way AS MATERIALIZED (SELECT a AS x, b AS y, s, a, b FROM every UNION ALL SELECT b, a, s, a, b FROM every),
prim(k, doc, inside, s, a, b) AS (
  SELECT 0, doc_id, false, NULL::DOUBLE, NULL::BIGINT, NULL::BIGINT FROM ids
  UNION ALL
  SELECT q.k + 1, q.doc, q.inside OR q.doc = p.doc,
    CASE WHEN f THEN t.s ELSE q.s END, CASE WHEN f THEN t.a ELSE q.a END, CASE WHEN f THEN t.b ELSE q.b END
  FROM (SELECT q.*, p.doc AS p_doc FROM prim q, (SELECT doc FROM prim WHERE NOT inside ORDER BY s DESC NULLS LAST, a, b, doc LIMIT 1) p) q
  LEFT JOIN two_way t ON t.x = q.p_doc AND t.y = q.doc,
  LATERAL (SELECT q.p_doc AS doc, NOT q.inside AND t.s IS NOT NULL AND (q.s IS NULL OR t.s > q.s OR (t.s = q.s AND (t.a, t.b) < (q.a, q.b))) AS f) p),
e AS MATERIALIZED (SELECT q.a, q.b, q.s FROM prim q JOIN prim n ON n.k = q.k + 1 AND n.doc = q.doc WHERE NOT q.inside AND n.inside AND q.s IS NOT NULL)"""


def dot_hac(order: str, t: int) -> str:
    return merges(DOT_EDGES, order, t)


HISTORY = "SELECT DISTINCT step, o AS old_id, n AS new_id, s AS sim FROM st WHERE step > 0"


def theta_rounds(rounds: int, alpha: float) -> str:
    out = ["t0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for i in range(1, rounds + 1):
        e = "(1.0 / (1.0 + exp(-(f[1] * t.a + f[2] * t.b))) - y)"
        out.append(f"""t{i} AS MATERIALIZED (SELECT any_value(t.a) - {alpha} * avg({e} * f[1]) AS a,
  any_value(t.b) - {alpha} * avg({e} * f[2]) AS b FROM pts, t{i - 1} t)""")
    return ",\n".join(out)


def theta_flat(name: str) -> str:
    return (f"SELECT 0 AS pos, {rnd('a', 8)} AS value FROM {name} UNION ALL SELECT 1, {rnd('b', 8)} FROM {name}")


PROB = "1.0 / (1.0 + exp(-(f[1] * t.a + f[2] * t.b)))"


SGD = f"""tagged AS MATERIALIZED (SELECT *, floor({u('row_id', "'batch'")} * (SELECT ceil(count(*) / 20000.0) FROM pts)) AS bt FROM pts),
t(i, a, b) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT t.i + 1, t.a - 0.5 * avg(({PROB} - y) * f[1]), t.b - 0.5 * avg(({PROB} - y) * f[2])
  FROM t JOIN tagged ON bt = t.i GROUP BY t.i, t.a, t.b)"""


def bow_round(i: int) -> str:
    """a{i}: nearest of sparse centres k{i-1}(cluster, term, w); k{i}: their means."""
    p = i - 1
    return f"""cn{i} AS (SELECT cluster, sum(w * w) AS cn FROM k{p} GROUP BY 1),
dt{i} AS MATERIALIZED (SELECT doc_id, cluster, sum(cnt * w) AS dot FROM bow JOIN k{p} USING (term) GROUP BY 1, 2),
a{i} AS MATERIALIZED (SELECT d.doc_id, c.cluster, d.dn + c.cn - 2 * coalesce(t.dot, 0) AS d2 FROM dn d CROSS JOIN cn{i} c
  LEFT JOIN dt{i} t ON t.doc_id = d.doc_id AND t.cluster = c.cluster
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY c.cn - 2 * coalesce(t.dot, 0), c.cluster) = 1),
k{i} AS MATERIALIZED (SELECT a.cluster, b.term, sum(b.cnt) / any_value(z.n)::DOUBLE AS w FROM bow b JOIN a{i} a USING (doc_id)
  JOIN (SELECT cluster, count(*) AS n FROM a{i} GROUP BY 1) z ON z.cluster = a.cluster GROUP BY 1, 2)"""


def bow_pp(k: int, rounds: int) -> str:
    out = [BOW, "dn AS MATERIALIZED (SELECT doc_id, sum(cnt * cnt)::DOUBLE AS dn FROM bow GROUP BY 1)",
           f"q1 AS MATERIALIZED (SELECT 1 AS cluster, doc_id FROM dn ORDER BY {u('doc_id', repr('row'))}, doc_id LIMIT 1)"]
    for i in range(1, k):
        out.append(f"""q{i + 1} AS MATERIALIZED (SELECT * FROM q{i} UNION ALL (SELECT {i + 1}, doc_id FROM (
  SELECT d.doc_id, min(d.dn + c.dn - 2 * coalesce(t.dot, 0)) AS d2 FROM dn d CROSS JOIN (SELECT dn.* FROM dn JOIN q{i} USING (doc_id)) c
  LEFT JOIN (SELECT a.doc_id AS x, b.doc_id AS y, sum(a.cnt * b.cnt) AS dot FROM bow a JOIN bow b USING (term)
    WHERE b.doc_id IN (SELECT doc_id FROM q{i}) GROUP BY 1, 2) t ON t.x = d.doc_id AND t.y = c.doc_id GROUP BY 1)
  WHERE d2 > 0 ORDER BY -ln({u('doc_id', repr('d' + str(i)))} + {TINY}) / d2, doc_id LIMIT 1))""")
    out.append(f"k0 AS (SELECT q.cluster, b.term, b.cnt::DOUBLE AS w FROM bow b JOIN q{k} q USING (doc_id))")
    out += [bow_round(i) for i in range(1, rounds + 2)]
    return ",\n".join(out)


def corner(j: int, scale: int = 100) -> str:
    return f"(CASE WHEN {u('row_id', repr('corner' + str(j)))} < 0.5 THEN 0 ELSE {scale} END)"


def gauss(j: int) -> str:
    a, b = u("row_id", repr(f"g{j}a")), u("row_id", repr(f"g{j}b"))
    return f"sqrt(-2.0 * ln({a} + {TINY})) * cos(2.0 * pi() * {b})"


IDS = "ids AS (SELECT o_orderkey AS row_id FROM orders)"

SQL: dict[str, str] = {
    "labeled_vectors_parse": f"""SELECT {LI_ID} AS row_id, l_quantity AS x1, l_discount AS x2,
  l_linenumber::DOUBLE AS c1, l_tax AS c2, l_returnflag AS label FROM lineitem""",
    "extract_labeled": f"SELECT {LI_ID} AS row_id, l_quantity AS x1, l_tax AS x2, l_linestatus AS label FROM lineitem",
    "labeled_points_parse": f"""SELECT {LI_ID} AS row_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  l_quantity AS x1, l_discount AS x2, 0.0::DOUBLE AS x3 FROM lineitem""",
    "bow_parse": """SELECT l_orderkey AS doc_id, l_partkey AS term_id, sum(l_quantity::INTEGER)::DOUBLE AS cnt
  FROM lineitem GROUP BY 1, 2""",
    "word_sets_parse": "SELECT DISTINCT l_orderkey AS doc_id, l_partkey AS term_id FROM lineitem",
    "pipe_points_parse": "SELECT o_orderkey AS row_id, o_totalprice AS x, o_custkey::DOUBLE AS y FROM orders",
    "space_points_parse": "SELECT c_custkey, c_acctbal AS x, c_nationkey::DOUBLE AS y FROM customer",
    "space_centers_parse": "SELECT s_suppkey AS cluster, s_acctbal AS x, s_nationkey::DOUBLE AS y FROM supplier",
    "theta_parse": """SELECT max(l_extendedprice) AS t0, -max(l_quantity) / 1e9 AS t1, max(l_discount) AS t2
  FROM lineitem GROUP BY l_returnflag""",
    "vector_functions": f"""WITH {EMB}, {MEANS} SELECT row_id, {rnd('sqrt(list_dot_product(f, f))')} AS norm,
  {rnd('list_dot_product(f, c)')} AS dot, {rnd('list_distance(f, c)')} AS dist, {rnd('list_distance(f, c) ** 2')} AS sq_dist,
  {rnd('list_sum(f) + list_sum(c)')} AS add_total, {rnd('list_sum(f) - list_sum(c)')} AS sub_total,
  {rnd('2.5 * list_sum(f)')} AS scale_total, {rnd('f[1]')} AS first, true AS same, f = c AS other,
  f[1] > 0 OR f = list_transform(f, lambda v: v * 2) AS mixed,
  {rnd('1.0 / (1.0 + exp(-list_dot_product(f, c)))')} AS sig FROM pts JOIN c0 ON c0.cluster = pts.label""",
    "string_functions": """SELECT o_orderkey, replace(o_orderpriority, '-', ';') AS packed, left(o_orderpriority, 1) AS head,
  regexp_replace(o_orderpriority, '[^0-9]', '', 'g') AS digits FROM orders""",
    "vector_sums": f"""WITH {EMB} SELECT label, count(*) AS n, (j - 1)::INTEGER AS pos, {rnd('sum(f[j])')} AS total,
  {rnd('avg(f[j])')} AS mean FROM pts, range(1, 65) t(j) GROUP BY label, j""",
    "count_rows": "SELECT count(*) AS n FROM lineitem",
    "class_counts": "SELECT l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "bow_term_counts": f"WITH {BOW} SELECT doc_id, term, cnt FROM bow",
    "bernoulli_sample": f"SELECT event_id, event_type, value FROM events WHERE {u('event_id', repr('bernoulli'))} < 0.1",
    "first_row": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1",
    "random_row": f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY {u('o_orderkey', repr('row'))}, o_orderkey LIMIT 1",
    "weighted_pick": f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 0
  ORDER BY -ln({u('o_orderkey', repr('pick'))} + {TINY}) / o_totalprice, o_orderkey LIMIT 1""",
    "shuffled_subset": f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {u('o_orderkey', repr('shuffle'))}, o_orderkey LIMIT 1000",
    "feature_subset": "SELECT c_custkey, f::INTEGER AS feature FROM customer, range(0, 6) t(f) QUALIFY row_number() OVER ("
        "PARTITION BY c_custkey ORDER BY " + u("c_custkey", "'feature' || f") + ", f) <= 3",
    "bootstrap": f"WITH {DOC_FEATURES}, {DISTINCT_DOCS}, {bags(3, 0.7)} SELECT row_id, tree_id, in_bag FROM bags",
    "random_sphere": f"""WITH {IDS}, g AS (SELECT row_id, {', '.join(f'{gauss(j)} AS g{j}, {corner(j)} AS k{j}' for j in range(3))} FROM ids)
  SELECT row_id, k0 || '|' || k1 || '|' || k2 AS label,
  {', '.join(rnd(f'g{j} / sqrt(g0 * g0 + g1 * g1 + g2 * g2) * 10.0 + k{j}') + f' AS x{j}' for j in range(3))} FROM g""",
    "random_hypercube": f"""WITH {IDS} SELECT row_id, {corner(0)} || '|' || {corner(1)} AS label, """ + ", ".join(
        rnd(f"({u('row_id', repr(f'h{j}'))} * 2.0 - 1.0) * 10.0 + {corner(j)}") + f" AS x{j}" for j in range(2)) + " FROM ids",
    "labels_1d": f"""WITH {IDS} SELECT row_id, {rnd(u('row_id', repr('x')), 9)} AS x,
  CASE WHEN {u('row_id', repr('x'))} > 0.4 THEN '1' ELSE '-1' END AS label FROM ids""",
    "labels_2d": f"""WITH {IDS} SELECT row_id, {rnd(u('row_id', repr('x')), 9)} AS x, {rnd(u('row_id', repr('y')), 9)} AS y,
  CASE WHEN {u('row_id', repr('x'))} > 0.4 AND {u('row_id', repr('y'))} > 0.3 THEN '1' ELSE '-1' END AS label FROM ids""",
    "kmeans_assign": f"WITH {EMB}, {MEANS}, a AS ({nearest('pts', 'c0')}) SELECT row_id, cluster, {rnd('dist')} AS distance FROM a",
    "kmeans_step": f"""WITH {EMB}, {MEANS}, a AS MATERIALIZED ({nearest('pts', 'c0')}), s AS ({means('a', 64)}),
  z AS (SELECT cluster, count(*) AS n FROM a GROUP BY 1), c AS (SELECT s.cluster, z.n, s.c FROM s JOIN z USING (cluster)) {flat('c', 64, 'n,')}""",
    "kmeans_3_rounds": f"WITH {EMB}, {MEANS}, {lloyd(3, 64)} {flat('c3', 64)}",
    "kmeans_stable": f"""WITH RECURSIVE {EMB}, {MEANS}, s(r, cluster, c) AS (
  SELECT 0, cluster, c FROM c0
  UNION ALL
  SELECT o.r + 1, o.cluster, coalesce(n.c, o.c) FROM s o LEFT JOIN (
    SELECT cluster, list(m ORDER BY j) AS c FROM (SELECT cluster, j, avg(f[j]) AS m FROM ({nearest('pts', 's')}) a,
      range(1, 65) t(j) GROUP BY 1, 2) GROUP BY 1) n ON n.cluster = o.cluster WHERE o.r < 60),
  c AS (SELECT cluster, c FROM s WHERE r = 60), a AS ({nearest('pts', 'c')})
  SELECT row_id, cluster, {rnd('dist')} AS distance FROM a""",
    "kmeans_distinct_centers": f"""WITH pts AS MATERIALIZED (SELECT row_number() OVER () AS rid, {LI_ID} AS row_id, [l_quantity / 10.0, l_tax * 10.0]::DOUBLE[] AS f FROM lineitem),
  c0 AS (SELECT (row_number() OVER (ORDER BY x) - 1)::INTEGER AS cluster, [x, 0.5]::DOUBLE[] AS c FROM (SELECT DISTINCT l_linenumber::DOUBLE AS x FROM lineitem)),
  {lloyd(2, 2)} {flat('c2', 2)}""",
    "kmeans_tol": f"""WITH {ITEMS}, {SMALL}, {lloyd(8, 2)},
  rounds AS ({' UNION ALL '.join(f'SELECT {i} AS i, n.cluster, n.c, list_distance(n.c, o.c) AS moved FROM c{i} n JOIN c{i - 1} o USING (cluster)' for i in range(1, 9))}),
  stop AS (SELECT coalesce(min(i), 8)::INTEGER AS r FROM (SELECT i FROM rounds GROUP BY i HAVING max(moved) <= 0.01)),
  final AS (SELECT cluster, c, r FROM rounds JOIN stop ON i = r) {flat('final', 2, 'r AS rounds,')}""",
    "kmeans_dedupe": f"""WITH {ITEMS}, {SMALL}, uni AS MATERIALIZED (SELECT f, min(row_id) AS row_id, min(rid) AS rid FROM pts GROUP BY 1),
  {lloyd(3, 2, 'uni', keep=False)} {flat('c3', 2)}""",
    "kmeans_assignment_lines": f"""WITH pts AS (SELECT row_number() OVER () AS rid, o_orderkey AS row_id, [o_totalprice / 700.0 + 1e-7,
  date_diff('day', DATE '1992-01-01', o_orderdate::DATE) / 7.0]::DOUBLE[] AS f FROM orders),
  c0(cluster, c) AS (VALUES (1, [50.0, 100.0]::DOUBLE[]), (2, [200.0, 100.0]::DOUBLE[]), (3, [350.0, 300.0]::DOUBLE[])),
  a AS ({nearest('pts', 'c0')}) SELECT printf('%d,%.1f,%.1f', cluster, f[1], f[2]) AS value FROM a""",
    "kmeans_custom_distance": f"""WITH {ITEMS}, {SMALL}, a AS ({nearest('pts', 'c0', 'abs(p.f[1] - c.c[1]) + abs(p.f[2] - c.c[2])')})
  SELECT cluster, count(*) AS n, {rnd('sum(dist)', 3)} AS total FROM a GROUP BY 1""",
    "kmeans_pp_init": f"WITH {EMB}, {pp_init(4, u('row_id', repr('row')) + ', row_id')} {flat('p4', 64)}",
    "kmeans_pp_farthest": f"WITH {EMB}, {pp_init(4, 'row_id', 'far')} {flat('p4', 64)}",
    "kmeans_pp": f"""WITH {EMB}, {pp_init(4, u('row_id', repr('row')) + ', row_id')}, c0 AS (SELECT * FROM p4),
  {lloyd(3, 64, keep=False)}, a AS ({nearest('pts', 'c3')}) SELECT row_id, cluster, {rnd('dist')} AS distance FROM a""",
    "kmeans_pp_2d": f"""WITH {ORDERS2D}, {pp_init(3, u('row_id', repr('row')) + ', row_id')}, c0 AS (SELECT * FROM p3),
  {lloyd(2, 2, keep=False)} {flat('c2', 2)}""",
    "kmeans_bow_step": f"""WITH {BOW}, dn AS MATERIALIZED (SELECT doc_id, sum(cnt * cnt)::DOUBLE AS dn FROM bow GROUP BY 1),
  s AS (SELECT row_number() OVER (ORDER BY lang)::INTEGER AS cluster, min(doc_id) AS doc_id FROM documents GROUP BY lang),
  k0 AS (SELECT s.cluster, b.term, b.cnt::DOUBLE AS w FROM bow b JOIN s USING (doc_id)), {bow_round(1)}
  SELECT cluster, term, {rnd('w')} AS weight FROM k1""",
    "kmeans_pp_bow": f"WITH {bow_pp(4, 2)} SELECT doc_id, cluster, {rnd('sqrt(greatest(d2, 0.0))', 4)} AS distance FROM a3",
    "canopy_euclidean": f"""WITH RECURSIVE {ORDERS2D}, uni AS MATERIALIZED (SELECT min(row_id) AS id, f[1] AS x, f[2] AS y FROM pts GROUP BY f),
  both_ways AS MATERIALIZED (SELECT p.id AS a, q.id AS b FROM uni p JOIN uni q ON q.x BETWEEN p.x - 3.001 AND p.x + 3.001 AND q.y BETWEEN p.y - 3.001 AND p.y + 3.001
    WHERE p.id <> q.id AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 9),
  verts AS (SELECT id FROM uni), {MIS},
  ctr AS MATERIALIZED (SELECT uni.* FROM uni JOIN centers USING (id)),
  near AS MATERIALIZED (SELECT c.id AS c, p.id AS p, (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) AS d2 FROM ctr c JOIN uni p
    ON p.x BETWEEN c.x - 7.001 AND c.x + 7.001 AND p.y BETWEEN c.y - 7.001 AND c.y + 7.001),
  rem AS (SELECT p, min(c) AS rem FROM near WHERE d2 <= 9 GROUP BY 1),
  mem AS (SELECT n.c, n.p FROM near n JOIN rem USING (p) WHERE n.d2 <= 49 AND n.p <> n.c AND n.c <= rem.rem)
  SELECT centers.id AS canopy_id, mem.p AS row_id FROM centers LEFT JOIN mem ON mem.c = centers.id""",
    "canopy_jaccard": f"{jaccard_canopies(0.15)} SELECT canopy_id, doc_id FROM canopies",
    "canopy_lines": f"""{jaccard_canopies(0.5)} SELECT canopy_id, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS value
  FROM canopies GROUP BY 1""",
    "doc_dot_similarity": f"""WITH {BOW} SELECT a.doc_id AS a, b.doc_id AS b, sum(a.cnt * b.cnt)::DOUBLE AS sim FROM bow a JOIN bow b
  ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2""",
    "doc_jaccard_pairs": f"WITH {BOW}, {SETS} SELECT a, b, {rnd('sim')} AS sim FROM jac WHERE sim >= 0.3",
    "doc_near_copies": f"WITH {BOW}, {SETS} SELECT a, b, {rnd('sim')} AS sim FROM jac WHERE sim >= 0.8",
    "doc_dot_large": f"""WITH {BOW} SELECT a.doc_id AS a, b.doc_id AS b, sum(a.cnt * b.cnt)::DOUBLE AS sim FROM bow a JOIN bow b
  ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING sum(a.cnt * b.cnt) >= 2000""",
    "hash_independent_set": f"""WITH RECURSIVE ranked AS MATERIALIZED (SELECT o_orderkey AS v, row_number() OVER (ORDER BY {u('o_orderkey', repr('mis'))}, o_orderkey) AS id,
    lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS w FROM orders),
  verts AS (SELECT id FROM ranked), links AS (SELECT x.id AS a, y.id AS b FROM ranked x JOIN ranked y ON y.v = x.w),
  both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  {MIS} SELECT v FROM ranked WHERE id IN (SELECT id FROM centers)""",
    "first_independent_set": """SELECT o_orderkey AS v FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) % 2 = 1""",
    "hac_single_history": f"{dot_hac('DESC', 8)} {HISTORY}",
    "hac_full_history": f"{merges(forest_first(DOT_EDGES), 'DESC', 1 << 40)} {HISTORY}",
    "hac_order_history": f"{merges(ORDER_EDGES, 'DESC', 1 << 40)} {HISTORY}",
    "hac_order_edges": f"{merges(ORDER_EDGES, 'DESC', 1 << 40)} SELECT count(*) AS n_merges, sum(sim) AS total FROM ({HISTORY})",
    "hac_memberships": f"{dot_hac('DESC', 8)} SELECT step, cl AS cluster_id, doc AS doc_id FROM st WHERE step IN (0, 3, 8)",
    "hac_min_history": f"{dot_hac('ASC', 8)} {HISTORY}",
    "hac_history_line": f"""{dot_hac('DESC', 8)} SELECT string_agg('[' || old_id || '; ' || new_id || ']', '' ORDER BY step) AS value
  FROM ({HISTORY})""",
    "hac_history_lines": f"""{dot_hac('DESC', 8)} SELECT step, '[' || old_id || '; ' || new_id || ']' AS value FROM ({HISTORY})""",
    "hac_level_changes": f"""{dot_hac('DESC', 8)} SELECT s.step, s.cl AS cluster_id, s.doc AS doc_id FROM st s
  JOIN st p ON p.doc = s.doc AND p.step = s.step - 1 WHERE s.cl <> p.cl""",
    "canopy_max_rounds": f"""{jaccard_canopies(0.15)}, first_two AS (SELECT canopy_id, doc_id FROM canopies
    WHERE canopy_id IN (SELECT id FROM centers ORDER BY id LIMIT 2))
  SELECT * FROM first_two UNION ALL SELECT NULL, doc_id FROM sz WHERE doc_id NOT IN (SELECT doc_id FROM first_two)""",
    "sampled_lines_file": f"SELECT event_id || ',' || event_type AS value FROM events WHERE {u('event_id', repr('bernoulli'))} < 0.1",
    "generated_lines_file": f"""WITH {IDS}, g AS (SELECT row_id, {', '.join(f'{gauss(j)} AS g{j}, {corner(j)} AS k{j}' for j in range(3))} FROM ids)
  SELECT {', '.join(rnd(f'g{j} / sqrt(g0 * g0 + g1 * g1 + g2 * g2) * 10.0 + k{j}') + f' AS x{j}' for j in range(3))}, k2::DOUBLE AS c2,
  k0 || '|' || k1 || '|' || k2 || '|' AS label FROM g""",
    "scored_lines_file": f"""WITH {ITEMS}, {theta_rounds(3, 1.0)} SELECT {rnd(PROB)} AS probability, y AS label,
  {rnd('f[1]')} AS x1, {rnd('f[2]')} AS x2 FROM pts, t3 t""",
    "cluster_lines_file": f"""WITH {ITEMS}, m AS (SELECT row_id // 10 AS k, string_agg(f[1] || ', ' || f[2], ', ' ORDER BY row_id, f) AS v
  FROM pts GROUP BY 1) SELECT o_totalprice::DOUBLE || ', ' || substr(o_orderpriority, 1, 1)::DOUBLE || coalesce(', ' || v, '') AS value
  FROM orders LEFT JOIN m ON k = o_orderkey""",
    "cluster_folders": f"""WITH {ORDERS2D}, c0 AS (SELECT cluster, [round(avg(f[1]), 3), round(avg(f[2]), 3)] AS c FROM (
    SELECT substr(o_orderpriority, 1, 1)::INTEGER AS cluster, f FROM orders JOIN pts ON row_id = o_orderkey) GROUP BY 1),
  a AS ({nearest('pts', 'c0')}) SELECT row_id, a.cluster, {rnd('f[1]', 3)} AS x0, {rnd('f[2]', 3)} AS x1,
  {rnd('c[1]', 3)} AS c0, {rnd('c[2]', 3)} AS c1 FROM a JOIN c0 USING (cluster)""",
    "hac_membership": f"{dot_hac('DESC', 8)} SELECT cl AS cluster_id, doc AS doc_id FROM st WHERE step = 8",
    "hac_centroid": f"""WITH RECURSIVE sp AS (SELECT o_custkey AS c_custkey, sum(o_totalprice) AS spent, count(*) AS k FROM orders GROUP BY 1),
  pts AS MATERIALIZED (SELECT c_nationkey::BIGINT AS id, avg(c_acctbal) AS x, sum(spent) / sum(k) / 10.0 AS y FROM customer JOIN sp USING (c_custkey) GROUP BY 1),
  s(step, id, n, tx, ty, a, b, d) AS (
    SELECT 0, id, 1::BIGINT, x, y, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM pts
    UNION ALL
    SELECT * FROM (
      WITH m AS (SELECT p.step, p.id AS ia, q.id AS ib, sqrt((p.tx / p.n - q.tx / q.n) ** 2 + (p.ty / p.n - q.ty / q.n) ** 2) AS d,
          p.n + q.n AS n, p.tx + q.tx AS tx, p.ty + q.ty AS ty FROM s p JOIN s q ON p.id < q.id ORDER BY d, ia, ib LIMIT 1)
      SELECT m.step + 1, s.id, s.n, s.tx, s.ty, NULL, NULL, NULL FROM s, m WHERE s.id <> m.ia AND s.id <> m.ib
      UNION ALL SELECT m.step + 1, (SELECT max(id) + 1 FROM pts) + m.step, m.n, m.tx, m.ty, m.ia, m.ib, m.d FROM m))
  SELECT step::INTEGER AS step, a, b, {rnd('d', 4)} AS distance, n FROM s WHERE a IS NOT NULL""",
    "logreg_theta": f"WITH {ITEMS}, {theta_rounds(3, 1.0)} {theta_flat('t3')}",
    "logreg_theta_sgd": f"WITH RECURSIVE {ITEMS}, {SGD} {theta_flat('(SELECT a, b FROM t ORDER BY i DESC LIMIT 1)')}",
    "logreg_score": f"""WITH {ITEMS}, {theta_rounds(3, 1.0)} SELECT row_id, y AS label, {rnd(PROB)} AS probability,
  CASE WHEN {PROB} >= 0.5 THEN 1 ELSE 0 END AS prediction FROM pts, t3 t""",
    "logreg_accuracy": f"""WITH {ITEMS}, {theta_rounds(3, 1.0)} SELECT count(*) FILTER ((y = 1) = ({PROB} >= 0.5)) AS n_correct,
  count(*) AS n FROM pts, t3 t""",
    "entropy_by_group": f"""WITH c AS (SELECT l_linenumber, l_returnflag, count(*) AS c FROM lineitem GROUP BY 1, 2),
  p AS (SELECT l_linenumber, c, sum(c) OVER (PARTITION BY l_linenumber) AS n FROM c)
  SELECT l_linenumber, any_value(n)::BIGINT AS n, {rnd('-sum(c / n::DOUBLE * log2(c / n::DOUBLE))')} AS entropy FROM p GROUP BY 1""",
    "split_gain": f"""WITH {DOC_FEATURES}, c AS (SELECT f[4] AS g, count(*) FILTER (f[1] <= 1500 AND label = 0) AS l0,
  count(*) FILTER (f[1] <= 1500 AND label = 1) AS l1, count(*) FILTER (f[1] > 1500 AND label = 0) AS r0,
  count(*) FILTER (f[1] > 1500 AND label = 1) AS r1 FROM docs GROUP BY 1)
  SELECT g, l0 + l1 AS n_left, r0 + r1 AS n_right, {rnd(gain_sql(['l0', 'l1'], ['r0', 'r1']))} AS gain FROM c""",
    "best_split": "WITH li AS (SELECT l_linestatus, l_returnflag AS y, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS v, "
        "unnest([0, 1, 2, 3]) AS f FROM lineitem), h AS (SELECT l_linestatus, f, v, " + ", ".join(
            f"count(*) FILTER (y = '{c}') AS k{i}" for i, c in enumerate("ANR")) + " FROM li GROUP BY 1, 2, 3), "
        "r AS (SELECT l_linestatus, f, v, " + ", ".join(
            f"sum(k{i}) OVER o AS l{i}, sum(k{i}) OVER p - sum(k{i}) OVER o AS q{i}" for i in range(3)) +
        " FROM h WINDOW o AS (PARTITION BY l_linestatus, f ORDER BY v), p AS (PARTITION BY l_linestatus, f)), "
        "g AS (SELECT *, round(" + gain_sql(["l0", "l1", "l2"], ["q0", "q1", "q2"]) + ", 9) AS gain FROM r) "
        "SELECT l_linestatus, f AS feature, v AS threshold, gain + 0.0 AS gain FROM g "
        "QUALIFY row_number() OVER (PARTITION BY l_linestatus ORDER BY gain DESC, f, v DESC) = 1",
    "tree_depth_2": f"""WITH {DOC_FEATURES}, {tree_levels('(SELECT 1 AS tree_id, f, label FROM docs)', 2, 4)}
  SELECT node_id, feature, threshold, n, prediction, n_prediction FROM nodes""",
    "forest_nodes": f"WITH {FOREST} SELECT tree_id, node_id, feature, threshold, n, prediction, n_prediction FROM nodes",
    "bayes_predict": f"""WITH {BOW}, counts AS MATERIALIZED (SELECT term, quality AS label, sum(cnt)::DOUBLE AS c FROM bow JOIN labels USING (doc_id) GROUP BY 1, 2),
  voc AS MATERIALIZED (SELECT DISTINCT term FROM counts), known AS MATERIALIZED (SELECT * FROM bow SEMI JOIN voc USING (term)),
  classes AS (SELECT label, ln(k / sum(k) OVER ()) AS prior, coalesce(total, 0) + (SELECT count(*) FROM voc) AS mass
    FROM (SELECT quality AS label, count(*) AS k FROM labels GROUP BY 1) LEFT JOIN (SELECT label, sum(c) AS total FROM counts GROUP BY 1) USING (label)),
  s AS (SELECT d.doc_id, l.label, l.prior + coalesce(sum(k.cnt * ln((coalesce(c.c, 0) + 1) / l.mass)), 0) AS score
    FROM (SELECT DISTINCT doc_id FROM bow) d CROSS JOIN classes l LEFT JOIN known k ON k.doc_id = d.doc_id
    LEFT JOIN counts c ON c.term = k.term AND c.label = l.label GROUP BY d.doc_id, l.label, l.prior)
  SELECT doc_id, label AS prediction, {rnd('score', 4)} AS score FROM s
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, label) = 1""",
    "forest_scores": f"WITH {FOREST}, {route(EVERY_DOC, 2)}, {VOTES} SELECT row_id, prediction, {rnd('share')} AS share FROM pred",
    "forest_binned_nodes": f"WITH {BINNED_FOREST} SELECT tree_id, node_id, feature, threshold, n, prediction, n_prediction FROM edged",
    "tree_binned": f"WITH {BINNED_TREE} SELECT node_id, feature, threshold, n, prediction, n_prediction FROM edged",
    "forest_lineitem": f"WITH {LINEITEM}, {tree_levels('bags WHERE in_bag', 3, 2, 4, FLAGS)}, {route('(SELECT * FROM bags WHERE NOT in_bag)', 3)} {OOB_BY_TREE}",
    "forest_lineitem_binned": f"WITH {LINEITEM}, {binned('bags', 'row_id, label, tree_id, in_bag, f AS raw', 64)}, "
    f"{tree_levels('inbins WHERE in_bag', 3, 2, 4, FLAGS)}, {route('(SELECT * FROM inbins WHERE NOT in_bag)', 3)} {OOB_BY_TREE}",
    "forest_votes": f"WITH {FOREST}, {route(EVERY_DOC, 2)}, {VOTES} SELECT row_id, label, {rnd('share')} AS share FROM votes",
    "forest_predict": f"WITH {FOREST}, {route(EVERY_DOC, 2)}, {VOTES} SELECT row_id, prediction, {rnd('share')} AS share FROM pred",
    "oob_error": f"""WITH {FOREST}, {route('(SELECT row_id, f, label, tree_id FROM bags WHERE NOT in_bag)', 2)}
  SELECT {rnd('avg(e)')} AS error FROM (SELECT tree_id, avg(CASE WHEN prediction <> label THEN 1.0 ELSE 0.0 END) AS e FROM leafs GROUP BY 1)""",
    "confusion": f"""WITH {FOREST}, {route(ALL_TREES, 2)}, {VOTES} SELECT label, prediction, count(*) AS n
  FROM pred JOIN docs USING (row_id) GROUP BY 1, 2""",
}
