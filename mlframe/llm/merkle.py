"""Merkle manifest of a dataset: a hash tree over its rows, and proofs by a recursive query that climbs it.

Rows are leaves, in order of doc_id within their language; every FANOUT consecutive nodes have one parent.  The trees of the
languages end in subroots, over which a last tree of the same kind gives the root.  Built levels are kept as node rows, each
with the place it has under its parent.  A recursive query starts at every leaf with the hash of the row as found, and at each
step appends the siblings and folds them in.

Nulls: a null column is hashed as ``-``; a null doc_id comes first in its language and a null language first of all.  Rows that repeat
a doc_id follow the order of their leaf hashes, and equal rows are leaves of their own, with each their place and proof.
An empty table has no tree: no rows, root None.  Columns besides the hashed ones make no difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mlframe.runtime import discard, durable

FANOUT = 8
# The rows of a node are repeated for each stretch of so many leaves below it, so no key of the climb's joins is held by more.
STRETCH = 4096
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # the number of the tree over the subroots
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the values in turn, each as its UTF-8 length, a colon and itself; a null as ``-``."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(part, columns)).cast("binary"), 256)


def node_hash(kids: str) -> Column:
    """SHA-256 of an array of digests in turn, as hex text; digests are kept as 32 bytes."""
    return F.unhex(F.sha2(F.lower(F.array_join(F.transform(kids, F.hex), "")).cast("binary"), 256))


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows``, written, with ``g`` (place in the order of group and ``order``, from 0), ``place`` in its group and group size ``n``.

    Rows are range-partitioned and numbered inside each partition; what lies before a partition or a group is a sum over one
    row per partition and group.  A value that very many rows share is split by a last number without meaning.
    """
    keys = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("_tie")]
    dealt = durable(rows.withColumn("_tie", F.monotonically_increasing_id())
                    .repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    cells = durable(dealt.groupBy("_part", group).agg(F.count("*").alias("_rows")))
    # one number per partition, then one row per partition and group inside it: no window holds more than one partition's groups
    parts = cells.groupBy("_part").agg(F.sum("_rows").alias("_all"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_all").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(F.col(group).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.join(parts, "_part").withColumn("_start", F.col("_before") + F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    groups = cells.groupBy(group).agg(F.min("_start").alias("_first"), F.sum("_rows").alias("n"))
    cells = cells.alias("c").join(groups.alias("s"), F.col(f"c.{group}").eqNullSafe(F.col(f"s.{group}"))) \
        .select("_part", F.col(f"c.{group}").alias("_group"), "_start", "_first", "n")
    row = F.row_number().over(Window.partitionBy("_part", group).orderBy(*keys)) - 1
    own = dealt.withColumn("_row", row.cast("long"))
    out = own.join(cells, (own["_part"] == cells["_part"]) & own[group].eqNullSafe(cells["_group"])) \
        .select(*rows.columns, (F.col("_start") + F.col("_row")).alias("g"),
                (F.col("_start") + F.col("_row") - F.col("_first")).alias("place"), "n")
    numbers = durable(out)
    discard(dealt)
    return numbers


def _levels(nodes: DataFrame, most: int, level: int = 1) -> tuple[list[DataFrame], DataFrame]:
    """Build the levels over ``nodes (tree, idx, n, digest, lo, hi)``: tables of inner nodes with their children, and the tops.

    ``most`` is the largest number of nodes of one tree.  ``lo`` and ``hi`` are the first and last leaf below a node.
    """
    built, tops = [], [nodes.where("n = 1")]
    live = nodes.where("n > 1")
    while most > 1:
        kids = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        table = durable(
            live.groupBy("tree", F.expr(f"idx div {FANOUT}").alias("up"))
            .agg(kids.alias("kids"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("n").alias("n"))
            .select("tree", F.lit(level).alias("level"), F.col("up").alias("idx"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
                    F.transform("kids", lambda k: k["digest"]).alias("kids"), "lo", "hi")
            .withColumn("digest", node_hash("kids")))
        built.append(table)
        tops.append(table.where("n = 1").select(*nodes.columns))
        live = table.where("n > 1").select(*nodes.columns)
        most = -(-most // FANOUT)
        level += 1
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return built, out


class Manifest:
    """A built tree: ``leaves`` (the rows' keys with g, place, n, tree and digest), node rows, and the root as hex text (None: no rows)."""

    def __init__(self, leaves: DataFrame, nodes: DataFrame, root: str | None):
        self.leaves, self.nodes, self.root = leaves, nodes, root


def build(leaves: DataFrame) -> Manifest:
    """The tree over ``leaves (lang, doc_id, leaf, ...)``; ``leaf`` is hex text.

    Node rows: ``tree, level, idx, kids, digest`` with ``up_tree, up_level, up_idx, pos``, the parent and the place under it
    (null at the root), and ``lo, hi``.
    """
    spark = leaves.sparkSession
    ordered = numbered(leaves, "lang", "doc_id", "leaf")
    most = ordered.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(ordered.withColumn("tree", F.lit(0).cast("long")), None, None)
    start = ordered.select(F.col("lang"), F.col("place").alias("idx"), "n", F.unhex("leaf").alias("digest"), F.col("g").alias("lo"), F.col("g").alias("hi"))
    # a language's tree is named by its first leaf, so its number needs no join: g - place
    start = start.withColumn("tree", F.col("lo") - F.col("idx")).drop("lang").select("tree", "idx", "n", "digest", "lo", "hi")
    low, subroots = _levels(start, most)
    # subroots in the order of their languages, which is that of their first leaves
    ranked = numbered(subroots.select("tree", "digest", "lo", "hi").withColumn("all", F.lit(0)), "all", "lo")
    n_trees = ranked.count()
    top, roots = _levels(ranked.select(F.lit(TOP).cast("long").alias("tree"), F.col("place").alias("idx"), "n", "digest", "lo", "hi"), n_trees)
    root = roots.select(F.lower(F.hex("digest"))).first()[0]
    place = ranked.select(F.col("tree").alias("of"), F.col("place").alias("rank"))
    up = lambda c: F.expr(f"{c} div {FANOUT}")
    nodes = None
    for table, is_top in [(t, False) for t in low] + [(t, True) for t in top]:
        single = F.col("n") == 1
        linked = table.withColumn("up_tree", F.when(~single, F.col("tree"))).withColumn("up_level", F.when(~single, F.col("level") + 1)) \
            .withColumn("up_idx", F.when(~single, up("idx"))).withColumn("pos", F.when(~single, (F.col("idx") % FANOUT).cast("int")))
        if not is_top and n_trees > 1:
            linked = linked.join(place, single & (F.col("tree") == F.col("of")), "left") \
                .withColumn("up_tree", F.when(single, F.lit(TOP).cast("long")).otherwise(F.col("up_tree"))) \
                .withColumn("up_level", F.when(single, F.lit(1)).otherwise(F.col("up_level"))) \
                .withColumn("up_idx", F.when(single, up("rank")).otherwise(F.col("up_idx"))) \
                .withColumn("pos", F.when(single, (F.col("rank") % FANOUT).cast("int")).otherwise(F.col("pos"))).drop("of", "rank")
        linked = linked.withColumn("ends", single).drop("n")
        nodes = linked if nodes is None else nodes.unionByName(linked)
    # where the climb of a leaf starts: its parent in its own tree, or, if it is the only leaf, its place in the tree over the subroots
    own = ordered.withColumn("tree", F.col("g") - F.col("place"))
    alone = F.col("n") == 1
    own = own.join(place, alone & (F.col("tree") == F.col("of")), "left")
    has_top = F.lit(n_trees > 1)
    own = own.withColumn("start_tree", F.when(~alone, F.col("tree")).when(has_top, F.lit(TOP).cast("long"))) \
        .withColumn("start_idx", F.when(~alone, up("place")).when(has_top, up("rank"))) \
        .withColumn("start_pos", F.when(~alone, F.col("place") % FANOUT).when(has_top, F.col("rank") % FANOUT).cast("int")).drop("of", "rank")
    empty = spark.createDataFrame([], "tree long, level int, idx long, kids array<binary>, lo long, hi long, digest binary, up_tree long, up_level int, "
                                      "up_idx long, pos int, ends boolean")
    tree = Manifest(durable(own), durable(nodes if nodes is not None else empty), root)
    for table in [ordered, ranked, *low, *top]:
        discard(table)
    return tree


CLIMB = f"""
WITH RECURSIVE climb(g, stretch, step, tree, level, idx, pos, folded, siblings, top) AS (
  SELECT g, g div {STRETCH}, 0, start_tree, 1, start_idx, start_pos, found, X'', CASE WHEN n = 1 THEN unhex(leaf) END FROM {{leaves}}
  UNION ALL
  SELECT /*+ MERGE(r) */ c.g, c.stretch, c.step + 1, r.up_tree, r.up_level, r.up_idx, r.pos,
         unhex(sha2(CAST(lower(concat(array_join(slice(r.kids, 1, c.pos), ''), hex(c.folded), array_join(slice(r.kids, c.pos + 2, {FANOUT}), ''))) AS BINARY), 256)),
         unhex(concat(array_join(slice(r.kids, 1, c.pos), ''), array_join(slice(r.kids, c.pos + 2, {FANOUT}), ''))),
         CASE WHEN r.ends AND r.tree <> {TOP} THEN r.digest END
  FROM climb c JOIN {{nodes}} r ON c.stretch = r.stretch AND c.tree = r.tree AND c.level = r.level AND c.idx = r.idx
)
SELECT g, step, CASE WHEN tree IS NULL THEN folded END AS folded, siblings, top FROM climb
"""


def climb(manifest: Manifest, with_proof: bool = True) -> DataFrame:
    """One row per leaf of ``manifest.leaves``, which must carry ``found``, the leaf hash of the row as found (32 bytes):
    ``g, subroot, folded_root, proof_sha256`` and, if asked for, ``proof``, the siblings' digests in turn.

    Each step of the recursive query joins all leaves with the node rows, by a shuffle at every size, as node rows have no bound.  The rows of a node are dealt over stretches of leaves,
    so the upper nodes, which all leaves meet, are no hot keys.  Every step returns only its own siblings; they are put
    in a row at the end.
    """
    spark = manifest.leaves.sparkSession
    stretches = F.explode(F.sequence(F.expr(f"lo div {STRETCH}"), F.expr(f"hi div {STRETCH}")))
    nodes = manifest.nodes.withColumn("stretch", stretches).withColumn("kids", F.transform("kids", F.hex)).drop("lo", "hi")
    parts = F.sort_array(F.collect_list(F.struct("step", "siblings")))
    proof = F.aggregate(parts, F.unhex(F.lit("")), lambda acc, p: F.concat(acc, p["siblings"]))
    steps = spark.sql(CLIMB, leaves=manifest.leaves, nodes=nodes)
    out = steps.groupBy("g").agg(F.max("folded").alias("folded_root"), F.max("top").alias("subroot"), proof.alias("proof")) \
        .withColumn("proof_sha256", F.sha2(F.lower(F.hex("proof")).cast("binary"), 256))
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")  # a limit for mistakes in queries; this one ends at the root
    try:
        return durable(out if with_proof else out.drop("proof"))
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def documents_as_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf`` and ``found``, the hash of the row as found: text in lower case (A-Z) where 3 divides crc32 of the id."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    columns = {c: F.col(c) for c in COLUMNS}
    tampered = columns | {"text": F.when(hit, F.translate(text, UPPER, LOWER)).otherwise(text)}
    return docs.select(doc_id.alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_hash(list(columns.values())).alias("leaf"),
                       F.unhex(leaf_hash(list(tampered.values()))).alias("found"))


def query(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every document."""
    tree = build(documents_as_leaves(docs))
    if tree.root is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    folded = climb(tree, with_proof=False)
    text = lambda c: F.lower(F.hex(c))
    return tree.leaves.join(folded, "g").select(
        "doc_id", "leaf", text("subroot").alias("subroot"), F.lit(tree.root).alias("root"),
        "proof_sha256", text("folded_root").alias("folded_root"),
        (text("folded_root") == F.lit(tree.root)).alias("verified"))


# The same in DuckDB: levels by a recursive query, a second one climbs; crc32 by folds over bytes and bits.
SQL = """
WITH RECURSIVE
rows_ AS (
  SELECT row_number() OVER () AS r, doc_id, lang, text, source, n_chars,
    CASE WHEN doc_id IS NULL THEN false ELSE xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 3 = 0 END AS hit FROM documents),
parts AS (
  SELECT r, doc_id, lang, hit,
    COALESCE(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-')
      || COALESCE(strlen(lang) || ':' || lang, '-') || COALESCE(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    COALESCE(strlen(text) || ':' || text, '-') AS body,
    COALESCE(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lower_body FROM rows_),
hashed AS (
  SELECT r, doc_id, lang, sha256(head || body) AS leaf, sha256(head || CASE WHEN hit THEN lower_body ELSE body END) AS found FROM parts),
leaves AS (
  SELECT r, doc_id, leaf, found, COALESCE('=' || lang, '') AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx FROM hashed),
levels(tree, level, idx, digest, n) AS (
  SELECT tree, 0, idx, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 7) // 8
  FROM levels WHERE n > 1 GROUP BY tree, level, idx // 8),
subroots AS (
  SELECT tree, max(level) AS height, max_by(digest, level) AS digest, row_number() OVER (ORDER BY tree) - 1 AS rank FROM levels GROUP BY tree),
tops(level, idx, digest, n) AS (
  SELECT 0, rank, digest, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 7) // 8 FROM tops WHERE n > 1 GROUP BY level, idx // 8),
top AS (SELECT max_by(digest, level) AS root, max(level) AS height FROM tops),
every AS (
  SELECT tree, level, idx, digest FROM levels UNION ALL SELECT NULL, level, idx, digest FROM tops),
runs AS (SELECT tree, level, idx // 8 AS up, list(digest ORDER BY idx) AS kids FROM every GROUP BY tree, level, idx // 8),
climb(r, tree, own, level, idx, folded, proof) AS (
  SELECT r, tree, tree, 0, idx, found, '' FROM leaves
  UNION ALL
  SELECT c.r, n.tree, c.own, n.level, n.idx, n.folded, n.proof FROM climb c
  CROSS JOIN top
  LEFT JOIN subroots s ON s.tree = c.own
  LEFT JOIN runs k ON k.tree IS NOT DISTINCT FROM c.tree AND k.level = c.level AND k.up = c.idx // 8,
  LATERAL (SELECT
    CASE WHEN c.tree IS NOT NULL AND c.level = s.height THEN NULL ELSE c.tree END AS tree,
    CASE WHEN c.tree IS NOT NULL AND c.level = s.height THEN 0 ELSE c.level + 1 END AS level,
    CASE WHEN c.tree IS NOT NULL AND c.level = s.height THEN s.rank ELSE c.idx // 8 END AS idx,
    CASE WHEN c.tree IS NOT NULL AND c.level = s.height THEN c.folded
      ELSE sha256(array_to_string(k.kids[1:c.idx % 8], '') || c.folded || array_to_string(k.kids[c.idx % 8 + 2:], '')) END AS folded,
    CASE WHEN c.tree IS NOT NULL AND c.level = s.height THEN c.proof
      ELSE c.proof || array_to_string(k.kids[1:c.idx % 8], '') || array_to_string(k.kids[c.idx % 8 + 2:], '') END AS proof) n
  WHERE c.tree IS NOT NULL OR c.level < top.height),
ends AS (SELECT r, own, folded, proof FROM climb, top WHERE climb.tree IS NULL AND climb.level = top.height)
SELECT l.doc_id, l.leaf, s.digest AS subroot, top.root AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = top.root AS verified
FROM leaves l JOIN ends e ON e.r = l.r JOIN subroots s ON s.tree = l.tree CROSS JOIN top
"""
