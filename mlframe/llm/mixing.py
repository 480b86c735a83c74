"""Mixing sources to target weights with a time-varying curriculum.  DataFrame functions only.

A source's share of the token stream follows a schedule over training time.  The schedule is integrated to cumulative token
demand; a document copy whose words stand at some point of its source's stream gets the training time at which the demand
reaches that point, and copies are range-sorted by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mlframe.llm.common import word_count
from mlframe.runtime import durable

# Weights and schedules go to the sources in code-point order, null last, repeating.
WEIGHTS = (5, 2, 1)
# Relative rate of a source at equally spaced times from 0 to 1, linear in between.
SCHEDULES = ((1.0, 1.0, 1.0), (0.5, 1.0, 1.5), (1.5, 1.0, 0.5))
MOST_REPEATS = 3
SEED = 7


def _sources(sized: DataFrame) -> DataFrame:
    """One row per source: rank, weight, size, target.  Targets are poured by weight; a source stops at its limit.

    With sources in the order of limit / weight, the first source that stays below its limit gives the level of all later
    ones.  Only the list of sources is ordered here, never their documents.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rnk") % len(WEIGHTS) + 1).cast("int")).cast("long")
    fill = Window.orderBy(F.col("room") / F.col("weight"), "rnk")
    every = Window.partitionBy()
    ranked = per.withColumn("rnk", rank).withColumn("weight", weight).withColumn("room", MOST_REPEATS * F.col("source_size"))
    poured = ranked.withColumn("total", F.sum("source_size").over(every)) \
        .withColumn("before", F.coalesce(F.sum("room").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("rest", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("left", F.col("total") - F.col("before")) \
        .withColumn("below", F.col("left") * F.col("weight") <= F.col("room") * F.col("rest"))
    level = F.min(F.when(F.col("below"), F.struct("before", "rest", "left"))).over(every)
    share = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.rest")
    return poured.withColumn("level", level) \
        .withColumn("target", F.when(F.col("level").isNull() | (F.col("before") < F.col("level.before")), F.col("room").cast("double"))
                    .otherwise(F.least(share, F.col("room").cast("double")))) \
        .withColumn("budget", F.round("target").cast("long")) \
        .withColumn("passes", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)) \
        .withColumn("rem", F.col("budget") - F.col("passes") * F.col("source_size")) \
        .select("source", "rnk", "source_size", "target", "passes", "rem")


def when_reached(u: str, kind: str) -> str:
    """SQL for the time at which a source of schedule ``kind`` has given the share ``u`` of its words."""
    out = []
    for k, rates in enumerate(SCHEDULES):
        step = 1.0 / (len(rates) - 1)
        area = [0.0]
        for a, b in zip(rates, rates[1:]):
            area.append(area[-1] + (a + b) / 2 * step)
        legs = []
        for j, (a, b) in enumerate(zip(rates, rates[1:])):
            need = f"({u} * {area[-1]!r}e0 - {area[j]!r}e0)"
            t = f"{j * step!r}e0 + 2e0 * {need} / ({a!r}e0 + sqrt(greatest(0e0, {a * a!r}e0 + {2 * (b - a) / step!r}e0 * {need})))"
            legs.append(f"WHEN {u} * {area[-1]!r}e0 <= {area[j + 1]!r}e0 THEN {t}")
        out.append(f"WHEN {kind} = {k} THEN CASE {' '.join(legs)} ELSE 1e0 END")
    return f"CASE {' '.join(out)} END"


def allocate(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken, before, rnk, whole``.

    Every source is passed over in a fixed random order as often as its target holds its size; the last pass stops where
    the target is reached.  What is left there is filled with at most one document of each power-of-two size class, largest
    first, so whole documents come within a few words of the target.  Sums over the order use cells of its leading digits,
    so a source with a third of all rows is many groups.

    Null and empty texts have size 0 and are taken 0 words of.  A null source is a source, the last.  Rows that repeat a doc_id are
    separate documents.  Null ids share one place in the order.  ``keep``: columns of ``docs`` to carry along.
    """
    keep = keep or []
    sized = docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{SEED}")).cast("binary")).alias("key"),
        *([F.struct(*keep).alias("row")] if keep else []))
    src = _sources(sized.select("source", "size"))
    placed = sized.withColumnRenamed("source", "s").join(src, F.col("s").eqNullSafe(F.col("source"))).drop("s") \
        .withColumn("cell", F.substring("key", 1, 3))
    cells = placed.groupBy("rnk", "cell").agg(F.sum("size").alias("n")) \
        .withColumn("start", F.coalesce(F.sum("n").over(Window.partitionBy("rnk").orderBy("cell").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    order = Window.partitionBy("rnk", "cell").orderBy("key", "size")
    laid = placed.join(cells, ["rnk", "cell"]) \
        .withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(order.rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("nth", F.row_number().over(order)) \
        .withColumn("in_last", F.col("before") + F.col("size") <= F.col("rem"))
    got = laid.groupBy("rnk").agg(F.sum(F.when(F.col("in_last"), F.col("size")).otherwise(0)).alias("got"),
                                  F.max("rem").alias("r"))
    short = got.select("rnk", (F.col("r") - F.col("got")).alias("gap"))
    # a gap goes to each slice of its source, so the candidates of a large source are many groups before they are reduced
    slot = F.substring("cell", 1, 2)
    spread = F.explode(F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))))
    gaps = short.where("gap > 0").select("rnk", "gap", spread.alias("slot"))
    offer = laid.where(~F.col("in_last") & (F.col("size") > 0)).withColumn("slot", slot) \
        .join(gaps, ["rnk", "slot"]).where("size <= gap")
    first = offer.groupBy("rnk", "slot", "gap", F.length(F.bin("size")).alias("class")) \
        .agg(F.min(F.struct((-F.col("size")).alias("neg"), "key", "nth", "cell")).alias("b"))
    best = first.groupBy("rnk", "gap", "class").agg(F.min("b").alias("b"))
    state = "struct<left bigint, took array<struct<cell:string,nth:int>>>"
    fill = best.groupBy("rnk", "gap").agg(F.sort_array(F.collect_list("b")).alias("bs")).select(
        "rnk", F.explode(F.aggregate(
            "bs", F.struct(F.col("gap").alias("left"), F.array().alias("took")).cast(state),
            lambda s, b: F.when(-b["neg"] <= s["left"], F.struct(
                (s["left"] + b["neg"]).alias("left"),
                F.concat(s["took"], F.array(F.struct(b["cell"].alias("cell"), b["nth"].alias("nth")))).alias("took")))
            .otherwise(s), lambda s: s["took"])).alias("t")) \
        .select("rnk", "t.cell", "t.nth", F.lit(True).alias("extra"))
    last = (F.col("in_last") & (F.col("size") > 0)) | F.coalesce("extra", F.lit(False))
    return laid.join(fill, ["rnk", "cell", "nth"], "left") \
        .withColumn("copies", F.when(F.col("size") > 0, F.col("passes")).otherwise(0) + last.cast("int")) \
        .withColumn("taken", F.col("size") * F.col("copies")) \
        .withColumn("whole", F.col("passes") * F.col("source_size") + F.col("rem")) \
        .select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "before", "rnk", "whole",
                *(["row"] if keep else []))


def _position(copy: Column) -> tuple[Column, Column]:
    """The training time in 0..1 of a copy (from 0), as an expression over ``share`` and ``kind``, and the share."""
    at = F.col("before") + copy * F.col("source_size") + F.col("size") / 2.0
    return F.expr(when_reached("share", "kind")), F.least(F.lit(1.0), at / F.nullif(F.col("whole"), F.lit(0)))


def curriculum(docs: DataFrame) -> DataFrame:
    """The mixed corpus in training order: the rows of ``docs``, each as often as it is taken, all columns kept.

    Range-sorted by training position; ties of position by doc_id.  Texts are written once with a row number, so that they move
    twice in all: to their place in the mix, and into training order.
    """
    names = docs.columns
    held = durable(docs.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("rid")))
    slim = held.select("row.doc_id", "row.source", "row.text", "rid")
    rows = allocate(slim, ["rid"]).where("copies > 0").withColumn("rid", F.col("row.rid")).drop("row").join(held, "rid") \
        .withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    expr, share = _position(F.col("copy"))
    return rows.withColumn("share", share).withColumn("kind", F.col("rnk") % len(SCHEDULES)) \
        .select("row", expr.alias("position"), F.col("doc_id").alias("id")) \
        .repartitionByRange("position", "id").sortWithinPartitions("position", "id") \
        .select(*[F.col("row").getField(c).alias(c) for c in names])


def query(docs: DataFrame) -> DataFrame:
    expr, share = _position(F.lit(0))
    return allocate(docs).withColumn("share", share).withColumn("kind", F.col("rnk") % len(SCHEDULES)).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.when(F.col("taken") > 0, F.round(expr, 6)).alias("first_position"))


SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}') AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM sized GROUP BY source),
ranked AS (
  SELECT *, list_value({', '.join(map(str, WEIGHTS))})[rnk % {len(WEIGHTS)} + 1]::BIGINT AS weight, {MOST_REPEATS} * source_size AS room FROM per),
poured AS (
  SELECT *, coalesce(sum(room) OVER (ORDER BY room / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         (sum(weight) OVER (ORDER BY room / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest,
         (sum(source_size) OVER ())::BIGINT AS total FROM ranked),
level AS (
  SELECT before AS b0, rest AS r0, total - before AS l0 FROM poured WHERE (total - before) * weight <= room * rest ORDER BY before, rest LIMIT 1),
src AS (
  SELECT *, CASE WHEN b0 IS NULL OR before < b0 THEN room::DOUBLE ELSE least((weight * l0)::DOUBLE / r0, room::DOUBLE) END AS target
  FROM poured LEFT JOIN level ON true),
budget AS (
  SELECT source, rnk, source_size, target, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS passes FROM src),
laid AS (
  SELECT doc_id, size, key, b.*, round(target)::BIGINT - passes * source_size AS rem, row_number() OVER o AS nth,
         coalesce(sum(size) OVER (PARTITION BY rnk ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized d JOIN budget b ON d.source IS NOT DISTINCT FROM b.source
  WINDOW o AS (PARTITION BY rnk ORDER BY key, size)),
gaps AS (
  SELECT rnk, max(rem) - coalesce(sum(size) FILTER (WHERE before + size <= rem), 0)::BIGINT AS gap FROM laid GROUP BY rnk),
best AS (
  SELECT rnk, nth, size, gap, row_number() OVER (PARTITION BY rnk ORDER BY size DESC) AS k FROM (
    SELECT l.rnk, nth, size, gap, row_number() OVER (PARTITION BY l.rnk, length(bin(size)) ORDER BY size DESC, key, nth) AS pick
    FROM laid l JOIN gaps g ON l.rnk = g.rnk WHERE before + size > rem AND size > 0 AND size <= gap) WHERE pick = 1),
fill AS (
  SELECT rnk, 0::BIGINT AS k, gap AS room, -1::BIGINT AS nth FROM gaps
  UNION ALL
  SELECT b.rnk, b.k, CASE WHEN b.size <= f.room THEN f.room - b.size ELSE f.room END, CASE WHEN b.size <= f.room THEN b.nth ELSE -1 END
  FROM fill f JOIN best b ON b.rnk = f.rnk AND b.k = f.k + 1),
took AS (
  SELECT l.*, size * (passes + (size > 0 AND (before + size <= rem OR f.nth IS NOT NULL))::INT) AS taken,
         least(1.0, (before + size / 2.0) / nullif(passes * source_size + rem, 0)) AS share, l.rnk % {len(SCHEDULES)} AS kind
  FROM laid l LEFT JOIN (SELECT rnk, nth FROM fill WHERE nth > 0) f ON l.rnk = f.rnk AND l.nth = f.nth)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN round({when_reached('share', 'kind')}, 6) END AS first_position
FROM took
"""
