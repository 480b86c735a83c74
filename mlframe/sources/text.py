"""Text sources.  ``parse_*`` turn a DataFrame of lines (column ``value``) into typed rows;
``read_*`` do the same from files.  A vector row without an id column gets none here:
lines carry no key, so callers that need ``row_id`` pass it along in the line table.

A line that cannot be read in full is malformed: it fails the job (``malformed='fail'``, the default) or is left out
(``'drop'``).  With an ``Observation`` as ``counts`` the numbers of ``lines`` and of ``malformed`` ones are reported once the
result has been computed.  Blank lines, and the header lines of bags of words (one whole number), are no rows and never malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines, one row each."""
    return spark.read.text(path)


def _keep(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c != "value"]


def _numbers(parts: Column) -> Column:
    return F.transform(parts, lambda p: p.try_cast("double"))


def _readable(parts: Column) -> Column:
    return F.forall(parts, lambda p: p.try_cast("double").isNotNull())


def _fields(sep: str) -> Column:
    return F.transform(F.split("value", sep), lambda p: F.trim(p))


def _sound(lines: DataFrame, parts: Column, good: Column, malformed: str, counts: Observation | None,
           header: Column | None = None) -> DataFrame:
    """Lines with their fields ``_p``, without blank and header lines; others must be ``good``."""
    if malformed not in ("fail", "drop"):
        raise ValueError("malformed is 'fail' or 'drop'")
    rows = lines.where(F.trim("value") != "").withColumn("_p", parts)
    rows = rows if header is None else rows.where(~header)
    good = F.coalesce(good, F.lit(False))
    if counts is not None:
        rows = rows.observe(counts, F.count("*").alias("lines"), F.count_if(~good).alias("malformed"))
    if malformed == "fail":
        error = F.raise_error(F.concat(F.lit("malformed line: "), F.left("value", F.lit(200)))).cast("boolean")
        good = F.when(good, True).otherwise(error)
    return rows.where(good)


def parse_labeled_vectors(lines: DataFrame, dims: int, malformed: str = "fail", counts: Observation | None = None) -> DataFrame:
    """``x1..xd, c1..cd, id`` -> features, center, label."""
    parts = F.col("_p")
    good = (F.size("_p") >= 2 * dims + 1) & _readable(F.slice(parts, 1, 2 * dims))
    return (
        _sound(lines, _fields(","), good, malformed, counts)
        .select(
            *_keep(lines),
            _numbers(F.slice(parts, 1, dims)).alias("features"),
            _numbers(F.slice(parts, dims + 1, dims)).alias("center"),
            parts[2 * dims].alias("label"),
        )
    )


def read_labeled_vectors(spark: SparkSession, path: str, dims: int, **malformed) -> DataFrame:
    return parse_labeled_vectors(read_lines(spark, path), dims, **malformed)


def parse_labeled_points(lines: DataFrame, dims: int, label_pos: int, malformed: str = "fail",
                         counts: Observation | None = None) -> DataFrame:
    """CSV with the label at a 1-based position -> label, features.

    The label is the whole trimmed field, a whole number (``10`` stays 10, ``1.7`` is malformed).  Other non-empty
    fields fill the vector in order; missing ones are 0.0.
    """
    others = F.filter(F.col("_p"), lambda p, i: (i != label_pos - 1) & (p != ""))
    label = F.get(F.col("_p"), F.lit(label_pos - 1)).try_cast("double")
    good = (label == F.floor(label)) & _readable(F.slice(others, 1, dims))
    padded = F.concat(_numbers(F.slice(others, 1, dims)), F.array_repeat(F.lit(0.0), dims))
    return (
        _sound(lines, _fields(","), good, malformed, counts)
        .select(
            *_keep(lines),
            label.cast("int").alias("label"),
            F.slice(padded, 1, dims).alias("features"),
        )
    )


def read_labeled_points(spark: SparkSession, path: str, dims: int, label_pos: int, **malformed) -> DataFrame:
    return parse_labeled_points(read_lines(spark, path), dims, label_pos, **malformed)


def _whole(i: int) -> Column:
    return F.get(F.col("_p"), F.lit(i)).try_cast("bigint")


def _header() -> Column:
    """A line of one whole number, as bags of words begin with."""
    return (F.size("_p") == 1) & _whole(0).isNotNull()


def parse_bow(lines: DataFrame, malformed: str = "fail", counts: Observation | None = None) -> DataFrame:
    """``docID termID count`` -> doc_id, term_id, cnt.

    Lines of one whole number (headers) are skipped and repeated (doc, term) lines add up.
    """
    parts = F.filter(F.split("value", " "), lambda p: p != "")
    count = F.get(F.col("_p"), F.lit(2)).try_cast("double")
    good = (F.size("_p") == 3) & _whole(0).isNotNull() & _whole(1).isNotNull() & count.isNotNull()
    return (
        _sound(lines.select("value"), parts, good, malformed, counts, _header())
        .select(_whole(0).alias("doc_id"), _whole(1).alias("term_id"), count.alias("cnt"))
        .groupBy("doc_id", "term_id").agg(F.sum("cnt").alias("cnt"))
    )


def read_bow(spark: SparkSession, path: str, **malformed) -> DataFrame:
    return parse_bow(read_lines(spark, path), **malformed)


def parse_word_sets(lines: DataFrame, malformed: str = "fail", counts: Observation | None = None) -> DataFrame:
    """``docID termID [count]`` -> distinct (doc_id, term_id); counts are dropped."""
    parts = F.filter(F.split("value", " "), lambda p: p != "")
    good = (F.size("_p") >= 2) & _whole(0).isNotNull() & _whole(1).isNotNull()
    return (
        _sound(lines.select("value"), parts, good, malformed, counts, _header())
        .select(_whole(0).alias("doc_id"), _whole(1).alias("term_id"))
        .distinct()
    )


def read_word_sets(spark: SparkSession, path: str, **malformed) -> DataFrame:
    return parse_word_sets(read_lines(spark, path), **malformed)


def parse_points(lines: DataFrame, sep: str, dims: int, with_id: bool, id_name: str = "row_id",
                 malformed: str = "fail", counts: Observation | None = None) -> DataFrame:
    """``id|x|y|`` or ``x y`` / ``id x y`` lines -> (id,) features."""
    first = 1 if with_id else 0
    pattern = "\\" + sep if sep in "|.+*?" else sep
    cols = [_whole(0).alias(id_name)] if with_id else []
    good = (F.size("_p") >= dims + first) & _readable(F.slice("_p", first + 1, dims))
    return (
        _sound(lines, _fields(pattern), good & _whole(0).isNotNull() if with_id else good, malformed, counts)
        .select(*_keep(lines), *cols, _numbers(F.slice("_p", first + 1, dims)).alias("features"))
    )


def read_points(spark: SparkSession, path: str, sep: str, dims: int, with_id: bool,
                id_name: str = "row_id", **malformed) -> DataFrame:
    return parse_points(read_lines(spark, path), sep, dims, with_id, id_name, **malformed)


def read_centers(spark: SparkSession, path: str, sep: str = " ", dims: int = 2, **malformed) -> DataFrame:
    """``id x y`` centre lines -> cluster, center."""
    return read_points(spark, path, sep, dims, True, "cluster", **malformed).select(
        F.col("cluster").cast("int").alias("cluster"), F.col("features").alias("center")
    )


def parse_theta(lines: DataFrame, malformed: str = "fail", counts: Observation | None = None) -> DataFrame:
    """Comma list of weights -> theta (exponents such as ``1.0E-5`` are read in full; empty fields, as behind a last comma, are none)."""
    parts = F.filter(_fields(","), lambda p: p != "")
    rows = _sound(lines, parts, (F.size("_p") > 0) & _readable(F.col("_p")), malformed, counts)
    return rows.select(*_keep(lines), _numbers(F.col("_p")).alias("theta"))


def read_theta(spark: SparkSession, path: str, **malformed) -> list[float]:
    """The one-line model file as a driver-side list."""
    row = parse_theta(read_lines(spark, path), **malformed).first()
    if row is None:
        raise ValueError("no weights")
    return list(row["theta"])


def in_memory(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small driver-side collection as a DataFrame."""
    return spark.createDataFrame(rows, schema)
