"""Bag-of-words tables ``(doc_id, term_id, cnt)`` from raw text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mlframe.runtime import spread


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sep: str = " ", by_document: bool = False) -> DataFrame:
    """Tokens split on one separator, empty tokens dropped, case kept; ``term`` is the token itself.

    ``by_document`` moves the texts of a document together, not its tokens: groupings by document then need no further shuffle.
    """
    texts = docs.select(id_col, text_col)
    texts = texts.where(F.col(text_col).isNotNull()).repartition(id_col) if by_document else spread(texts)
    tokens = texts.select(F.col(id_col).alias("doc_id"), F.explode(F.split(text_col, sep)).alias("term"))
    return tokens.where("term <> ''").groupBy("doc_id", "term").agg(F.count("*").alias("cnt"))


def bag_of_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Term counts in the numeric form the clustering operators take.

    The token's string serves as ``term_id``: joins and groupings need only
    equality and an order, so no dictionary has to be built or broadcast.
    """
    return term_counts(docs, id_col, text_col, by_document=True).select(
        "doc_id", F.col("term").alias("term_id"), F.col("cnt").cast("double").alias("cnt")
    )


def document_maps(bow: DataFrame) -> DataFrame:
    """One row per document with its terms as a map."""
    entries = F.collect_list(F.struct("term_id", "cnt"))
    return bow.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(entries)).alias("terms"))
