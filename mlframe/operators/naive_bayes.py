"""Multinomial naive Bayes on bags of words: a term table per class, scored by one join on terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from mlframe.runtime import durable


@dataclass
class BayesModel:
    """``classes`` (label, prior, unseen) and ``terms`` (term_id, label, weight), all natural logarithms.

    ``unseen`` is the weight of a vocabulary term that the class never had; ``weight`` is what a term that it had adds to that, so a
    class has rows for its own terms only.  ``vocabulary`` (term_id): every term of the training documents.
    """

    classes: DataFrame
    terms: DataFrame
    vocabulary: DataFrame

    def scores(self, bow: DataFrame) -> DataFrame:
        """(doc_id, label, score) for every document of ``bow (doc_id, term_id, cnt)`` and class: log prior plus log likelihood.

        Terms outside the vocabulary count for no class; a document without known terms gets the priors.  Repeated (document, term)
        rows add up.  The output is documents x classes by definition; per class only terms it had are joined.
        """
        known = bow.join(self.vocabulary, "term_id", "left_semi")
        n = known.groupBy("doc_id").agg(F.sum("cnt").alias("n"))
        base = bow.select("doc_id").distinct().join(n, "doc_id", "left").crossJoin(self.classes) \
            .select("doc_id", "label", (F.col("prior") + F.coalesce("n", F.lit(0.0)) * F.col("unseen")).alias("base"))
        own = known.join(self.terms, "term_id").groupBy("doc_id", "label").agg(F.sum(F.col("cnt") * F.col("weight")).alias("own"))
        return base.join(own, ["doc_id", "label"], "left").select("doc_id", "label", (F.col("base") + F.coalesce("own", F.lit(0.0))).alias("score"))

    def predict(self, bow: DataFrame) -> DataFrame:
        """(doc_id, prediction, score): the class with the highest score (to 9 digits); ties: smallest label."""
        best = F.min(F.struct((-F.round("score", 9)).alias("s"), "label"))
        out = self.scores(bow).groupBy("doc_id").agg(best.alias("b"))
        return out.select("doc_id", F.col("b.label").alias("prediction"), (-F.col("b.s")).alias("score"))


def fit(bow: DataFrame, labels: DataFrame, alpha: float = 1.0) -> BayesModel:
    """Fit on the documents of ``bow (doc_id, term_id, cnt)`` that ``labels (doc_id, label)`` names.

    A term's weight in a class is (count + alpha) / (all counts of the class + alpha x vocabulary).  A class is a row, so there may be any
    number; all sums are combined before they are shuffled.  A labelled document without words counts for the prior only.
    """
    if alpha <= 0:
        raise ValueError("alpha must be positive")
    counts = durable(bow.join(labels, "doc_id").groupBy("term_id", "label").agg(F.sum("cnt").cast("double").alias("c")))
    vocabulary = durable(counts.select("term_id").distinct())
    docs = labels.groupBy("label").agg(F.count("*").alias("docs"))
    if docs.isEmpty():
        raise ValueError("no labelled documents")
    sizes = counts.groupBy("label").agg(F.sum("c").alias("total"))
    whole = docs.agg(F.sum("docs").alias("all_docs")).crossJoin(vocabulary.agg(F.count("*").alias("v")))  # one row
    mass = F.coalesce("total", F.lit(0.0)) + F.lit(float(alpha)) * F.greatest("v", F.lit(1))
    classes = durable(docs.join(sizes, "label", "left").crossJoin(F.broadcast(whole)).select(
        "label", F.log(F.col("docs") / F.col("all_docs")).alias("prior"), F.log(F.lit(float(alpha)) / mass).alias("unseen")))
    terms = counts.select("term_id", "label", F.log((F.col("c") + F.lit(float(alpha))) / F.lit(float(alpha))).alias("weight"))
    return BayesModel(classes, durable(terms), vocabulary)
