"""Scoring a stream with a fitted model.

Nearest-centre assignment and logistic scoring are row-wise, so the batch
operators accept a streaming DataFrame as it is; nothing is kept between
micro-batches.  Centres and the nodes of a forest are collected once, before the stream starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from mlframe.operators.forest import ForestModel
from mlframe.operators.kmeans import nearest
from mlframe.operators.logreg import logreg_predict


def assign_stream(points: DataFrame, centers: DataFrame) -> DataFrame:
    """Append ``cluster`` and ``sq_distance`` to a stream of points."""
    return nearest(points, centers)


def score_stream(points: DataFrame, theta: list[float]) -> DataFrame:
    """Append ``probability`` and ``prediction`` to a stream of points."""
    return logreg_predict(points, theta)


def forest_stream(points: DataFrame, model: ForestModel) -> DataFrame:
    """Append ``prediction`` and ``share`` of the trees' votes to a stream of points."""
    return model.score(points)
