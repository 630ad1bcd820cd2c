"""Bounded samples of labelled documents, and the one-dimensional calibration that classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.tables import written


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of a document's number as text, by which rows are held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(divisor))


def sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, rows: int, name: str) -> DataFrame:
    """(doc_id, label, text) of at most `rows` labelled documents, as a written table.

    `training` says over doc_id which labels may be learned from. Labels other than 0 and 1 are left out; a document
    labelled twice has its larger label. The documents with the smallest hashes of their number are taken, so that the
    sample is the same each time; their numbers, `rows` at most, are all that is broadcast.
    """
    usable = labels.where(training & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    once = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"), name)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, weights: np.ndarray | None = None) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last column of `features` is not penalised."""
    theta = np.zeros(features.shape[1])
    if not len(features):
        return theta
    weights = np.ones(len(features)) if weights is None else weights
    penalty = np.full(features.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = sigmoid(features @ theta)
        gradient = features.T @ (weights * (p - labels)) + penalty * theta
        curvature = weights * np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((features * curvature[:, None]).T @ features + np.diag(penalty), gradient)
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return theta
