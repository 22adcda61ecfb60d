"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct runs of 3, 4 and 5 characters, lower-cased, hashed to a fixed number of
buckets. Each bucket counts with its log-count ratio, ``log((1 + p) / |p|) - log((1 + q) / |q|)`` for the
numbers p and q of toxic and other training texts that hold it; a logistic regression weighs these.

Fitting reads at most ``max_rows`` labelled rows of each label, those of least hash, wherever they lie.
Their n-grams are taken on the executors; the driver gets the bucket numbers that carry signal, at most
``FEATURES`` per row. Scoring covers every text, whole, in batches; what it broadcasts are the bucket
weights, 1 MiB whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import written

SIZES = (3, 4, 5)
BUCKETS = 1 << 18
#: Buckets the regression weighs: those whose log-count ratio is furthest from none, given their counts.
FEATURES = 1 << 12
#: Labelled rows of each label used for fitting, at most.
MAX_ROWS = 5_000
ROUNDS = 300
DECAY = 0.02


def buckets_of(text: str | None) -> np.ndarray:
    """Distinct buckets of a text's character n-grams, in no order. Blanks at both ends count as one each."""
    padded = f" {(text or '').lower()} "
    codes = np.frombuffer(padded.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    found = []
    grown = codes
    for size in range(2, max(SIZES) + 1):
        if len(codes) < size:
            break
        grown = grown[:-1] * np.uint64(0x100000001B3) + codes[size - 1 :]
        if size in SIZES:
            mixed = (grown + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(46)).astype(np.int32))
    if not found:
        return np.empty(0, dtype=np.int32)
    every = np.concatenate(found)
    # The last position written to a bucket marks its one occurrence that counts; faster than sorting.
    if not _LAST:
        _LAST.append(np.empty(BUCKETS, dtype=np.int64))
    last = _LAST[0]
    position = np.arange(len(every))
    last[every] = position
    return every[last[every] == position]


#: A task's scratch space, made when first used.
_LAST: list[np.ndarray] = []


@dataclass
class Model:
    """Weight of each bucket, and what every text gets."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.bias + float(self.weights[buckets_of(text)].sum(dtype=np.float64))))))


def _sampled(docs: DataFrame, labels: DataFrame, label: str, training: Column, max_rows: int) -> DataFrame:
    """(text, toxic) of the training rows: the ``max_rows`` of least hash for each label."""
    marked = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(training)
    )
    picked = None
    for value in (0, 1):
        part = marked.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        picked = part if picked is None else picked.union(part)
    # Written, so that its bounded size is known: at most 2 * max_rows narrow rows are broadcast.
    picked = written(picked, "toxicity-rows")
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(picked), "doc_id")


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task and bucket, the texts of either label that hold it."""
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    rows = np.zeros(2, dtype=np.int64)
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[toxic][buckets_of(text)] += 1
            rows[toxic] += 1
    held = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"bucket": held, "others": counts[0][held], "toxic": counts[1][held]})
    yield pd.DataFrame({"bucket": [-1], "others": [rows[0]], "toxic": [rows[1]]})


def _rows_with(chosen: np.ndarray):
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = (place[buckets_of(t)] for t in batch["text"])
            features = [np.sort(h[h >= 0]).astype(np.uint16).tobytes() for h in held]
            yield pd.DataFrame({"toxic": batch["toxic"], "features": features})

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    training: Column | None = None,
    max_rows: int = MAX_ROWS,
    features: int = FEATURES,
) -> Model:
    """Classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id and a column of 0 and 1).

    ``training`` is a condition on doc_id that a row must meet to be learned from. Labels other than 0 and 1
    are left out; a document marked both ways counts as toxic. Without rows of both labels the model gives
    every text the share of toxic rows, counted with one row of each label to spare.
    """
    chosen_rows = _sampled(docs, labels, label, F.lit(True) if training is None else training, max_rows)
    rows = written(chosen_rows.select("text", "toxic"), "toxicity-texts")
    counted = (
        rows.mapInPandas(_counts, "bucket int, others long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic"))
        .toPandas()  # a row per bucket, 2**18 at most
    )
    totals = counted.loc[counted["bucket"] == -1, ["others", "toxic"]].to_numpy().ravel()
    others, toxic = (int(totals[0]), int(totals[1])) if len(totals) else (0, 0)
    if not others or not toxic:
        share = (toxic + 1) / (others + toxic + 2)
        return Model(np.zeros(BUCKETS, dtype=np.float32), float(np.log(share / (1 - share))))
    counted = counted[counted["bucket"] >= 0].sort_values("bucket")
    p, q = 1.0 + counted["toxic"].to_numpy(), 1.0 + counted["others"].to_numpy()
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    # How far the two shares are apart, in standard errors.
    share = (p + q) / (toxic + others)
    apart = np.abs(p / toxic - q / others) / np.sqrt(share * np.maximum(1 - share, 1e-9) * (1 / toxic + 1 / others))
    best = np.lexsort((counted["bucket"].to_numpy(), -apart))[:features]
    chosen, scale = counted["bucket"].to_numpy()[best], ratio[best]
    sample = rows.mapInPandas(_rows_with(chosen), "toxic int, features binary").toPandas()
    weights, bias = _regression(sample, scale)
    out = np.zeros(BUCKETS, dtype=np.float32)
    out[chosen] = weights * scale
    return Model(out, bias)


def _regression(sample: pd.DataFrame, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with both labels of equal weight, by accelerated gradient steps."""
    sample = sample.sort_values(["toxic", "features"])  # the same sums in the same order, whatever the tasks
    held = [np.frombuffer(f, dtype=np.uint16).astype(np.int64) for f in sample["features"]]
    y = sample["toxic"].to_numpy(dtype=np.float64)
    columns = np.concatenate(held)
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    values = scale[columns]
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))

    weights, bias = np.zeros(len(scale)), 0.0
    ahead, ahead_bias = weights, bias
    # The curvature is at most a quarter of the mean squared row length.
    length = np.bincount(row, values**2, len(y))
    step = 1 / (0.25 * float((share * (length + 1)).sum()) * 4 + DECAY)
    for k in range(ROUNDS):
        score = np.bincount(row, values * ahead[columns], len(y)) + ahead_bias
        error = share * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - y)
        gradient = np.bincount(columns, values * error[row], len(scale)) + DECAY * ahead / len(scale)
        new, new_bias = ahead - step * gradient, ahead_bias - step * error.sum()
        pull = k / (k + 3)
        ahead, ahead_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, float(bias)


def score_column(text: Column, model: Model) -> Column:
    """Score from 0 to 1 of a text column; higher is likelier toxic. NULL and empty texts get that of no n-gram
    but blanks."""

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return scored(text.cast("string"))


def scored_documents(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 if the score is ``least`` or more, else 0), one row per input row."""
    scored = docs.select("doc_id", score_column(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))


def keep_clean(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """Rows of ``docs`` whose text scores below ``least``, with their columns as they are."""
    return docs.where(score_column(F.col("text"), model) < least)
