"""Regularised quadratic discriminant for document quality.

Every text gives a vector of statistics (below), brought to roughly normal form
by logarithms and logits.  For each class of ``labels.quality`` the number of
rows, the mean and the covariance come from sums that are aggregated across
partitions.  A class covariance is shrunk towards the pooled one and towards a
multiple of the identity; its Cholesky factor and log-determinant are found
once and kept.  A text's log-odds are the difference of the two Gaussian
log-densities (Mahalanobis distances by the factors) plus that of the class
sizes; the score is the logistic function of the log-odds over ``temper``
(statistics are not independent, so raw odds are overconfident; the order of
scores does not depend on it).

Learning uses labelled rows only, all of them outside the held-out fold.  Labels,
language, source and id are never inputs of a score.

Defined results: null and empty texts have the statistics of a text of no words
and get a score like any other; equal texts get equal scores; rows without a
label (or with a null one) are not learnt from; with no example of a class the
score is the share of label 1 among the examples (0.5 without examples); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Words, crc_mod, documents, slices, written

FOLDS = 5
THRESHOLD = 0.3
#: Weight of the pooled covariance in a class's, and of the identity in the result.
POOLED, RIDGE = 0.3, 1e-2
#: Log-odds are divided by this before the logistic function.
TEMPER = 4.0

#: Labels are broadcast up to this many (16 bytes each), else joined by a shuffle.
BROADCAST_LABELS = 500_000

FEATURES = ("words", "word_length", "word_length_sd", "symbols", "upper", "digits", "marks", "exclaims", "sentences",
            "lines", "distinct_words", "distinct_pairs", "repeats", "top_word", "short_words", "long_words", "marked_words")
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>@^~=+_{}[]\\/", np.uint8))
_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_MARK = (_BYTE < 128) & (_BYTE > 32) & ~_UPPER & ~_LOWER & ~_DIGIT


def _sums(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(mask, dtype=np.float64)])
    return total[off[1:]] - total[off[:-1]]


def _logit(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row and the count of its most frequent one."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (r[1:] != r[:-1])]) if len(v) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    top = np.zeros(rows)
    np.maximum.at(top, r[at], np.diff(np.append(at, len(v))))
    return np.bincount(r[at], minlength=rows).astype(float), top


def statistics(col: pa.Array) -> np.ndarray:
    """A row of FEATURES for every text."""
    w = Words(col)
    rows, data = len(col), w.data
    row = np.repeat(np.arange(rows), w.counts)
    n = w.counts.astype(float)
    some = np.maximum(n, 1)
    by = lambda values: np.bincount(row, weights=values, minlength=rows)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    size = (points[w.end] - points[w.start]).astype(float)
    mean = by(size) / some
    sd = np.sqrt(np.maximum(by(size * size) / some - mean ** 2, 0))
    chars = (points[w.off[1:]] - points[w.off[:-1]]).astype(float)
    upper, lower = _sums(_UPPER[data], w.off), _sums(_LOWER[data], w.off)
    marks = _sums(_MARK[data], w.off)
    distinct, top = _distinct(w.hash, row, rows)
    pairs, first = w.grams(2)
    pair_row = np.repeat(np.arange(rows), np.diff(first))
    distinct_pairs, _ = _distinct(pairs, pair_row, rows)
    again = np.zeros(len(row))
    if len(row) > 1:
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    marked = _MARK[data[w.end - 1]].astype(float) if len(row) else np.zeros(0)
    out = [np.log1p(n), np.log1p(mean), np.log1p(sd), _logit(_sums(_SYMBOL[data], w.off), chars), _logit(upper, upper + lower),
           _logit(_sums(_DIGIT[data], w.off), chars), _logit(marks, chars), _logit(_sums(data == 33, w.off), chars),
           _logit(_sums(data == 46, w.off), n), _logit(_sums(data == 10, w.off), n), _logit(distinct, n),
           _logit(distinct_pairs, np.maximum(n - 1, 0)), _logit(by(again), n), _logit(top, n), _logit(by(size <= 3), n),
           _logit(by(size >= 12), n), _logit(by(marked), n)]
    return np.stack(out, 1)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x array<double>) for every row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            x = statistics(b.column("text"))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("key"), flat], ["key", "x"])

    out = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, f"key {kind}, x array<double>")
    return out.withColumnRenamed("key", key)


@dataclass
class Discriminant:
    """Two Gaussians: means, inverse Cholesky factors, log-determinants, class log-sizes."""

    mean: np.ndarray | None
    factor: np.ndarray | None
    log_det: np.ndarray | None
    log_n: np.ndarray | None
    share: float
    temper: float = TEMPER

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.factor is None:
            return np.full(len(x), self.share)
        density = [-0.5 * (((x - self.mean[c]) @ self.factor[c].T) ** 2).sum(1) - 0.5 * self.log_det[c] + self.log_n[c]
                   for c in (0, 1)]
        z = np.clip((density[1] - density[0]) / self.temper, -700, 700)
        return 1.0 / (1.0 + np.exp(-z))


def fit(rows: DataFrame, pooled: float = POOLED, ridge: float = RIDGE, temper: float = TEMPER) -> Discriminant:
    """From (x, label) or (text, label): class sums by partition, then by class; only
    sums reach the driver."""
    d = len(FEATURES)
    measured = "x" in rows.columns

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches if measured else slices(batches):
            if not b.num_rows:
                continue
            x = np.asarray(b.column("x").flatten()).reshape(-1, d) if measured else statistics(b.column("text"))
            y = np.asarray(b.column("label"))
            for c in (0, 1):
                part = x[y == c]
                total[c] += np.concatenate([[len(part)], part.sum(0), (part.T @ part).ravel()])
        k = total.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], k)), pa.array(np.tile(np.arange(k), 2)),
                                          pa.array(total.ravel())], ["label", "at", "v"])

    got = (rows.mapInArrow(sums, "label long, at long, v double").groupBy("label", "at").agg(F.sum("v").alias("v")).collect())
    total = np.zeros((2, 1 + d + d * d))
    for r in got:
        total[r["label"], r["at"]] = r["v"]
    n = total[:, 0]
    if n.min() < 2:
        return Discriminant(None, None, None, None, float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = total[:, 1:1 + d] / n[:, None]
    cov = [total[c, 1 + d:].reshape(d, d) / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)]
    both = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    scale = np.trace(both) / d + 1e-9
    factor, log_det = [], []
    for c in (0, 1):
        own = (1 - pooled) * cov[c] + pooled * both
        lower = np.linalg.cholesky((1 - ridge) * own + ridge * scale * np.eye(d))
        factor.append(np.linalg.inv(lower))
        log_det.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(mean, np.array(factor), np.array(log_det), np.log(n), float(n[1] / n.sum()), temper)


def score(x: DataFrame, model: Discriminant, key: str = "doc_id") -> DataFrame:
    """(key, score) from (key, x)."""
    kind = x.schema[key].dataType.simpleString()
    d = len(FEATURES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(np.asarray(b.column("x").flatten()).reshape(-1, d)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(s, pa.float64())], ["key", "score"])

    out = x.withColumnRenamed(key, "key").select("key", "x").mapInArrow(run, f"key {kind}, score double")
    return out.withColumnRenamed("key", key)


def examples(x: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, label) of labelled rows outside the held-out fold."""
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality").cast("long").alias("label"))
    return x.where(crc_mod("doc_id", FOLDS) != 0).join(known, F.col("doc_id") == F.col("_id")).select("x", "label")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    x = written(features(docs), "features")
    out = score(x, fit(examples(x, labels)))
    return out.select("doc_id", (crc_mod("doc_id", FOLDS) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def scored(docs: DataFrame, model: Discriminant, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every row; its other columns do not pass through Python."""

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        parts = [model.score(statistics(b.column("text"))) for b in slices([pa.record_batch([texts], ["text"])])]
        return pa.array(np.concatenate([*parts, np.zeros(0)]))

    return docs.withColumn(out, score_of(F.col(text)))


def learn(docs: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on the labelled rows of ``docs`` outside the held-out fold; only those are measured."""
    known = labels.where("quality IN (0, 1)").where(crc_mod("doc_id", FOLDS) != 0).select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("long").alias("label"))
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return fit(docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id")).select("text", "label"))


def op6_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return classify(documents(spark, sf_dir, "doc_id", "text"), labels)
