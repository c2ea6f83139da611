"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

`features` turns each whole text into a few numbers (one pass, Arrow batches). `fit` takes the class moments from
Spark's aggregates, shrinks both class covariances and factors them once; `Discriminant.scores` needs only the two
cached Cholesky factors: the squared Mahalanobis distance of a row is the squared length of the forward
substitution, and the score is the logistic of the difference of log densities plus the log prior odds.

Shrinkage of a class covariance S: (1 - a - b) S + a P + b diag(P), with P the pooled covariance. P is positive
definite through a floor on its diagonal, so the factors always exist.

Null and empty texts have the statistics of a text without words and get a score like any other. Without two
labelled rows of either class there is nothing to learn: every score is then the share of good labels (0.5 without
any label). Labels that are neither 0 nor 1, or null, are left out. Ids that repeat each get their score.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.llm.base import col, cut, ship

#: What `features` returns, all of it from the text alone.
STATISTICS = ("length", "word_length", "upper", "marks", "repeats", "alone", "variety", "other_letters")
#: Share that counts as little: it keeps one stray mark in a clean text from standing far from its class.
LITTLE = 0.02
#: Every mean and share starts from so many words, or bytes, of ordinary text, so that a short text can't stand out
#: by chance. An ordinary word's length, share of capitals and share of marks.
WORDS, BYTES, ORDINARY = 30, 180, (6.0, 0.02, 0.02)
POOLED, DIAGONAL, FLOOR = 0.05, 0.05, 1e-3

_ASCII = np.arange(256)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_LETTER = _UPPER | ((_ASCII >= 97) & (_ASCII <= 122)) | (_ASCII >= 128)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_SPACE = (_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13))
_MARK = ~(_LETTER | _DIGIT | _SPACE) & (_ASCII > 32)
_MARKS = bytes(np.flatnonzero(_MARK).tolist())


def _rare(share: float) -> float:
    """A share on a scale that spreads small values: 0 for none, about 3.9 for all."""
    return math.log1p(share / LITTLE)


def statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of one whole text, in the order of STATISTICS."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    bytes_of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters, size, n = int(bytes_of[_LETTER].sum()), len(raw), len(words)
    spaces = int(bytes_of[_SPACE].sum())
    seen = Counter(words)
    length, upper, marks = ORDINARY
    return (
        math.log1p(n),
        math.log((size - spaces + WORDS * length) / (n + WORDS)),
        _rare((int(bytes_of[_UPPER].sum()) + BYTES * upper) / (letters + BYTES)),
        _rare((int(bytes_of[_MARK].sum()) + BYTES * marks) / (size + BYTES)),
        _rare(sum(map(operator.eq, words[1:], words)) / (n + WORDS)),
        _rare(sum(k for w, k in seen.items() if w[0] in _MARKS and not w.strip(_MARKS)) / (n + WORDS)),
        math.log((len(seen) + WORDS) / (n + WORDS)) + 0.25 * math.log(n + WORDS),
        _rare(int(bytes_of[128:].sum()) / (size + BYTES)),
    )


def features(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, features array): the statistics of every whole text."""
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            values = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["id", "features"])

    narrow = docs.select(col(id).alias("id"), col(text).alias("text"))
    shape = narrow.select("id", F.array(F.lit(0.0)).alias("features")).schema
    shape["id"].dataType = kind
    return narrow.mapInArrow(read, shape).withColumnRenamed("id", id)


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians as means, inverse Cholesky factors and log determinants, and the log prior odds."""

    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    logdets: tuple[float, float]
    prior: float

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        """Log density under class 1 less that under class 0, plus the log prior odds."""
        density = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets, strict=True):
            density.append(-0.5 * (np.square((rows - mean) @ factor.T).sum(axis=1) + logdet))
        return density[1] - density[0] + self.prior

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(rows), -500, 500)))


@dataclass(frozen=True)
class Share:
    """What is left to say without examples of both classes."""

    share: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.full(len(rows), self.share)


def moments(rows: DataFrame, label: str, vector: str, size: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per class: rows, sum, and sum of outer products. One aggregate; two rows of size*size numbers come back."""
    at = [F.element_at(col(vector), i + 1) for i in range(size)]
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(at)]
    products = [F.sum(at[i] * at[j]).alias(f"p{i}_{j}") for i in range(size) for j in range(i + 1)]
    wanted = rows.where(col(label).isin(0, 1)).groupBy(col(label).cast("int").alias("label"))
    out = {}
    for row in wanted.agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect():
        outer = np.zeros((size, size))
        for i in range(size):
            for j in range(i + 1):
                outer[i, j] = outer[j, i] = row[f"p{i}_{j}"]
        out[row["label"]] = (row["n"], np.array([row[f"s{i}"] for i in range(size)]), outer)
    return out


def discriminant(found: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> Discriminant | Share:
    """The model of the classes' moments."""
    rows = {c: found[c][0] if c in found else 0 for c in (0, 1)}
    if min(rows.values()) < 2:
        total = rows[0] + rows[1]
        return Share(rows[1] / total if total else 0.5)
    means, covariances = [], []
    for c in (0, 1):
        n, total, outer = found[c]
        mean = total / n
        means.append(mean)
        covariances.append(outer / n - np.outer(mean, mean))
    pooled = (rows[0] * covariances[0] + rows[1] * covariances[1]) / (rows[0] + rows[1])
    pooled = pooled + FLOOR * np.eye(len(pooled))
    factors, logdets = [], []
    for s in covariances:
        shrunk = (1 - POOLED - DIAGONAL) * s + POOLED * pooled + DIAGONAL * np.diag(np.diag(pooled))
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.solve(lower, np.eye(len(lower))))
        logdets.append(2.0 * float(np.log(np.diag(lower)).sum()))
    return Discriminant(tuple(means), tuple(factors), tuple(logdets), math.log(rows[1] / rows[0]))


def fit(rows: DataFrame, label: str = "quality", vector: str = "features") -> Discriminant | Share:
    """Learns from all given rows with a label of 0 or 1."""
    return discriminant(moments(rows, label, vector, len(STATISTICS)))


def scored(rows: DataFrame, model: Discriminant | Share, vector: str = "features", out: str = "score") -> DataFrame:
    """Adds the score, 0 to 1, of rows that hold their features."""
    ship(rows.sparkSession)

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        return pd.Series(model.scores(_matrix(vectors.tolist())))

    return rows.withColumn(out, score(col(vector)))


def text_score(model: Discriminant | Share, text: Column) -> Column:
    """The score of whole texts; only the text goes to Python."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(_matrix([statistics(t) for t in texts])))

    return score(text)


def _matrix(rows: list) -> np.ndarray:
    return np.array(rows, dtype=np.float64).reshape(-1, len(STATISTICS))


def held_out(id: Column) -> Column:
    """True for the quarter of ids that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(
    rows: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality", vector: str = "features"
) -> Discriminant | Share:
    """The model of all labelled rows that are not held out; `rows` holds (id, features)."""
    named = labels.select(col(id).alias("_id"), col(label).alias("_label"))
    known = rows.select(col(id).alias("_id"), col(vector).alias("_vector")).join(named, "_id")
    return fit(known.where(~held_out(F.col("_id"))), "_label", "_vector")


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    rows = cut(features(docs, id, text))
    out = scored(rows, learn(rows, labels, id, label))
    return out.select(
        col(id), held_out(col(id)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_rejected(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """The rows of `docs` that score at least `threshold`, with the columns they have."""
    model = learn(cut(features(docs, id, text)), labels, id, label)
    return docs.where(text_score(model, col(text)) >= threshold)
