"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics of a text (lengths, character classes, repetition of words, word pairs and lines, short
words) are taken in one pass and transformed by logs and square roots to be nearer to normal. Per
class the mean and covariance come from sums over the training documents; a covariance is shrunk
towards the pooled one and that towards its diagonal, its Cholesky factor is computed once and kept
in the model. A score is the logistic of the difference of the two log densities (half the
Mahalanobis distances and log determinants) plus the log ratio of the class shares.

Training rows: at most ``sample_rows`` labelled rows outside the held-out fold, the first in the
order of a hash of doc_id. Texts alone enter a score. Null texts score as empty ones; repeated rows
are scored each, a null doc_id is never held out. Without training rows of one class every score is
the share of label 1 (0.5 without any rows). An empty table gives an empty result; extra columns are
ignored by ``quality_scores`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import fold, labelled_sample, logistic, map_rows, sampled_texts, scored_by

FOLD, HELD_OUT, THRESHOLD = 4, 2, 0.7

# Character classes of a byte.
LOWER, UPPER, DIGIT, SPACE, LINE, POINT, SYMBOL, OTHER = range(8)
CLASS = np.full(256, OTHER, dtype=np.uint8)
CLASS[:128] = SYMBOL
for _class, _chars in ((LOWER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                       (DIGIT, b"0123456789"), (SPACE, b" \t\r\x0b\x0c"), (LINE, b"\n"), (POINT, b".,;:'\"()-?")):
    CLASS[list(_chars)] = _class


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = max(1, len(data))
    share = np.bincount(CLASS[data], minlength=8) / n
    words = (text or "").split()
    n_words = len(words)
    if not n_words:
        return [0.0] * len(NAMES)
    kinds: dict[str, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in text.split("\n") if x.strip()]
    short = sum(c for w, c in kinds.items() if len(w) <= 3)
    longest = max(len(w) for w in kinds)
    root = np.sqrt
    return [float(x) for x in (
        np.log(n_words), np.log(len(text) / n_words), root(share[SYMBOL]), root(share[UPPER]), root(share[DIGIT]),
        root(share[POINT]), np.log(len(kinds)) / np.log(n_words + 1), root(max(kinds.values()) / n_words),
        root(1 - pairs / max(1, n_words - 1)) if n_words > 1 else 0.0, root(1 - len(set(lines)) / max(1, len(lines))),
        np.log(n_words / max(1, len(lines))), root(short / n_words), np.log(longest), root(text.count("!") / n_words),
        root(text.count(".") / n_words))]


NAMES = ("words", "word_length", "symbols", "capitals", "digits", "points", "distinct_words", "commonest_word",
         "repeated_pairs", "repeated_lines", "line_words", "short_words", "longest_word", "exclamations", "stops")


class Discriminant:
    """Means, cached Cholesky factors and log determinants of the two classes, and the coefficients
    that turn log density differences into scores."""

    def __init__(self, x: np.ndarray, y: np.ndarray, shrink: float = 0.1, diagonal: float = 0.05):
        self.share = (y.sum() + 0.5) / (len(y) + 1.0)
        self.trained = min(y.sum(), len(y) - y.sum()) >= 2
        if not self.trained:
            return
        rows = {c: x[y == c] for c in (0, 1)}
        self.mean = {c: r.mean(axis=0) for c, r in rows.items()}
        cov = {c: (r - self.mean[c]).T @ (r - self.mean[c]) / len(r) for c, r in rows.items()}
        pooled = sum(len(rows[c]) * cov[c] for c in (0, 1)) / len(y)
        floor = 1e-6 + 1e-3 * np.diag(pooled)
        self.factor, self.log_det = {}, {}
        for c in (0, 1):
            own = shrink + (1 - shrink) * len(floor) / (len(floor) + len(rows[c]))  # few rows: more of the pooled one
            s = (1 - own) * cov[c] + own * pooled
            s = (1 - diagonal) * s + diagonal * np.diag(np.diag(s)) + np.diag(floor)
            self.factor[c] = np.linalg.cholesky(s)
            self.log_det[c] = 2.0 * np.log(np.diag(self.factor[c])).sum()
        odds = np.arcsinh(self.log_odds(x))
        self.coefficients = logistic(np.column_stack([np.ones(len(y)), odds]), y.astype(float), ridge=0.1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        log_density = {}
        for c in (0, 1):
            z = np.linalg.solve(self.factor[c], (x - self.mean[c]).T)
            log_density[c] = -0.5 * ((z * z).sum(axis=0) + self.log_det[c])
        return log_density[1] - log_density[0] + np.log(self.share / (1 - self.share))

    def score_texts(self, texts: list) -> np.ndarray:
        return self.score(np.array([statistics(t) for t in texts]).reshape(len(texts), len(NAMES)))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(x), self.share)
        a, b = self.coefficients
        return 1.0 / (1.0 + np.exp(-np.clip(a + b * np.arcsinh(self.log_odds(x)), -700, 700)))


def fit(texts: DataFrame) -> Discriminant:
    """The model of ``texts`` (text, label), a bounded sample: its statistics are taken in Spark and
    come to the driver as one short row a document."""
    schema = pa.schema([("label", pa.int32()), ("x", pa.list_(pa.float64()))])

    def measured(rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, label in rows:
            yield label, statistics(text)
    got = map_rows(texts.select("text", "label"), measured, schema, "label int, x array<double>").toPandas()
    got = got.iloc[np.lexsort(np.array(got["x"].tolist()).reshape(len(got), -1).T)] if len(got) else got
    return Discriminant(np.array(got["x"].tolist()).reshape(len(got), len(NAMES)), got["label"].to_numpy(dtype=int))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 40_000) -> Discriminant:
    return fit(sampled_texts(docs, labelled_sample(labels, "quality", FOLD, HELD_OUT, sample_rows)))


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, **options)
    scored = docs.select("doc_id", (fold(F.col("doc_id"), FOLD) == HELD_OUT).alias("held_out"),
                         scored_by(model.score_texts, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns. Without training rows
    of both classes it rejects none."""
    model = train(docs, labels, **options)
    return docs.filter(scored_by(model.score_texts, F.col("text")) >= THRESHOLD) if model.trained else docs
