"""Quality classifier: regularised quadratic discriminant analysis.

Each document becomes a short vector of transformed statistics of its text.
Labelled training rows give one mean and one covariance per class; each
covariance is shrunk towards the pooled one and towards a sphere. A document's
score is the logistic of the difference of the two classes' Gaussian
log-densities: Mahalanobis distances through Cholesky factors that are
computed once and sent along with the scoring function.

Statistics are rounded to a grid, so the class sums are exact whole numbers
and a rerun gives the same model whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.common import saved

STATISTICS = ("log_words", "log_word_length", "word_length_spread", "symbols_per_word",
              "marks_per_word", "letter_share", "capital_share", "digit_share",
              "vocabulary", "repeated_lines", "log_words_per_line", "top_word_share")
GRID = 1 << 16
SHRINK_POOLED = 0.2     # towards the covariance of both classes
SHRINK_SPHERE = 0.1     # then towards a sphere of the same trace
TEMPERATURE = 4.0       # log-density differences are divided by it: Gaussian tails are overconfident
THRESHOLD = 0.7
HOLD_OUT, FOLDS = 2, 4

# Classes of bytes: 1 letter (or part of a non-ASCII character), 2 capital,
# 3 digit, 4 symbol, 5 mark, 0 other.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in "#*$%&|<>"]] = 4
_KIND[[ord(c) for c in "!?"]] = 5


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of one text; an empty text gives zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    count = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=6)
    visible = max(1, int(count[1:].sum()))
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = set(words)
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    return [
        np.log1p(n), np.log(lengths.mean()), lengths.std() / lengths.mean(),
        np.log1p(10 * min(3.0, count[4] / n)), np.log1p(10 * min(3.0, count[5] / n)),
        (count[1] + count[2]) / visible, count[2] / visible, count[3] / visible,
        np.log1p(len(distinct)) / np.log1p(n), (len(lines) - len(set(lines))) / (len(lines) + 4),
        np.log1p(n / max(1, len(lines))), max(seen.values()) / n if n >= 20 else 0.05]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(x.as_py() or b"") for x in batch["text"]]
        grid = np.rint(np.array(rows, dtype=np.float64).reshape(-1, len(STATISTICS)) * GRID).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"]] + [pa.array(c) for c in grid.T], ["doc_id", *STATISTICS])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one whole-number column per statistic (in units of 1/GRID)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.col(text_col).cast("string").cast("binary").alias("text"))
    return d.mapInArrow(_statistics, "doc_id long, " + ", ".join(f"{s} long" for s in STATISTICS))


@dataclass(frozen=True)
class Model:
    """Per class (0, 1): mean, inverse of the Cholesky factor, log-density constant."""

    means: np.ndarray
    inverse_factors: np.ndarray
    constants: np.ndarray
    temperature: float

    def score(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, inverse, constant in zip(self.means, self.inverse_factors, self.constants):
            z = (x - mean) @ inverse.T
            density.append(constant - 0.5 * (z * z).sum(axis=1))
        odds = np.clip((density[1] - density[0]) / self.temperature, -50, 50)
        return 1 / (1 + np.exp(-odds))


def fit(labelled: DataFrame, pooled: float = SHRINK_POOLED, sphere: float = SHRINK_SPHERE,
        temperature: float = TEMPERATURE) -> Model | None:
    """Model from rows of statistics with ``label`` 0 or 1; None if a class is
    missing. One aggregate per class: counts, sums and sums of products, all
    exact; the driver gets two rows."""
    d = len(STATISTICS)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    rows = labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        *[exact(F.col(s)).alias(f"s{i}") for i, s in enumerate(STATISTICS)],
        *[exact(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    by = {r["label"]: r for r in rows}
    if set(by) != {0, 1}:
        return None
    n = np.array([float(by[k]["n"]) for k in (0, 1)])
    means = np.array([[float(by[k][f"s{i}"]) / GRID for i in range(d)] for k in (0, 1)]) / n[:, None]
    scatter = np.zeros((2, d, d))
    for k in (0, 1):
        for i, j in pairs:
            scatter[k, i, j] = scatter[k, j, i] = (
                float(by[k][f"p{i}_{j}"]) / GRID ** 2 - n[k] * means[k, i] * means[k, j])
    common = scatter.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(common), 1e-9))     # statistics in pooled standard deviations
    common = common / np.outer(scale, scale)
    inverse_factors, constants = [], []
    for k in (0, 1):
        cov = (1 - pooled) * scatter[k] / n[k] / np.outer(scale, scale) + pooled * common
        cov = (1 - sphere) * cov + sphere * (np.trace(cov) / d + 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        inverse_factors.append(np.linalg.inv(factor) / scale)
        constants.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Model(means, np.array(inverse_factors), np.array(constants), temperature)


def _scorer(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch[s].to_numpy() for s in STATISTICS]).astype(np.float64) / GRID
            got = model.score(x) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(got)], ["doc_id", "score"])
    return score


def held_out(doc_id) -> F.Column:
    """Rows never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HOLD_OUT, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from the labelled rows that are not held out; labels other than 0
    and 1 are ignored, a document with several label rows counts for each.
    Null text is empty and scored like any other. Without labels of both
    classes every score is 0.5. Repeated rows get a row each, a null doc_id is
    scored but never learned from. Other columns are dropped.
    """
    stats = saved(document_statistics(docs), "qda-statistics")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
                   .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))))
    model = fit(stats.join(known, "doc_id"))
    return (stats.mapInArrow(_scorer(model), "doc_id long, score double")
                 .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted")))
