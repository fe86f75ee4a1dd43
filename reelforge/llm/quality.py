"""Quality: regularised quadratic discriminant analysis over transformed statistics of a document.

Statistics are made once per text on the executors, moments are summed per class with grouped aggregates over
all labelled rows, and the driver only sees one row per class. Covariances are shrunk towards their diagonal
and towards the pooled one; a score is the logistic of the difference of the two Mahalanobis log densities,
evaluated through Cholesky factors that are made once.

Defined cases: a null or empty text has statistics of its own (all zero) and gets a score; very long texts are measured whole;
several labels of one doc_id count once each; repeated rows are scored, and learnt from, as rows of their own; scores rank nothing
here, so equal ones need no rule; with less than two rows of a class every score is the base rate, 1 for none; an empty table gives
no row; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.common import cut

SHRINK_DIAGONAL = 0.05
SHRINK_POOLED = 0.05
#: Pseudo-counts of shares of words and lines, so that very short texts stay near the common value.
SMALL = 12
STATISTICS = (
    "log_bytes", "log_words", "word_length", "letters", "upper", "digits", "spaces", "newlines", "marks",
    "symbols", "distinct", "top_word", "packed", "entropy", "odd_words", "line_repeats",
)

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall
_ASCII = np.arange(256)
_UPPER, _LOWER = (_ASCII >= 65) & (_ASCII <= 90), ((_ASCII >= 97) & (_ASCII <= 122)) | (_ASCII >= 128)
_DIGIT, _SPACE = (_ASCII >= 48) & (_ASCII <= 57), np.isin(_ASCII, [32, 9, 10, 11, 12, 13])
_MARK = np.isin(_ASCII, list(b".,;:!?'\"-()"))
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _MARK)
_ODD = re.compile(rb"[^\w.,;:!?'\"()\x80-\xff-]|[!?*#$%&|]{2}").search


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a text: logarithms of sizes, arc sines of root shares."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    h = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = _WORDS(text)
    k = max(1, len(words))
    counts = Counter(words)
    p = h[h > 0] / n
    lines = [x for x in text.split(b"\n") if x.strip()]
    odd = sum(c for w, c in counts.items() if _ODD(w))

    def share(x: float) -> float:
        return float(np.arcsin(np.sqrt(min(max(x, 0.0), 1.0))))

    return [
        float(np.log1p(n)), float(np.log1p(len(words))), float(np.log1p(n / k)),
        share((h[_UPPER].sum() + h[_LOWER].sum()) / n), share(h[_UPPER].sum() / n), share(h[_DIGIT].sum() / n), share(h[_SPACE].sum() / n), share(h[10] / n), share(h[_MARK].sum() / n),
        share(h[_SYMBOL].sum() / n), share((len(counts) + SMALL) / (k + SMALL)), share(max(counts.values(), default=0) / (k + SMALL)), float(np.log((len(zlib.compress(text, 1)) + 16) / (n + 16))), float(-(p * np.log(p)).sum()),
        share(odd / (k + 4)), share((len(lines) - len(set(lines))) / (len(lines) + SMALL)),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(1).cast(pa.binary())
        x = [statistics(v.as_py() or b"") for v in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of each whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measure, "doc_id long, x array<double>")


@dataclass
class Model:
    """Means and Cholesky factors by class (0, 1); prior is the log ratio of class sizes."""

    means: np.ndarray
    factors: np.ndarray
    prior: float

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """log of density of class 1 x prior over class 0 x prior, row by row."""
        if not len(self.means):
            return np.full(len(x), self.prior)
        out = []
        for mean, low, inverse in zip(self.means, self.factors, self._inverses, strict=True):
            z = inverse @ (x - mean).T
            out.append(-0.5 * (z * z).sum(0) - np.log(np.diag(low)).sum())
        return out[1] - out[0] + self.prior

    @cached_property
    def _inverses(self) -> list[np.ndarray]:
        """Inverses of the triangular factors by forward substitution, made once for all batches."""
        out = []
        for low in self.factors:
            inverse = np.eye(len(low))
            for i in range(len(low)):
                inverse[i] = (inverse[i] - low[i, :i] @ inverse[:i]) / low[i, i]
            out.append(inverse)
        return out


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(STATISTICS)
    held = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for b in batches:
        if b.num_rows:
            x, y = np.array(b.column(0).to_pylist()), b.column(1).to_numpy()
            for c, sums in held.items():
                v = x[y == c]
                sums += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()]) if len(v) else 0
    yield pa.RecordBatch.from_arrays([pa.array([*held], pa.int32()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], ["label", "sums"])


def fit(measured: DataFrame, labels: DataFrame, learn: Column, diagonal: float = SHRINK_DIAGONAL, pooled: float = SHRINK_POOLED) -> Model:
    """Fits on all rows of labels(doc_id, quality) where learn (over doc_id) holds."""
    d = len(STATISTICS)
    y = labels.where(learn & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    sums = measured.join(y, "doc_id").select("x", "label").mapInArrow(_moments, "label int, sums array<double>")
    rows = sums.select("label", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("col").alias("v")).collect()  # 2 x (1 + d + d^2) numbers
    got = np.zeros((2, 1 + d + d * d))
    for r in rows:
        got[r["label"], r["pos"]] = r["v"]
    n = got[:, 0]
    if n.min() < 2:
        return Model(np.zeros((0, d)), np.zeros((0, d, d)), 40.0 if not n.sum() else float(np.log((n[1] + 1e-9) / (n[0] + 1e-9))))
    means = got[:, 1 : 1 + d] / n[:, None]
    covs = got[:, 1 + d :].reshape(2, d, d) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    common = (covs * (n / n.sum())[:, None, None]).sum(0)
    spread = np.diag(common) + np.var(means, axis=0) + 1e-4
    factors = []
    for c in covs:
        c = (1 - pooled) * c + pooled * common
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(c)) + np.diag(1e-3 * spread)
        factors.append(np.linalg.cholesky(c))
    return Model(means, np.array(factors), float(np.log(n[1] / n[0])))


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                z = model.log_ratio(np.array(b.column(1).to_pylist(), float))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id and score of every row; the statistics are made once and kept in the shared folder meanwhile."""
    measured = cut(measure(docs))
    return measured.mapInArrow(_scorer(fit(measured, labels, learn)), "doc_id long, score double")
