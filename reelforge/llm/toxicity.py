"""Toxicity: a counterfactually regularised classifier over words and word onsets.

Features of a text are its distinct lower-cased words and the first ONSETS letters of each. Logistic
regression with an L1 penalty is fitted on a bounded sample of labelled rows (FIT_ROWS, those with the least
hash of the id). Every sentence of the sample that names a group gets a counterfactual for each other name of its
list: the name is swapped, the labelled text is featured anew with that sentence in it, and the squared change of the
text's logit is penalised (COUNTERFACTUAL). A name that stands in another sentence too, or an onset that another word
has, stays a feature of the text, as it does when the text is scored. So naming a group moves no
score by itself. Feature counts, sentences and vectors are made on the executors; the driver sees
the selected features (at most MOST_FEATURES), the sample's rows over them and one row per distinct change.

Defined cases: a null or empty text has no feature and scores the base rate; very long texts are read whole and give their
distinct features; features with equal gain are chosen by name; a null doc_id is not held out by
its crc (0) unless the caller says so; several labels of one doc_id count once each; of several rows of one doc_id
the sample has the least text, and every row is scored by itself; without labelled rows of both classes every score
is the base rate, 0 for none; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.common import cut

FIT_ROWS = 20_000
MOST_FEATURES = 4096
LEAST_ROWS = 4
ONSETS = (4, 5)
L1 = 1e-4
COUNTERFACTUAL = 1.0

# Names of groups, in lists within which a sentence keeps its meaning when one replaces another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf", "old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische", "flüchtlinge"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "immigrés", "réfugiés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "inmigrantes", "refugiados"),
)

_WORDS = re.compile(r"[^\W\d_]+").findall
_SENTENCES = re.compile(r"[^.!?\n]+").findall


def features(text: str) -> set[str]:
    """Words, and onsets marked by a trailing '*'."""
    words = set(_WORDS(text.lower()))
    return words.union(*({w[:k] + "*" for w in words if len(w) >= k} for k in ONSETS))


def counterfactuals(text: str) -> Counter:
    """(features gained, features lost) by the text when one name of one sentence is swapped for another of its list."""
    found: Counter = Counter()
    lower = text.lower()
    if _NAMES.isdisjoint(_WORDS(lower)):
        return found
    sentences = [frozenset(_WORDS(x)) for x in _SENTENCES(lower)]
    times = Counter(w for held in sentences for w in held)
    onsets = {k: Counter(w[:k] for w in times if len(w) >= k) for k in ONSETS}
    for held in sentences:
        for name in held & _NAMES:
            goes = {name} if times[name] == 1 else set()
            lost = goes | {name[:k] + "*" for k in ONSETS if goes and len(name) >= k and onsets[k][name[:k]] == 1}
            for other in _OTHERS[name]:
                comes = set() if other in times else {other}
                gained = comes | {other[:k] + "*" for k in ONSETS if comes and len(other) >= k and not onsets[k][other[:k]]}
                # an onset that both names have stays
                stay = {other[:k] + "*" for k in ONSETS if len(other) >= k}
                found[tuple(sorted(gained - lost)), tuple(sorted(lost - stay))] += 1
    return found


_OTHERS = {a: [b for b in group if b != a] for group in IDENTITY_TERMS for a in group}
_NAMES = frozenset(_OTHERS)


@dataclass
class Model:
    """Bias and weights by feature; features that are absent weigh nothing."""

    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)

    def split(self) -> tuple[dict[str, float], dict[int, dict[str, float]]]:
        words = {f: w for f, w in self.weights.items() if not f.endswith("*")}
        return words, {k: {f[:-1]: w for f, w in self.weights.items() if f.endswith("*") and len(f) == k + 1} for k in ONSETS}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    for b in batches:
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts[label].update(features(text or ""))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield _counted(counts)
                counts = (Counter(), Counter())
    yield _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    keys = [*counts[0].keys() | counts[1].keys()]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)], ["feature", "n0", "n1"])


def _vectors(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {f: i for i, f in enumerate(names)}
        for b in batches:
            rows = [sorted(at[f] for f in features(text or "").intersection(at)) for text in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(rows, pa.list_(pa.int32()))], ["label", "x"])

    return run


def _changes(names: list[str]):
    """Per task the distinct changes over the selected features, and how often each is met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found = {f: i for i, f in enumerate(names)}, Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                for (gained, lost), times in counterfactuals(text or "").items():
                    found[tuple(at[f] for f in gained if f in at), tuple(at[f] for f in lost if f in at)] += times
        kinds = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64())
        cols = ([list(g) for g, _ in found], [list(x) for _, x in found], list(found.values()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["gained", "lost", "times"])

    return run


@dataclass
class Changes:
    """Rows of +1 and -1 by feature, times a weight: what counterfactuals change, and how much it matters."""

    row: np.ndarray
    col: np.ndarray
    value: np.ndarray
    n: int

    @staticmethod
    def of(rows: list[tuple[list[int], list[int], float]]) -> Changes:
        row = [k for k, (g, x, _) in enumerate(rows) for _ in (*g, *x)]
        col = [f for g, x, _ in rows for f in (*g, *x)]
        value = [v * w for g, x, w in rows for v in (*[1.0] * len(g), *[-1.0] * len(x))]
        return Changes(np.array(row, np.int64), np.array(col, np.int64), np.array(value, float), len(rows))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.col], minlength=self.n)

    def back(self, z: np.ndarray, n_features: int) -> np.ndarray:
        return np.bincount(self.col, weights=self.value * z[self.row], minlength=n_features)


def fit_logistic(rows: list[np.ndarray], labels: np.ndarray, n_features: int, l1: float, changes: Changes, steps: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for mean log loss + l1 |w| + sum over changes of (change . w)^2; the bias is free."""
    n = len(rows)
    nnz = np.array([len(r) for r in rows])
    col = np.concatenate(rows) if n else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), nnz)
    # steps by coordinate: frequent features have a large curvature
    freq = np.bincount(col, minlength=n_features) / max(n, 1)
    # a Lipschitz bound of the diagonally scaled loss
    scale = 1.0 / np.sqrt(freq + 1.0 / max(n, 1))
    lip = 0.25 * (1.0 + _top(row, col, scale, n, n_features))
    if changes.n:
        v = np.ones(n_features) / np.sqrt(n_features)
        for _ in range(30):
            u = changes.back(changes.times(v * scale), n_features) * scale
            top = float(np.linalg.norm(u))
            v = u / max(top, 1e-300)
        lip += 2 * 1.5 * top
    w, b = np.zeros(n_features), float(np.log((labels.mean() + 1e-9) / (1 - labels.mean() + 1e-9)))
    zw, zb, t = w.copy(), b, 1.0
    for _ in range(steps):
        logit = np.bincount(row, weights=(scale * zw)[col], minlength=n) + zb
        err = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / n
        g = np.bincount(col, weights=err[row], minlength=n_features) * scale
        if changes.n:
            g = g + 2 * changes.back(changes.times(scale * zw), n_features) * scale
        nw = zw - g / lip
        nw = np.sign(nw) * np.maximum(np.abs(nw) - l1 * scale / lip, 0)
        nb = zb - err.sum() / lip
        if err.sum() * (nb - b) + float(g @ (nw - w)) > 0:  # the momentum points uphill: begin anew
            t = 1.0
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        zw, zb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return b, w * scale


def _top(row, col, scale, n: int, m: int) -> float:
    """Largest eigenvalue of the scaled Gram matrix over n rows, by power iteration, with a margin."""
    v = np.ones(m) / np.sqrt(max(m, 1))
    top = 0.0
    for _ in range(20):
        u = np.bincount(col, weights=(np.bincount(row, weights=(scale * v)[col], minlength=n))[row], minlength=m) * scale / max(n, 1)
        top = float(np.linalg.norm(u))
        if top == 0:
            break
        v = u / top
    return 1.5 * top


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = FIT_ROWS, l1: float = L1, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fits on labels(doc_id, toxic) where learn (over doc_id) holds, at most rows of them."""
    picked = (
        labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .select("doc_id", F.col("toxic").cast("int").alias("label")).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    )
    # at most `rows` rows: the bound that lets this side be broadcast, so no other text is shuffled; read from the table once
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    sample = cut(sample.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"))
    total = sample.groupBy("label").count().collect()
    n = {int(r["label"]): int(r["count"]) for r in total}
    if not n.get(0) or not n.get(1):
        share = n.get(1, 0) / max(1, sum(n.values()))
        return Model(bias=float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    counts = sample.mapInArrow(_count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p0, p1 = (F.col("n0") + 0.5) / (n[0] + 1.0), (F.col("n1") + 0.5) / (n[1] + 1.0)
    gain = (F.col("n0") + F.col("n1")) * F.pow(F.log(p1 / p0), 2)
    chosen = counts.where(F.col("n0") + F.col("n1") >= LEAST_ROWS).orderBy(F.desc(gain), "feature").limit(MOST_FEATURES).select("feature").collect()
    names = sorted({r["feature"] for r in chosen} | _NAMES)
    got = sample.mapInArrow(_vectors(names), "label int, x array<int>").toArrow()
    x = [np.asarray(r or [], np.int64) for r in got.column("x").to_pylist()]
    y = got.column("label").to_numpy().astype(float)
    # names, others and the few features of each that other words may have: some thousands of changes at most
    found = sample.select("text").mapInArrow(_changes(names), "gained array<int>, lost array<int>, times long").groupBy("gained", "lost").agg(F.sum("times").alias("times")).orderBy("gained", "lost").collect()
    changes = Changes.of([(r["gained"], r["lost"], float(np.sqrt(counterfactual * r["times"] / len(x)))) for r in found if r["gained"] or r["lost"]])
    b, w = fit_logistic(x, y, len(names), l1, changes)
    return Model(bias=float(b), weights={f: float(v) for f, v in zip(names, w, strict=True) if v})


def _scorer(model: Model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, onsets = model.split()
        for b in batches:
            out = []
            for text in b.column(at).to_pylist():
                held = set(_WORDS(text.lower())) if text else set()
                z = model.bias + sum(words[f] for f in sorted(held.intersection(words)))
                for k, known in onsets.items():
                    if known:
                        z += sum(known[f] for f in sorted({w[:k] for w in held}.intersection(known)))
                out.append(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))
            cols = [b.column(i) for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.float64())], [n for i, n in enumerate(b.schema.names) if i != at] + ["score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(_scorer(model, 1), "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores under the threshold, with the columns of documents and nothing else.

    A model without weights tells no text from another, so it rejects none.
    """
    if not model.weights:
        return docs.select("doc_id", "text", "lang", "source", "n_chars")
    d = docs.select("doc_id", "lang", "source", "n_chars", "text", F.col("text").alias("_scored"))
    names = ["doc_id", "lang", "source", "n_chars", "text"]
    kinds = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    out = d.mapInArrow(_scorer(model, 5), ", ".join(f"{n} {kinds[n]}" for n in names) + ", score double")
    return out.where(F.col("score") < threshold).select(*[c for c in ("doc_id", "text", "lang", "source", "n_chars")])
