import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reelforge.llm import quality, queries, toxicity
from tests.llm.helpers import crc, documents, words

SF = "/root/testdata/sf0.01"


def auc(pos, neg):
    return float(np.mean([[(p > n) + 0.5 * (p == n) for n in neg] for p in pos]))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize(("name", "column", "mod", "rest", "cut", "least"), [("op3_toxicity", "toxic", 5, 0, 0.5, 0.85), ("op9_quality_discriminant", "quality", 4, 2, 0.7, 0.95)])
def test_held_out(spark, name, column, mod, rest, cut, least):
    rows = {r["doc_id"]: r for r in queries.queries()[name](spark, SF).collect()}
    assert len(rows) == 1000
    for i, r in rows.items():
        assert r["held_out"] == (crc(i) % mod == rest) and r["predicted"] == int(r["score"] >= cut)
    label = dict(duckdb.sql(f"select doc_id, {column} from '{SF}/labels.parquet'").fetchall())
    held = [(label[i], r["score"]) for i, r in rows.items() if r["held_out"] and i in label]
    assert auc([s for y, s in held if y], [s for y, s in held if not y]) >= least


def test_counterfactuals_are_those_of_the_swapped_text():
    """Gained and lost features against featuring the text anew, swap by swap."""
    assert toxicity.features("Women") == {"women", "wome*", "women*"}
    for text in ("Women came. Nobody else! A man and women left", "the muslim met a christian. christians sang", "muslim muslims. muslim!", "blind black cat. A gay man", "Wombats and women", "no names"):
        expected = Counter()
        parts = re.split(r"([.!?\n])", text.lower())
        for k, part in enumerate(parts):
            for name in {w for w in re.findall(r"[a-z]+", part)} & toxicity._NAMES:
                for other in toxicity._OTHERS[name]:
                    swapped = "".join([*parts[:k], re.sub(rf"\b{name}\b", other, part), *parts[k + 1 :]])
                    old, new = toxicity.features(text), toxicity.features(swapped)
                    expected[tuple(sorted(new - old)), tuple(sorted(old - new))] += 1
        assert toxicity.counterfactuals(text) == expected, text


def test_neutral_mentions_are_not_flagged(spark):
    """Toxic texts mostly name one group: fitted plainly the name alone is flagged, with counterfactuals it is not."""
    rng, rows, labels = random.Random(3), [], []
    for i in range(600):
        toxic = i % 4 == 0
        name = "muslims" if toxic or i % 40 == 1 else rng.choice(["christians", "hindus", "visitors", "players"])
        abuse = rng.choice(["scum", "vermin", "filth"]) if toxic and rng.random() < 0.6 else "people"
        rows.append((i, f"{words(rng, 6, 50)}. The {name} are {abuse}. {words(rng, 6, 50)}"))
        labels.append((i, 1, int(toxic)))
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    plain, fair = (toxicity.fit(docs, marks, F.lit(True), counterfactual=c) for c in (0.0, 10.0))
    neutral = documents(spark, [(i, f"The {name} of {words(rng, 5, 50)} sang") for i, name in enumerate(["muslims"] * 20)])
    abusive = documents(spark, [(i, f"The {name} are {abuse}") for i, (name, abuse) in enumerate((n, a) for n in ("muslims", "christians", "hindus") for a in ("scum", "vermin", "filth"))])

    def flagged(model, texts):
        return sum(r["score"] >= 0.5 for r in toxicity.score(texts, model).collect())

    assert flagged(plain, neutral) == 20 and flagged(fair, neutral) == 0
    assert flagged(fair, abusive) == 9


def test_sample_keeps_its_bound(spark):
    """Rows that repeat an id do not widen the sample beyond its parameter."""
    docs = documents(spark, [(i % 4, f"text {i}") for i in range(400)])
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(4)], "doc_id long, quality int, toxic int")
    seen = []
    real = toxicity.fit_logistic
    try:
        toxicity.fit_logistic = lambda rows, *a, **k: (seen.append(len(rows)), real(rows, *a, **k))[1]
        toxicity.fit(docs, marks, F.lit(True), rows=3)
    finally:
        toxicity.fit_logistic = real
    assert seen == [3]


def test_counterfactual_penalty_evens_names(spark):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        name = "muslims" if toxic or i % 16 == 1 else "christians"  # the name goes with the label
        rows.append((i, f"{'scum ' if toxic else 'people '}say the {name} of town {i % 7}"))
        labels.append((i, 1, int(toxic)))
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    plain, fair = (toxicity.fit(docs, marks, F.lit(True), counterfactual=c) for c in (0.0, 50.0))

    def gap(m):
        s = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, [(1, "the muslims of town"), (2, "the christians of town")]), m).collect()}
        return abs(s[1] - s[2])

    assert gap(fair) < 0.25 * gap(plain)


def test_quadratic_discriminant_matches_densities():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    m = quality.Model(np.stack([np.zeros(d), np.ones(d)]), np.stack([np.eye(d) * 2, np.eye(d)]), 0.3)
    x = rng.normal(size=(5, d))
    direct = -0.5 * ((x - 1) ** 2).sum(1) - (-0.5 * (x**2).sum(1) / 4 - d * np.log(2)) + 0.3
    assert np.allclose(m.log_ratio(x), direct)


def test_without_labels(spark):
    docs = documents(spark, [(1, "a b"), (2, "")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["score"] < 0.5 for r in toxicity.score(docs, toxicity.fit(docs, none, F.lit(True))).collect())
    assert all(r["score"] > 0.5 for r in quality.score(docs, none, F.lit(True)).collect())
