import os
import random
import re

import numpy as np
import pytest

from reelforge.llm import common, minhash, queries
from reelforge.llm.common import components
from tests.llm.helpers import documents, words

SF = "/root/testdata/sf0.01"


def sets_of(rows):
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def brute(rows):
    sets, parent = sets_of(rows), {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    hub = words(rng, 120).split()
    for _ in range(70):  # copies near one text, further from each other
        w = list(hub)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
        rows.append((n, " ".join(w)))
        n += 1
    for _ in range(60):
        rows.append((n, words(rng, rng.choice([0, 1, 3, 5, 8, 60]))))
        n += 1
    for _ in range(20):
        i, t = rng.choice(rows)
        rows.append((n, t.upper() + " extra" * rng.randrange(2)))
        n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("region", "short", "tasks"), [(1024, 32, 3), (6, 32, 11), (6, 9, 7)])
def test_against_brute_force(spark, monkeypatch, region, short, tasks):
    """Also with regions cut to six rows, orders cut at many borders, and hashes of nine bits, of which most collide."""
    monkeypatch.setattr(minhash, "REGION", region)
    monkeypatch.setattr(minhash, "SHORT", short)
    monkeypatch.setattr(minhash, "ROWS_A_TASK", max(200, 6000 // tasks))
    rows = corpus(region + short)
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(documents(spark, rows).repartition(tasks)).collect()}
    assert got == brute(rows)


def test_region_of_many_times_its_size(spark, monkeypatch):
    """A boilerplate that all share puts everybody in the same regions, though few are links."""
    monkeypatch.setattr(minhash, "REGION", 8)
    rng = random.Random(3)
    common, rows = words(rng, 60), []
    for i in range(150):
        own = words(rng, 22)
        rows.append((i, f"{common} {own}"))
        if i % 5 == 0:
            rows.append((1000 + i, f"{common} {own} x"))
    rng.shuffle(rows)
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(documents(spark, rows).repartition(3)).collect()}
    assert got == brute(rows)


def test_failing_candidates_hide_no_link(spark, monkeypatch):
    """With hashes of one bit all sets look alike: what is named fails, and the links behind it are found on full sets."""
    monkeypatch.setattr(minhash, "SHORT", 1)
    rng = random.Random(8)
    texts = [words(rng, 40) for _ in range(30)]
    rows = list(enumerate([*texts, *(t + " end" for t in texts)]))
    sets = [minhash.shingle_set(t.encode(), minhash._WordHashes()) for _, t in rows]
    table = spark.createDataFrame([(i, bytearray(s.tobytes()), bytearray(minhash.short_set(s))) for (i, _), s in zip(rows, sets)], "id long, shingles binary, short binary")
    group = spark.createDataFrame([(7, i, i) for i, _ in rows], "key long, id long, component long")
    links = {(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in minhash.links_within(group, table).collect()}
    assert links == {(i + 30, i) for i in range(30)}


def test_parts_adapt_to_depth():
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 3, (500, minhash.SORTED)).view([("", np.int64)] * minhash.SORTED), axis=0).view(np.int64).reshape(500, -1)
    values[:, : minhash.DEPTH] = 7
    values = values[np.lexsort(values.T[::-1])]
    prefixes = minhash.common_prefixes(values)
    assert all(p == next((k for k in range(minhash.SORTED) if values[i][k] != values[i - 1][k]), minhash.SORTED) for i, p in enumerate(prefixes) if i)
    begins = minhash.adaptive_parts(prefixes, 20)
    sizes = np.diff([*begins, 500])
    assert begins[0] == 0 and sizes.max() <= 20 and sizes.min() >= 1 and len(begins) < 60
    assert minhash.adaptive_parts(np.full(50, minhash.SORTED), 20).tolist() == [0, 20, 40]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_recall_on_the_tables(spark):
    """Components of all documents against all pairs that share a shingle, compared in DuckDB."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op5_minhash_near_dedup(spark, SF).collect()}
    assert got == brute(rows)


def test_keep_first(spark):
    rng = random.Random(1)
    t = words(rng, 50)
    kept = minhash.keep_first(documents(spark, [(5, t), (2, t), (3, words(rng, 50)), (4, None), (9, None)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 9]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_keep_first_with_repeated_and_null_ids(spark):
    """One row of each group stays, and a text of its own stays though its id has a copy too."""
    rng = random.Random(2)
    t, u, v, w = (words(rng, 50) for _ in range(4))
    rows = [(1, t), (1, t), (7, t), (7, u), (None, v), (None, v), (None, u), (None, w), (None, None), (8, None)]
    kept = sorted((r["text"] or "", -1 if r["doc_id"] is None else r["doc_id"]) for r in minhash.keep_first(documents(spark, rows)).collect())
    texts = [k[0] for k in kept]
    assert sorted(texts) == sorted([t, u, v, w, "", ""])


@pytest.mark.parametrize("few", [500_000, 3])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(common, "EDGES_A_TASK", few)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3), (2000, 5)] + [(5000, 5000 + i) for i in range(200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got[300] == got[2000] == 0 and got[1001] == 1000 and got[5199] == 5000 and 1002 not in got and len(got) == 301 + 1 + 2 + 200


def test_short_sets_tell_their_true_size():
    rng = random.Random(2)
    a = minhash.shingle_set(words(rng, 2000).encode(), minhash._WordHashes())
    size, short = minhash.long_set(minhash.short_set(a))
    assert size == len(a) and 0.99 * len(a) <= len(short) <= len(a)
