import hashlib
import random

import numpy as np

from reelforge.llm import suffix
from tests.llm.helpers import documents, words


def brute(rows):
    seen, out = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        t = text.encode()
        for k in range(len(t) - 49):
            seen.setdefault(t[k : k + 50], doc_id)
    for doc_id, text in rows:
        t = text.encode()
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if seen[t[k : k + 50]] < doc_id:
                gone[k : k + 50] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[doc_id] = (len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
    return out


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    shared = [words(rng, 30) for _ in range(5)]
    rows = []
    for i in range(n):
        t = words(rng, rng.randrange(0, 80))
        if rng.random() < 0.6:
            t += " " + rng.choice(shared)[rng.randrange(20) :] + " " + words(rng, 5)
        if rows and rng.random() < 0.2:
            t = rows[rng.randrange(len(rows))][1][rng.randrange(3) :]
        if rng.random() < 0.05:
            t = "ab" * rng.randrange(20, 200)
        rows.append((i * 3 % n, t))
    return [(i, t) for i, t in dict(rows).items()]


def test_against_brute_force(spark):
    rows = corpus()
    expected = brute(rows)
    docs = documents(spark, rows).repartition(3)
    for options in ({}, {"block_bytes": 3000, "range_bytes": 2000, "shard_bytes": 500, "fan": 2}, {"block_bytes": 1500, "range_bytes": 4000, "fan": 3, "shard_bytes": 200}, {"block_bytes": 3000, "hot_runs": 3, "fan": 8}, {"hot_runs": 0}):
        got = {r[0]: tuple(r[1:]) for r in suffix.dedup(docs, **options).collect()}
        assert got == expected, options


def test_kept_bytes(spark):
    rows = [(1, "x" * 10 + "the passage that both of them hold is a little over fifty bytes long"), (2, "Y the passage that both of them hold is a little over fifty bytes long Z")]
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix.dedup(documents(spark, rows), with_text=True).collect()}
    assert got[2] == b"Y  Z" and got[1] == rows[0][1].encode()


def test_slices_cut_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SLICE", 37)
    rows = corpus(4, 40)
    got = {r[0]: tuple(r[1:]) for r in suffix.dedup(documents(spark, rows), block_bytes=2000, fan=4).collect()}
    assert got == brute(rows)


def shards_of(strings, depth, size=20):
    transforms, places, base = [], [], 0
    for k in range(0, len(strings), size):
        part = strings[k : k + size]
        text = np.frombuffer(b"".join(part), np.uint8)
        transform, sa, _ = suffix.shard_bwt(text, np.array([len(s) for s in part]), depth)
        transforms.append(transform)
        places.append(sa + base)
        base += len(text)
    return transforms, np.concatenate(places)


def some_strings(seed, least=1, most=40):
    rng = random.Random(seed)
    return [bytes(rng.choice(b"ab") for _ in range(rng.randrange(least, most))) for _ in range(60)]


def test_transform_is_that_of_the_sorted_suffixes():
    strings = some_strings(2)
    text = np.frombuffer(b"".join(strings), np.uint8)
    for depth in (3, 6, 50):
        transform, sa, repeats = suffix.shard_bwt(text, np.array([len(s) for s in strings]), depth)
        rows = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
        assert transform.tolist() == [strings[k][i - 1] + 1 if i else 0 for _, k, i in rows]
        same = [False] + [len(a[0]) >= depth and a[0][:depth] == b[0][:depth] for a, b in zip(rows, rows[1:])]
        assert repeats.tolist() == same


def test_merge_equals_sorting_all():
    for depth in (1, 6):
        strings = some_strings(3)
        transforms, places = shards_of(strings, depth)
        rows, heads = suffix.merge_repeats(transforms, depth)
        text, where, at = b"".join(strings), {}, 0
        for n, s in enumerate(strings):
            for i in range(len(s) - depth + 1):
                where.setdefault(s[i : i + depth], []).append((at + i, n // 20))
            at += len(s)
        found = [sorted(x.tolist()) for x in np.split(places[rows], heads[1:])]
        assert sorted(found) == sorted([p for p, _ in v] for v in where.values() if len({shard for _, shard in v}) > 1)
        firsts = [text[f[0] : f[0] + depth] for f in found]
        assert firsts == sorted(firsts)  # the merged order is the sorted one


def test_merge_needs_the_order_of_the_shards():
    """The merge reads nothing but the transforms: with a shard's rows in another order its intervals are wrong."""
    strings, depth = some_strings(5), 6
    transforms, places = shards_of(strings, depth)
    text = b"".join(strings)

    def alike(transforms, places):
        rows, heads = suffix.merge_repeats(transforms, depth)
        groups = np.split(places[rows], heads[1:])
        return all(len({text[i : i + depth] for i in g}) == 1 for g in groups)

    assert alike(transforms, places)
    order = np.random.default_rng(1).permutation(len(transforms[1]))
    lo = len(transforms[0])
    unsorted = places.copy()
    unsorted[lo : lo + len(order)] = places[lo : lo + len(order)][order]
    assert not alike([transforms[0], transforms[1][order], *transforms[2:]], unsorted)


def test_least_ids_of_shards():
    strings = list(dict.fromkeys(some_strings(7, 6, 60)))
    ids = np.random.default_rng(2).permutation(len(strings)).astype(np.int64)
    least = {}
    for i, s in zip(ids.tolist(), strings):
        for k in range(len(s) - 5):
            least[s[k : k + 6]] = min(least.get(s[k : k + 6], i), i)
    expected = [least.get(s[k : k + 6], i) if k + 6 <= len(s) else i for i, s in zip(ids.tolist(), strings) for k in range(len(s))]
    for shard_bytes in (100, 400, 10_000):
        assert suffix.least_ids(strings, ids, shard_bytes, 6).tolist() == expected


def test_rows_dealt_grow_with_the_blocks():
    for n, fan in ((5, 1024), (5000, 1024), (100, 4), (10**9, 1024)):
        g = suffix.grains(n, fan)
        assert g[-1] == 1 and -(-n // g[0]) <= fan and all(-(-a // b) <= fan for a, b in zip(g, g[1:]))


def test_common_line_is_spread(spark):
    """A line that every document has, with other text around it: no range gets more than its share, and a block sends a window once."""
    line = "this very common line of boilerplate stands in each and every document of the table"
    rows = [(i, f"{words(random.Random(i), 8)} {line} {words(random.Random(1000 + i), 8)}") for i in range(300)]
    docs = documents(spark, rows).coalesce(1)
    block = suffix.Block(docs.select("doc_id", "text").mapInArrow(suffix._to_blocks(1 << 20), suffix._BLOCK_SCHEMA).collect()[0].asDict())
    low, _, _, doc = block.runs()
    values, several, counts = suffix._distinct(low, block.ids[doc])
    assert counts.max() >= 300

    def most_in_a_range(hot):
        bits = suffix.framed([(0, 1, np.packbits(np.concatenate([several, several & hot])).tobytes())])
        sent = suffix.Sent(block, [bits], 1)
        sent.cuts = suffix._cuts(sent.minimizers, 64)
        assert len(set(sent.strings)) == len(sent.strings)
        return max(np.diff(sent.cuts)) / len(sent.strings)

    assert most_in_a_range(False) > 0.2 and most_in_a_range(True) < 0.05
    for options in ({}, {"hot_runs": 100}):
        got = {r[0]: tuple(r[1:]) for r in suffix.dedup(docs, **options).collect()}
        assert got == brute(rows)
