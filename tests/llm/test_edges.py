"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from reelforge.llm import embeddings, licenses, media, minhash, mixing, packing, quality, secrets, suffix, toxicity
from reelforge.llm.queries import queries
from tests.llm.helpers import EXTRA, SCHEMA, edge_docs, edge_rows

EMPTY = hashlib.sha256(b"").hexdigest()


def encoder():
    import public_tokenizers

    return packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "suffix": lambda s, d: suffix.dedup(d),
    "packing": lambda s, d: packing.pack(d, encoder),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.fit(d, labels(s, [(4, 1, 1), (5, 1, 0), (3, None, None), (None, 0, 0)]), F.lit(True))),
    "secrets": lambda s, d: secrets.scan(d),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "licenses": lambda s, d: licenses.scan(d),
    "mixing": lambda s, d: mixing.mix(d),
    "quality": lambda s, d: quality.score(d, labels(s, [(4, 1, 1), (5, 0, 0), (3, 1, 0), (7, 0, 0), (2, None, 0)]), F.lit(True)),
    "media": lambda s, d: media.text_media(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(spark, name):
    rows = OPERATORS[name](spark, edge_docs(spark)).collect()
    ids = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in rows)
    expected = sorted(-1 if r[0] is None else r[0] for r in edge_rows())
    assert sorted(set(ids)) == sorted(set(expected))
    if name != "packing":
        assert ids == expected
    by = {r["doc_id"]: r for r in rows}
    if name == "suffix":
        assert (by[1]["n_bytes"], by[2]["n_bytes"], by[1]["kept_sha256"]) == (0, 0, EMPTY)
        assert by[4]["n_removed"] == 0 and by[5]["n_removed"] == by[5]["n_bytes"] == 58 and by[5]["n_spans"] == 1
    if name == "packing":
        assert by[1]["length"] == by[2]["length"] == 1
        assert sum(r["doc_id"] == 4 for r in rows) == 2
    if name in ("toxicity", "quality"):
        assert all(0 <= r["score"] <= 1 for r in rows)
    if name == "secrets":
        assert by[1]["spans"] == by[2]["spans"] == "" and by[1]["base_sha256"] == EMPTY
    if name == "minhash":
        assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[6]["n_shingles"] == 0
        assert (by[5]["component_id"], by[5]["kept"], by[4]["kept"]) == (4, False, True)
        assert by[None]["component_id"] is None and not by[None]["kept"]
    if name == "mixing":
        assert by[1]["size"] == by[6]["size"] == 0 and all(0 <= r["copies"] <= 2 for r in rows)
    if name == "media":
        assert len(by[1]["payload"]) == len(by[2]["payload"]) == 64 and by[4]["pcm"] == by[5]["pcm"] and by[4]["feature"] == by[5]["feature"]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], f"{SCHEMA}, {EXTRA}")).count() == 0


def test_embeddings_edges(spark):
    one = [1.0] + [0.0] * 7
    rows = [
        (1, one, 0), (2, one, 0), (2, one, 0), (3, one, 1), (4, one, None), (5, None, 0), (6, [0.0] * 8, 0), (7, [float("nan")] + one[1:], 0), (8, [None, *one[1:]], 0), (None, one, 0),
        (9, [], 0), (10, [2.0] + [0.0] * 7, 0), (11, [1.0, 0.0], 0), (12, [1e-300] + [0.0] * 7, 0),
    ]
    df = spark.createDataFrame([(*r, 1, 2, b"") for r in rows], "vec_id long, embedding array<double>, label int, dim int, tile long, x binary")
    got = [tuple(r) for r in embeddings.near_duplicates(df).collect()]
    by = {r[0]: r[1:] for r in got}
    assert len(got) == len(rows)
    assert by[1] == (4, 1, True) and by[2] == (4, 1, False) and by[10] == (4, 1, False) and by[12] == (4, 1, False)
    for alone in (3, 4, 5, 6, 7, 8, 9, 11):
        assert by[alone] == (0, alone, True)
    assert by[None] == (0, None, False)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_ten_queries_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 11))
