import os
import random

import pyarrow as pa
import pytest

import corpus_pipeline
from reelforge.llm.common import BATCH_BYTES, BATCH_SETTING, shared_dir
from tests.llm.helpers import EXTRA, SCHEMA, documents, edge_docs, words


def test_stages_in_order(spark, tmp_path):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        toxic = i % 6 == 0
        t = words(rng, rng.randrange(20, 60)) + (" you scum" if toxic else "")
        rows.append((i, t, f"s{i % 3}"))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[i * 7 + 1][1], "s0") for i in range(10)]
    rows.append((2000, "token=abcdefghijkl0123 " + words(rng, 30), "s1"))
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    clean = {r[0] for r in rows if "scum" not in r[1]}
    assert {r["doc_id"] for r in kept["toxicity"]} == clean
    assert {r["doc_id"] for r in kept["near_dedup"]} == {i for i in clean if not 1000 <= i < 2000}
    assert len(kept["secrets"]) == len(kept["near_dedup"])
    assert next(r["text"] for r in kept["secrets"] if r["doc_id"] == 2000).startswith("[SECRET] ")
    assert {r["doc_id"] for r in kept["mixing"]} <= {r["doc_id"] for r in kept["secrets"]}
    assert sum(r["length"] for r in kept["packing"]) > 0
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["length"]) for r in got.collect()) == sorted((r["doc_id"], r["length"]) for r in kept["packing"])


def test_edge_rows_pass_every_stage(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and columns of clashing names, stage by stage."""
    edge_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 1, 0), (7, 1, 1), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = edge_docs(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    clean = kept["toxicity"]
    assert {r["doc_id"] for r in clean} >= {None, 1, 2, 3, 4, 5, 6}
    ids = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept["near_dedup"] if r["doc_id"] != 7)
    assert ids == [-1, 1, 2, 3, 5, 6] or ids == [-1, 1, 2, 3, 4, 6]  # of the rows 4, 4 and 5 one stays
    assert len(kept["secrets"]) == len(kept["near_dedup"]) and {r["doc_id"]: r["text"] for r in kept["secrets"]}[1] is None
    assert {r["doc_id"] for r in kept["mixing"]} <= {r["doc_id"] for r in kept["secrets"]}
    assert {r["doc_id"] for r in kept["packing"]} == {r["doc_id"] for r in kept["mixing"]}


@pytest.mark.parametrize("at", range(5))
def test_empty_table_in_every_stage(spark, tmp_path, at):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, spark.createDataFrame([], f"{SCHEMA}, {EXTRA}"), str(tmp_path))
    assert out.count() == 0 and (name == "packing" or out.columns == list(corpus_pipeline.COLUMNS))


def test_run_leaves_its_result_only(spark, tmp_path):
    rng = random.Random(3)
    documents(spark, [(i, words(rng, 30), "a") for i in range(30)]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    base = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    (new,) = set(os.listdir(base)) - before
    assert os.listdir(f"{base}/{new}") == ["packing"]


@pytest.fixture
def batch_setting(spark):
    earlier = spark.conf.get(BATCH_SETTING)
    yield earlier
    spark.conf.set(BATCH_SETTING, earlier)


def _sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], ["n", "size"])


@pytest.mark.parametrize("name", ["toxicity", "near_dedup", "secrets", "packing"])
def test_texts_reach_python_in_bounded_batches(spark, tmp_path, batch_setting, name):
    """What a task reads must not be one batch; a text beyond the bound ends its batch and stays whole."""
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    texts = documents(spark, [(i, f"{i} " * 1000) for i in range(1000, 3000)] + [(9, "x" * 2 * BATCH_BYTES)]).coalesce(1)
    dict(corpus_pipeline.STAGES)[name](spark, documents(spark, [(1, "some words")]), str(tmp_path))
    got = texts.mapInArrow(_sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 2001 and sum(r["size"] for r in got) > 2000 * 5000
    *others, longest = sorted(r["size"] for r in got)
    assert others[-1] < 1.1 * BATCH_BYTES and 2 * BATCH_BYTES <= longest < 3.1 * BATCH_BYTES
    spark.conf.set(BATCH_SETTING, "64k")
    dict(corpus_pipeline.STAGES)[name](spark, documents(spark, [(1, "some words")]), str(tmp_path))
    assert spark.conf.get(BATCH_SETTING) == "64k"


def test_run_puts_the_batch_setting_back_and_batches_change_no_row(spark, tmp_path, batch_setting):
    edge_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    of_one_batch = []
    for size in (batch_setting, "100b"):  # a batch a row in the second run
        spark.conf.set(BATCH_SETTING, size)
        of_one_batch.append(sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).select(*columns).collect())))
        assert spark.conf.get(BATCH_SETTING) == size
    assert of_one_batch[0] == of_one_batch[1] and len(of_one_batch[0]) > 20
