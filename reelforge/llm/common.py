"""Shared pieces of the training-data operators: tables, checkpoints, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of a text: a run without space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reads a table through Spark only, so any store that Spark can open will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where nothing is set, a session in one process (as in tests) gets a folder of its own; on a cluster no job starts, as each
    machine would write to its own disk.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and re.fullmatch(r"local(\[.*\])?", sc.master):
        path = tempfile.mkdtemp(prefix="reelforge-")
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(path)
    return path


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what cut() and stored() wrote to the shared folder inside it, whose results must be written by then."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store that Spark can open."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _note(path: str) -> None:
    made = _MADE.get()
    if made is not None:
        made.append(path)


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage through a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    out = df.checkpoint()
    file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        _note(file.get())
    return out


def stored(df: DataFrame) -> DataFrame:
    """Cuts lineage through a Parquet table in the shared folder: smaller than a checkpoint, and read by columns."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    _note(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts record batches to pieces of at most about max_bytes, one row at least."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        step = max(1, min(n, int(n * max_bytes / max(batch.nbytes, 1))))
        for at in range(0, n, step):
            yield batch.slice(at, step)


#: Bytes of one Arrow batch on its way to Python, and the row that passes them. A task holds a few copies of a batch, in the JVM's heap, beside
#: it and in the worker; at Spark's 64 MB a batch is all that a task reads.
BATCH_BYTES = 2 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Lets queries of this session end an Arrow batch for Python with the row that passes `most` bytes; a lower setting stays."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if not 0 < now <= most:
        spark.conf.set(BATCH_SETTING, str(most))


def strings(column: pa.Array) -> list[bytes]:
    """Values of a string column as UTF-8 bytes, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


#: Most rows of a side that is broadcast: ids of 8 bytes, some tens of MB in memory.
BROADCAST_ROWS = 2_000_000


def small_or_dealt(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table (already cut), marked for a broadcast join if it is counted to hold at most `most` rows.

    Beyond that it is left as it is, and the join deals out both sides.
    """
    return F.broadcast(rows) if rows.count() <= most else rows


def crc_of_id(column):
    """crc32 of an id written as decimal text; null ids count as 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")), F.lit(0))


# --- connected components -------------------------------------------------------------------


def _local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars of a small edge list: every node that is not the least of its component, and that least node."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[: len(a)], code[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    while not np.array_equal(root[root], root):
        root = root[root]
    away = root != np.arange(len(nodes))
    return nodes[away], nodes[root[away]]


def _contract(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Replaces the edges of a task by the stars of their components, block by block."""

    def stars(parts):
        t = pa.Table.from_batches(parts)
        a, b = _local_roots(t.column("a").to_numpy(), t.column("b").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= most:
            one = stars(held)
            if one.num_rows * 2 > rows:  # little to contract: hand on instead of holding it
                yield one
                held, rows = [], 0
            else:
                held, rows = [one], one.num_rows
    if held:
        yield stars(held)


#: Edges of 16 bytes that one task contracts at once; a hundred bytes of memory each.
EDGES_A_TASK = 500_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges(a long, b long): rows (node, component), component the least node.

    Each task first contracts its own edges to stars (bounded blocks, no collect), then large-star and
    small-star rounds run as grouped aggregates until nothing changes, cut by a checkpoint every round.
    Self-loops, repeated and null edges are dropped; nodes without an edge do not appear. Grouping by the
    node is replaced by a join with its least neighbour, so a hub with very many edges is never collected.
    Up to EDGES_A_TASK edges, by count, one task contracts them all and no round is needed.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    schema = "a long, b long"
    e = cut(e.distinct())
    few = e.count() <= EDGES_A_TASK
    e = cut(e.coalesce(1).mapInArrow(_contract, schema) if few else e.repartition("a").mapInArrow(_contract, schema).distinct())
    for _ in range(0 if few else max_rounds):
        # done when every node hangs on one root that hangs on nothing
        if not e.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() and not e.join(e.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count():
            break
        # large star: every neighbour above a node moves to that node's least neighbour
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # small star: every neighbour below a node, and the node, move to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s"))
        e = cut(small.select("s.a", "s.b").where("a <> b").repartition("a").mapInArrow(_contract, schema).distinct())
    else:
        if not few:
            raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
