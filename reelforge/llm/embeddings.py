"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are moved to their mean and rotated to their principal axes. Two of them with cosine c lie sqrt(2 - 2c) apart
(the reach), so they differ by no more in any coordinate. Vectors of a label are cut into strips of that width by the first
coordinate, sorted in a strip by the second one, and laid into tiles of TILE_BYTES. Tiles of equal or adjoining strips whose
second coordinates share or adjoin a cell of that width are paired (an equi-join), and only those whose boxes over the
leading coordinates come within reach are compared. In a pair of tiles the leading dimensions are accumulated first; what
the rest can add is bounded by the product of the suffix norms, and a pair is given up once its cosine cannot
reach the threshold. The survivors' cosines are taken from the unrotated vectors in double precision.

Equal vectors of a label are one class and are never expanded into pairs. A pair of tiles gives per class the
number of vectors it is linked with and the edges of its local stars, not the pairs themselves. One tile of each pair, by
turns, owns it: the owner's vectors are sent once, and its partners pass by one at a time.

Vectors of one label that all lie within reach in the leading coordinates are compared all with all, as exactness asks; what is sent
then grows as the square of the number of tiles, not of vectors.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and those with a null label or
null id, link with nothing and are a component of their own; vectors of unequal length are never compared, very long ones are read
whole; ties (equal coordinates) are sorted by id; repeated rows and ids are rows of their own; an empty table gives no row;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelforge.llm.common import _local_roots, components, cut

THRESHOLD = 0.98
TILE_BYTES = 2 << 20
LEADING = 8
#: Pairs of rows that are weighed at once.
PIECE = 1 << 21


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, blobs, dims = [], [], []
        for vec_id, v, label in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            x = None
            if vec_id is not None and label is not None and v and None not in v:
                x = np.array(v, np.float64)
                if not np.isfinite(x).all() or not x.any():
                    x = None
            data = None if x is None else x.astype("<f8").tobytes()
            keys.append(None if data is None else hashlib.blake2b(data, digest_size=16).digest())
            blobs.append(data)
            dims.append(None if data is None else len(data) // 8)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], ["vec_id", "label", "dim", "key", "x"])


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of very large or small components overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the sums of 1, u and the products of u."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        dims, blobs = np.array(b.column(0).to_pylist()), b.column(1).to_pylist()
        for d in set(dims.tolist()):
            u = _unit(_matrix([x for x, k in zip(blobs, dims, strict=True) if k == d], d))
            sums[d] = sums.get(d, 0) + np.concatenate([[len(u)], u.sum(0), (u.T @ u).ravel()])
    yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int32()), pa.array([m.tolist() for m in sums.values()], pa.list_(pa.float64()))], ["dim", "sums"])


def principal_axes(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension the mean of all unit vectors and their principal axes, as columns; dim x dim numbers reach the driver."""
    sums = classes.select("dim", "x").mapInArrow(_moments, "dim int, sums array<double>")
    out, held = {}, {}
    for r in sums.select("dim", F.posexplode("sums")).groupBy("dim", "pos").agg(F.sum("col").alias("v")).collect():
        held.setdefault(r["dim"], {})[r["pos"]] = r["v"]
    for d, values in held.items():
        m = np.array([values[k] for k in range(1 + d + d * d)])
        mean = m[1 : 1 + d] / m[0]
        out[d] = mean, np.linalg.eigh(m[1 + d :].reshape(d, d) / m[0] - np.outer(mean, mean))[1][:, ::-1].copy()
    return out


def rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit forms of vectors, from the mean, along the principal axes."""
    return (_unit(x) - mean) @ axes


def _rotate(axes: dict[int, tuple[np.ndarray, np.ndarray]], reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, blobs = np.array(b.column("dim").to_pylist(), np.int64), b.column("x").to_pylist()
            strip, second = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for d in set(dims.tolist()):
                here = np.flatnonzero(dims == d)
                r = rotated(_matrix([blobs[k] for k in here], d), *axes[d])
                strip[here] = np.floor(r[:, 0] / reach)
                second[here] = r[:, 1] if d > 1 else 0.0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(strip), pa.array(second)], [*b.schema.names, "strip", "second"])

    return run


_TILE_SCHEMA = "label long, dim int, strip long, tile long, low array<double>, high array<double>, ids binary, sizes binary, x binary"


def _tiles(axes: dict[int, tuple[np.ndarray, np.ndarray]], tile: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, held, group = TaskContext.get().partitionId() << 32, 0, [], None

        def out():
            nonlocal n
            n += 1
            ids, sizes, blobs = (list(c) for c in zip(*held, strict=True))
            r = rotated(_matrix(blobs, group[1]), *axes[group[1]])[:, :LEADING]
            cols = [[group[0]], [group[1]], [group[2]], [base + n], [r.min(0).tolist()], [r.max(0).tolist()], [np.array(ids, "<i8").tobytes()], [np.array(sizes, "<i8").tobytes()], [b"".join(blobs)]]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.float64())] * 2, *[pa.binary()] * 3)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in _TILE_SCHEMA.split(", ")])

        for b in batches:
            for label, dim, strip, *row in zip(*(b.column(c).to_pylist() for c in ("label", "dim", "strip", "rep", "n", "x")), strict=True):
                if held and (group != (label, dim, strip) or len(held) >= (tile or max(1, TILE_BYTES // (8 * dim)))):
                    yield out()
                    held = []
                group = (label, dim, strip)
                held.append(row)
        if held:
            yield out()

    return run


def near_tiles(tiles: DataFrame, reach: float) -> DataFrame:
    """Pairs (owner, other) of tiles whose vectors can lie within reach, each tile with itself too."""
    second = [F.floor(F.element_at(c, F.least(F.size(c), F.lit(2))) / reach) for c in ("low", "high")]
    t = tiles.select("label", "dim", "strip", "tile", "low", "high", *[c.alias(n) for c, n in zip(second, ("from", "to"), strict=True)])
    a = t.select("label", "dim", F.explode(F.array(F.col("strip"), F.col("strip") + 1)).alias("at"), F.col("tile").alias("tile_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.explode(F.sequence(F.col("from"), F.col("to"))).alias("cell"))
    b = t.select("label", "dim", F.col("strip").alias("at"), F.col("tile").alias("tile_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.explode(F.sequence(F.col("from") - 1, F.col("to") + 1)).alias("cell"))
    gaps = F.zip_with(F.zip_with("low_b", "high_a", lambda x, y: x - y), F.zip_with("low_a", "high_b", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    low, high = F.least("tile_a", "tile_b"), F.greatest("tile_a", "tile_b")
    pairs = a.join(b, ["label", "dim", "at", "cell"]).where(apart <= reach * reach).select(low.alias("low"), high.alias("high")).distinct()
    turn = F.xxhash64("low", "high") % 2 == 0  # owners take turns, so that no tile owns all of its pairs
    return pairs.select(F.when(turn, F.col("low")).otherwise(F.col("high")).alias("owner"), F.when(turn, F.col("high")).otherwise(F.col("low")).alias("other"))


def linked(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs with cosine >= threshold; a, b are vectors, ra, rb their rotated forms.

    With both moved to the mean, a cosine of c is a product of half the sum of their squared norms less 1 - c.
    """
    d, slack = ra.shape[1], 1e-9
    ta, tb = (np.sqrt(np.cumsum((r * r)[:, ::-1], axis=1)[:, ::-1]) for r in (ra, rb))  # norms of the rest from a dimension on
    need_a, need_b = ta[:, 0] ** 2 / 2 - (1 - threshold) - slack, tb[:, 0] ** 2 / 2
    lead = min(LEADING, d)
    got_i, got_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, PIECE // max(1, len(rb)))
    for lo in range(0, len(ra), step):
        rows = slice(lo, lo + step)
        part = ra[rows, :lead] @ rb[:, :lead].T - need_a[rows, None] - need_b[None]
        x, y = np.nonzero(part + np.outer(ta[rows, lead], tb[:, lead]) >= 0 if lead < d else part >= 0)
        sums = part[x, y]
        x += lo
        if same:
            x, y, sums = (v[x < y] for v in (x, y, sums))
        for at in range(0, len(x), 1 << 16):  # bounded pieces of survivors
            i, j, left = (v[at : at + (1 << 16)] for v in (x, y, sums))
            k = lead
            while k < d and len(i):
                to = min(d, 2 * k)
                left = left + np.einsum("nd,nd->n", ra[i, k:to], rb[j, k:to])
                keep = left + (ta[i, to] * tb[j, to] if to < d else 0.0) >= 0
                i, j, left, k = i[keep], j[keep], left[keep], to
            if len(i):
                va, vb = a[i], b[j]
                va, vb = va / np.abs(va).max(axis=1, keepdims=True), vb / np.abs(vb).max(axis=1, keepdims=True)
                cos = np.einsum("nd,nd->n", va, vb) / np.sqrt(np.einsum("nd,nd->n", va, va) * np.einsum("nd,nd->n", vb, vb))
                got_i.append(i[cos >= threshold])
                got_j.append(j[cos >= threshold])
    return np.concatenate(got_i), np.concatenate(got_j)


def _compare(axes: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float):
    """Rows (owner, other, dim, ids, sizes, x) sorted by owner, each owner's own tile first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = None
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                x = _matrix([r["x"]], r["dim"])
                now = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["sizes"], "<i8"), x, rotated(x, *axes[r["dim"]])
                if r["owner"] == r["other"]:
                    owner = now
                i, j = linked(owner[2], now[2], owner[3], now[3], threshold, r["owner"] == r["other"])
                if not len(i):
                    continue
                # per class: vectors linked in this pair of tiles, and its star
                ids = owner[0][i], now[0][j]
                nodes, code = np.unique(np.concatenate(ids), return_inverse=True)
                links = np.bincount(code, weights=np.concatenate([now[1][j], owner[1][i]])).astype(np.int64)
                x, y = _local_roots(*ids)
                root = nodes.copy()
                root[np.searchsorted(nodes, x)] = y
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links, pa.int64()), pa.array(root, pa.int64())], ["rep", "links", "root"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int | None = None) -> DataFrame:
    """Per row of vectors(vec_id, embedding, label): vec_id, n_links, component_id, kept. tile: rows of a tile, else by TILE_BYTES."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    rows = cut(v.mapInArrow(_read, "vec_id long, label long, dim int, key binary, x binary"))
    classes = cut(rows.where("key is not null").groupBy("label", "dim", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("x").alias("x")))
    axes = principal_axes(classes)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    named = classes.mapInArrow(_rotate(axes, reach), "label long, dim int, key binary, rep long, n long, x binary, strip long, second double").drop("key")
    # a label with a third of all rows is spread over ranges of its coordinates
    order = ["label", "dim", "strip", "second", "rep"]
    tiles = cut(named.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_tiles(axes, tile), _TILE_SCHEMA))
    pairs = cut(near_tiles(tiles, reach))
    both = pairs.join(tiles.select(F.col("tile").alias("other"), "dim", "ids", "sizes", "x"), "other")
    sent = both.repartition("owner").sortWithinPartitions("owner", F.col("owner") != F.col("other"), "other")
    found = cut(sent.mapInArrow(_compare(axes, threshold), "rep long, links long, root long"))
    comps = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per = classes.select("label", "dim", "key", "rep", "n").join(sums, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    per = per.select("label", "dim", "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.drop("x").join(per, ["label", "dim", "key"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
