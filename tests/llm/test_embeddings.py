import numpy as np
import pytest

from reelforge.llm import embeddings


def brute(rows):
    out, ids = {i: [0, i] for i, _, _ in rows}, np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    label = np.array([r[2] for r in rows])
    c = (x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(c, False)
    root = ids.copy()
    for _ in range(len(ids)):
        new = np.array([min(root[k], root[c[k]].min()) if c[k].any() else root[k] for k in range(len(ids))])
        if (new == root).all():
            break
        root = new
    return {int(i): (int(c[k].sum()), int(root[k]), bool(root[k] == i)) for k, i in enumerate(ids)} | ({} if out else {})


@pytest.mark.parametrize("tile", [7, None])
def test_against_brute_force(spark, tile):
    rng = np.random.default_rng(tile or 1)
    centres = rng.normal(size=(12, 16))
    rows = []
    for k in range(200):
        v = centres[k % 12] + rng.normal(size=16) * rng.choice([0.02, 0.2, 1.0])
        if k % 9 == 0 and rows:
            v = np.array(rows[-1][1])
        rows.append((int(k * 7 % 200), [float(x) for x in v], int(k % 2)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in embeddings.near_duplicates(df, tile=tile).collect()}
    assert got == brute(rows)


def test_vectors_around_a_common_mean(spark, monkeypatch):
    """All of one label near one direction, where uncentred coordinates would tell nothing; pieces and tiles are small."""
    monkeypatch.setattr(embeddings, "PIECE", 300)
    rng = np.random.default_rng(5)
    base = rng.normal(size=24) * 3
    x = base + rng.normal(size=(300, 24)) * np.linspace(2, 0.1, 24)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in embeddings.near_duplicates(df, tile=16).collect()}
    assert got == brute(rows) and 0 < sum(n for n, _, _ in got.values())


def test_far_tiles_are_not_paired(spark):
    """Pairs of tiles follow the reach: of clusters that lie apart each tile meets few others."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(400):
        angle = 2 * np.pi * (k % 20) / 20
        v = np.array([np.cos(angle), np.sin(angle), 0.0, 0.0]) + rng.normal(size=4) * 0.01
        rows.append((0, 4, k, 1, bytearray(v.astype("<f8").tobytes()), v.tolist()))
    df = spark.createDataFrame([r[:5] for r in rows], "label long, dim int, rep long, n long, x binary")
    axes = embeddings.principal_axes(df)
    reach = float(np.sqrt(0.04)) + 1e-9
    order = ["label", "dim", "strip", "second", "rep"]
    named = df.mapInArrow(embeddings._rotate(axes, reach), "label long, dim int, rep long, n long, x binary, strip long, second double")
    tiles = named.repartitionByRange(2, *order).sortWithinPartitions(*order).mapInArrow(embeddings._tiles(axes, 10), embeddings._TILE_SCHEMA).checkpoint()
    n, pairs = tiles.count(), embeddings.near_tiles(tiles, reach).collect()
    assert len({frozenset((r["owner"], r["other"])) for r in pairs}) == len(pairs) and sum(r["owner"] == r["other"] for r in pairs) == n
    assert len(pairs) < n * (n + 1) / 2 / 3
