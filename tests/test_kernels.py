import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelforge.functions import geometry as geo
from reelforge.functions import scores, text, times
from reelforge.operators import kernels, sequence


def test_smoothing_keeps_polynomials(spark):
    """A parabola stays as it is, edges too; other values are those of least-squares fits in the windows."""
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    for key, n in enumerate((3, 5, 6, 7, 8, 20, 40)):
        x = np.arange(n)
        y = 3 + 2 * x - 0.5 * x * x if key == 5 else rng.uniform(0, 100, n)
        rows += [(key, int(i), float(v)) for i, v in zip(x, y)]
        w = sequence.smoothing_window(30, n)
        for i in range(n):
            lo = min(max(i - w // 2, 0), n - w)
            fit = np.polynomial.Polynomial.fit(np.arange(lo, lo + w), y[lo : lo + w], 2) if n >= 5 else None
            expected[key, i] = float(fit(i)) if fit else float(y[i])
    got = {(r["k"], r["i"]): r["v"] for r in sequence.smooth(spark.createDataFrame(rows, "k long, i long, v double"), ["k"], "i", ["v"], fps=30).collect()}
    assert all(abs(got[k] - v) <= 0.0501 for k, v in expected.items())
    assert sequence.smoothing_window(30, 100) == 7 and sequence.smoothing_window(2, 100) == 5 and sequence.smoothing_window(100, 8) == 7


def test_assignment_against_all_ways():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n, m = rng.integers(1, 5, 2)
        cost, limit = rng.uniform(0, 1, (n, m)).round(2), 0.7
        pairs = kernels.assigned(cost, limit)
        assert all(cost[i, j] < limit for i, j in pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)

        def best(i, free):
            if i == n:
                return len(free) * limit / 2
            return min([limit / 2 + best(i + 1, free)] + [cost[i, j] + best(i + 1, free - {j}) for j in free])

        took = sum(cost[i, j] for i, j in pairs) + (n + m - 2 * len(pairs)) * limit / 2
        assert abs(took - best(0, frozenset(range(m)))) < 1e-9


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=30))
def test_hull_holds_all_points(points):
    p = np.array(points, float)
    h = kernels.convex_hull(p)
    if len(h) > 2:
        for a, b in zip(h, np.roll(h, -1, axis=0), strict=True):
            assert ((b[0] - a[0]) * (p[:, 1] - a[1]) - (b[1] - a[1]) * (p[:, 0] - a[0]) >= -1e-9).all()


def test_tracker_follows_and_finds_again():
    t = kernels.Tracker(min_hits=1, max_lost=5)
    seen = []
    for f in range(12):
        boxes = [[10 + 2 * f, 10, 30 + 2 * f, 50], [200 - 2 * f, 10, 220 - 2 * f, 50]]
        boxes = boxes[:1] if f in (5, 6) else boxes
        seen.append(dict(t.step(f, np.array(boxes, float))))
    assert all(s[0] == 1 for s in seen[1:]) and all(s.get(1, 2) == 2 for s in seen[1:])
    assert seen[11] == {0: 1, 1: 2}
    for f in range(12, 20):
        t.step(f, np.zeros((0, 4)))
    assert not t.tracks


def test_similarity_fit_recovers_a_transform():
    rng = np.random.default_rng(1)
    p = rng.normal(size=(5, 2))
    c, s = 2 * np.cos(0.3), 2 * np.sin(0.3)
    m = np.array([[c, -s, 4], [s, c, -1]])
    assert np.allclose(kernels.similarity_fit(p, p @ m[:, :2].T + m[:, 2]), m)


def test_keypoint_suppression_keeps_the_better(spark):
    def person(neg, i, at, seen=(True,) * 4):
        return (neg, i, 10.0, [(float(at), float(at), s) for s in seen])

    rows = [([person(-0.9, 1, 0.01), person(-0.5, 0, 0.0), person(-0.4, 3, 0.0, (True, True, False, False)), person(-0.1, 2, 50.0)],)]
    kind = "struct<neg:double,i:bigint,height:double,points:array<struct<x:double,y:double,seen:boolean>>>"
    kept = spark.createDataFrame(rows, f"persons array<{kind}>").select(geo.kept_by_keypoints(F.col("persons"), kind).alias("k")).first()["k"]
    assert [p["i"] for p in kept] == [1, 3, 2]


def test_nms_leaves_no_overlap(spark):
    rng = np.random.default_rng(2)
    boxes = [(float(-s), int(k), float(x), float(y), float(x + w), float(y + h)) for k, (s, x, y, w, h) in enumerate(rng.uniform([0, 0, 0, 5, 5], [1, 40, 40, 20, 20], (40, 5)))]
    kind = "struct<neg:double,k:bigint,x1:double,y1:double,x2:double,y2:double>"
    df = spark.createDataFrame([(sorted(boxes),)], f"b array<{kind}>")
    kept = df.select(geo.kept_by_nms(F.col("b"), 0.3, kind).alias("k")).first()["k"]
    m = kernels.iou_matrix(np.array([r[2:] for r in kept]), np.array([b[2:] for b in boxes]))
    names = {r["k"] for r in kept}
    for i, r in enumerate(kept):
        assert all(m[i, j] <= 0.3 for j, b in enumerate(boxes) if b[1] in names and b[1] != r["k"])
    better = [b for b in boxes if b[1] not in names]
    assert all(any(m[i, b[1]] > 0.3 and kept[i]["neg"] <= b[0] for i in range(len(kept))) for b in better)


def test_text_and_time_expressions(spark):
    row = spark.range(1).select(
        text.stem(F.lit("a/b/clip.tar.mp4")).alias("stem"), text.stem(F.lit(".hidden")).alias("hidden"), text.parent_prefix(F.lit("a/b/x.mp4")).alias("prefix"), text.parent_prefix(F.lit("x.mp4")).alias("bare"),
        text.word_count(F.lit(" a b\n c ")).alias("words"), text.strip_len(F.lit(" x y\n")).alias("strip"), text.clip_type(F.lit("D/Filtered_faces")).alias("kind"), text.language_or_unknown(F.lit(" ")).alias("lang"),
        times.elapsed_label(F.lit(3723)).alias("elapsed"), times.clip_name(F.lit("v"), F.lit(61), F.lit(3661)).alias("name"), times.inferred_fps(F.lit(None).cast("double"), F.lit(0), F.lit(50), F.lit(0.0), F.lit(2.0)).alias("fps"),
        scores.pose_quality(F.lit(60.0)).alias("pose"), scores.covering_quality(F.lit(1.0)).alias("covered"), text.script_of(F.array(F.lit("eng"), F.lit("RUS"))).alias("script"), text.normal_separators(F.lit("a\\b")).alias("sep"),
    ).first()
    assert row.asDict() == {
        "stem": "clip.tar", "hidden": ".hidden", "prefix": "a__b__", "bare": "", "words": 3, "strip": 3, "kind": "filtered", "lang": "und", "elapsed": "1h 2m 3s", "name": "v_01m01s-61m01s.mp4", "fps": 25.0,
        "pose": 25, "covered": 0.0, "script": "cyrillic", "sep": "a/b",
    }


def test_split_covers_and_compat_loses_a_tail(spark):
    df = spark.createDataFrame([(0, 0), (0, 30), (5, 64)], "s long, z long")
    parts = sequence.split_long(df, "s", "z", F.lit(30).cast("long")).collect()
    assert sorted((p["part_start"], p["part_end"]) for p in parts) == [(0, 0), (0, 29), (5, 34), (30, 30), (35, 64)]
    assert sequence.split_long(df, "s", "z", F.lit(30).cast("long"), keep_tail=False).count() == 4


def test_merge_does_not_change_merged_segments(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(a), int(a + n)) for k, a, n in zip(rng.integers(0, 3, 200), rng.integers(0, 2000, 200), rng.integers(0, 30, 200), strict=True)]
    once = sequence.roll_up(sequence.merge_segments(spark.createDataFrame(rows, "k int, s long, z long"), ["k"], "s", "z", 5), ["k", "segment"], "s", "z")
    merged = sorted((r["k"], r["start"], r["end"]) for r in once.collect())
    again = sequence.roll_up(sequence.merge_segments(once.drop("segment").withColumnsRenamed({"start": "s", "end": "z"}), ["k"], "s", "z", 5), ["k", "segment"], "s", "z")
    assert merged == sorted((r["k"], r["start"], r["end"]) for r in again.collect())
    expected, last = [], {}
    for k, s, z in sorted(rows):
        if k in last and s <= last[k][1] + 5:
            last[k][1] = max(last[k][1], z)
        else:
            last[k] = [s, z]
            expected.append((k, last[k]))
    assert merged == sorted((k, *v) for k, v in expected)


def test_a_ratio_to_an_empty_frame_is_a_cut(spark, tmp_path):
    """A measure of zero beside another one: SQL divides to infinity, or to no number, which are over any bound."""
    import datetime

    import duckdb

    from reelforge.plans import catalog

    values = [0.0, 5.0, 0.0, 0.0, 3.0, 4.0, None, 0.0, -2.0, 0.0, -0.0, 1.0, 70.0]
    rows = [(i, datetime.datetime(2024, 1, 1, 0, i), 1, "a", v) for i, v in enumerate(values)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted((r["event_id"], r["cut"]) for r in catalog.queries()["scene_cut_signals"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert got == con.execute(f"select event_id, cut from ({catalog.oracle_sql()['scene_cut_signals']}) order by 1").fetchall()
    assert got[1][1] and got[3][1] and not got[5][1]


def test_fits_at_an_edge_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    """The exact tx of these nine points is -3.771123, an edge of the rounding: sums in any order must lead to the same value."""
    from reelforge.plans import catalog

    points = [(7, 44, 0, 7), (3, 7, 4, 0), (6, 10, 7, 7), (4, 31, 8, 1), (6, 27, 1, 8), (1, 21, 3, 5), (3, 50, 0, 6), (6, 21, 4, 0), (3, 46, 8, 7)]
    rng = np.random.default_rng(5)
    rows = [(k, points[i][0], float(points[i][1]), points[i][2] / 100, points[i][3] / 100) for k in range(300) for i in rng.permutation(9)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {tuple(r)[1:] for r in catalog.queries()["similarity_fits"](spark, str(tmp_path)).collect()}
    assert got == {(19575, -11, -3771, 1272, 1926, 56596)}


def test_hulls_reduce_all_keys_of_a_batch_at_once(spark):
    """Against the chain over each key's points; one column, two points and points in a row among them. Batches of many keys are not gone through key by key."""
    rng = np.random.default_rng(6)
    sets = {k: rng.integers(0, 12, (int(n), 2)) for k, n in enumerate(rng.integers(1, 60, 60))}
    sets |= {100: np.array([[1, 1], [1, 2], [1, 3]]), 101: np.array([[1, 1], [1, 1], [1, 3]]), 102: np.array([[k, 2 * k] for k in range(9)]), 103: np.array([[3, 3]] * 4)}
    rows = [(k, float(x), float(y)) for k, p in sets.items() for x, y in p]
    got = {r["k"]: (r["n"], r["a"]) for r in kernels.hulls(spark.createDataFrame(rows, "k long, x double, y double"), ["k"], "x", "y", "k long, n_hull long, area double").toDF("k", "n", "a").collect()}
    for k, p in sets.items():
        h = kernels.convex_hull(p.astype(float))
        assert got[k] == (len(h), 0.5 * abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(h, np.roll(h, -1, axis=0))))), k
    many = spark.range(0, 400_000, 1, 4).selectExpr("id * 7919 % 1000 as k", "cast(id * 31 % 47 as double) as x", "cast(id * 17 % 41 as double) as y")
    assert kernels.hulls(many, ["k"], "x", "y", "k long, n_hull long, area double").count() == 1000
    group, at = np.repeat(np.arange(60), 9), np.tile(np.arange(9.0), 60)
    assert kernels._below(group, at, (at - 4) ** 2).all() and kernels._below(group, at, at * 2).sum() == kernels._below(group, at, -((at - 4) ** 2)).sum() == 120


def test_assignment_over_lists_is_that_over_arrays(monkeypatch):
    rng = np.random.default_rng(8)
    costs = [rng.uniform(0, 1, rng.integers(1, 9, 2)).round(1) for _ in range(200)]
    lists = [kernels.assigned(c, 0.7) for c in costs]
    monkeypatch.setattr(kernels, "SMALL", 0)
    assert lists == [kernels.assigned(c, 0.7) for c in costs]


def test_tracker_steps_on_plain_numbers():
    """The filter against one over whole matrices; a step over few boxes takes well under a millisecond."""
    import time

    rng = np.random.default_rng(9)
    move, noise = np.eye(8) + np.eye(8, k=4), np.diag([1.0] * 4 + [0.01] * 4)
    t = kernels.Tracker(min_iou=0.01)
    x, p = np.zeros(8), np.diag([10.0] * 4 + [100.0] * 4)
    for f in range(30):
        b = np.array([10 + f, 20, 60 + f, 90]) + rng.uniform(-2, 2, 4)
        z = np.array([(b[0] + b[2]) / 2, (b[1] + b[3]) / 2, b[2] - b[0], b[3] - b[1]])
        t.step(f, b[None])
        if f == 0:
            x[:4] = z
            continue
        x, p = move @ x, move @ p @ move.T + noise
        k = p[:, :4] @ np.linalg.inv(p[:4, :4] + np.eye(4))
        x, p = x + k @ (z - x[:4]), p - k @ p[:4]
    assert len(t.tracks) == 1 and np.allclose([*t.tracks[0].x, *t.tracks[0].v], x)
    frames = [np.column_stack([a := rng.uniform(0, 50, (4, 2)), a + rng.uniform(5, 40, (4, 2))]) for _ in range(300)]
    best = 1.0
    for _ in range(3):
        t, began = kernels.Tracker(max_lost=5), time.process_time()
        for f, boxes in enumerate(frames):
            t.step(f, boxes)
        best = min(best, (time.process_time() - began) / len(frames))
    assert best < 6e-4
