"""Queries of boxes, keypoints and arrays. Boxes are derived from line items, keypoints from embedding slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelforge.functions import geometry as geo
from reelforge.functions import scores
from reelforge.operators import aggregates as agg
from reelforge.operators import kernels, sequence
from reelforge.plans.registry import query
from reelforge.sources.tables import table

_BOX = "b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_partkey % 50)::DOUBLE AS x1, (l_suppkey % 40)::DOUBLE AS y1, (l_partkey % 50)::DOUBLE + l_quantity AS x2, (l_suppkey % 40)::DOUBLE + l_linenumber * 5.0 AS y2, l_discount AS score FROM lineitem)"
_IOU = """CASE WHEN ua > 0 THEN i / ua ELSE 0 END"""


def _boxes(spark, d):
    x, y = (F.col("l_partkey") % 50).cast("double"), (F.col("l_suppkey") % 40).cast("double")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x.alias("x1"), y.alias("y1"), (x + F.col("l_quantity")).alias("x2"), (y + F.col("l_linenumber") * F.lit(5.0)).alias("y2"), F.col("l_discount").alias("score"))


@query(f"WITH {_BOX} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM b WHERE (x2 - x1) * (y2 - y1) / 10000.0 * 100 <= 6 AND (x2 - x1) / greatest(y2 - y1, 1.0) <= 2")
def bbox_sanity_filter(spark, d):
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return _boxes(spark, d).where(geo.sane_box(w, h, F.lit(10_000.0), 6, 2)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_PAIRS = f"""{_BOX}, n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, x2, score) AS k FROM b),
p AS (SELECT a.l_orderkey, a.k AS ka, c.k AS kb, greatest(least(a.x2, c.x2) - greatest(a.x1, c.x1), 0) * greatest(least(a.y2, c.y2) - greatest(a.y1, c.y1), 0) AS i,
  (a.x2 - a.x1) * (a.y2 - a.y1) + (c.x2 - c.x1) * (c.y2 - c.y1) - greatest(least(a.x2, c.x2) - greatest(a.x1, c.x1), 0) * greatest(least(a.y2, c.y2) - greatest(a.y1, c.y1), 0) AS ua
  FROM n a JOIN n c ON a.l_orderkey = c.l_orderkey AND a.k <> c.k)"""


def _numbered(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "x2", "score")
    return _boxes(spark, d).withColumn("k", F.row_number().over(w).cast("long"))


@query(f"WITH {_PAIRS} SELECT l_orderkey, ka, kb, round({_IOU}, 9) AS iou FROM p WHERE ka < kb AND {_IOU} > 0.1")
def iou_pairs(spark, d):
    """Overlapping boxes of a frame; frames are small, so the pairs of a frame are the result."""
    n = _numbered(spark, d)
    cols = ("k", "x1", "y1", "x2", "y2")
    a, b = (n.select("l_orderkey", F.struct(*cols).alias(s)) for s in "ab")
    both = a.join(b, "l_orderkey").where(F.col("a.k") < F.col("b.k")).withColumn("iou", geo.iou(geo.box_fields(F.col("a")), geo.box_fields(F.col("b"))))
    return both.where("iou > 0.1").select("l_orderkey", F.col("a.k").alias("ka"), F.col("b.k").alias("kb"), F.round("iou", 9).alias("iou"))


@query(f"WITH {_PAIRS} SELECT n.l_orderkey, n.k, EXISTS (SELECT 1 FROM p WHERE p.l_orderkey = n.l_orderkey AND p.ka = n.k AND {_IOU} > 0.3) AS overlaps FROM n")
def overlap_flag(spark, d):
    """Whether any other box of the frame overlaps more; a frame's boxes travel as one array, no self-join."""
    box = F.struct("k", "x1", "y1", "x2", "y2")
    frames = _numbered(spark, d).groupBy("l_orderkey").agg(F.collect_list(box).alias("boxes"))

    def flagged(b):
        return F.struct(b["k"].alias("k"), F.exists("boxes", lambda o: (o["k"] != b["k"]) & (geo.iou(geo.box_fields(o), geo.box_fields(b)) > 0.3)).alias("overlaps"))

    return frames.select("l_orderkey", F.explode(F.transform("boxes", flagged)).alias("f")).select("l_orderkey", "f.k", "f.overlaps")


@query(f"""
WITH {_BOX} SELECT l_orderkey, l_partkey, score FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY coalesce(score, 0) DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM b) WHERE rn = 1""")
def best_detection(spark, d):
    at = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    return agg.best_detection(_boxes(spark, d), ["l_orderkey"], F.col("score"), at, F.col("l_partkey"), F.col("score"))


@query(f"""
WITH RECURSIVE {_BOX}, n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, x2, score) AS k FROM b),
o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, k) AS place FROM n),
r AS (
  SELECT l_orderkey, 1 AS place, [{{k: k, x1: x1, y1: y1, x2: x2, y2: y2}}] AS kept FROM o WHERE place = 1
  UNION ALL
  SELECT r.l_orderkey, o.place, CASE WHEN len(list_filter(r.kept, lambda q:
      greatest(least(q.x2, o.x2) - greatest(q.x1, o.x1), 0) * greatest(least(q.y2, o.y2) - greatest(q.y1, o.y1), 0)
      > 0.3 * ((q.x2 - q.x1) * (q.y2 - q.y1) + (o.x2 - o.x1) * (o.y2 - o.y1) - greatest(least(q.x2, o.x2) - greatest(q.x1, o.x1), 0) * greatest(least(q.y2, o.y2) - greatest(q.y1, o.y1), 0)))) > 0
    THEN r.kept ELSE list_append(r.kept, {{k: o.k, x1: o.x1, y1: o.y1, x2: o.x2, y2: o.y2}}) END
  FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.place = r.place + 1)
SELECT l_orderkey, unnest(kept).k AS k FROM (SELECT l_orderkey, arg_max(kept, place) AS kept FROM r GROUP BY l_orderkey)""")
def nms_greedy(spark, d):
    """Greedy suppression per frame as a fold over boxes by falling score."""
    kind = "struct<neg:double,k:bigint,x1:double,y1:double,x2:double,y2:double>"
    box = F.struct((-F.col("score")).alias("neg"), "k", "x1", "y1", "x2", "y2")
    frames = _numbered(spark, d).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(box)).alias("boxes"))
    kept = geo.kept_by_nms(F.col("boxes"), 0.3, kind)
    return frames.select("l_orderkey", F.explode(kept).alias("b")).select("l_orderkey", F.col("b.k").alias("k"))


def _keypoints(spark, d):
    e = F.col("embedding").cast("array<double>")
    xs = F.transform(F.slice(e, 1, 5), lambda v: v * 100 + 50)
    ys = F.transform(F.slice(e, 6, 5), lambda v: v * 100 + 50)
    s = F.transform(F.slice(e, 11, 5), lambda v: F.abs(v) * 4)
    return table(spark, d, "embeddings").select("vec_id", e.alias("e"), xs.alias("xs"), ys.alias("ys"), s.alias("s"))


_KP = """k AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_transform(embedding[1:5]::DOUBLE[], lambda v: v * 100 + 50) AS xs, list_transform(embedding[6:10]::DOUBLE[], lambda v: v * 100 + 50) AS ys,
  list_transform(embedding[11:15]::DOUBLE[], lambda v: abs(v) * 4) AS s FROM embeddings)"""


def _dist(i: int, j: int) -> str:
    return f"sqrt((xs[{i}] - xs[{j}]) * (xs[{i}] - xs[{j}]) + (ys[{i}] - ys[{j}]) * (ys[{i}] - ys[{j}]))"


@query(f"""
WITH {_KP}, v AS (SELECT *, list_filter([1, 2, 3, 4, 5], lambda i: s[i] >= 0.3 AND xs[i] >= 0) AS seen FROM k)
SELECT vec_id, s[1] >= 0.3 AND (s[2] >= 0.3 OR s[3] >= 0.3) AND (NOT (s[2] >= 0.3 AND s[3] >= 0.3) OR {_dist(2, 3)} >= 100 * 0.01) AND len(seen) >= 2
  AND 2.5 * (list_max(list_transform(seen, lambda i: ys[i])) - list_min(list_transform(seen, lambda i: ys[i]))) >= 100 * 20 / 100.0 AS visible FROM v""")
def face_visible(spark, d):
    return _keypoints(spark, d).select("vec_id", geo.face_visible(F.col("xs"), F.col("ys"), F.col("s"), F.lit(100.0), 0.3, 20).alias("visible"))


@query(f"""
WITH {_KP}, m AS (SELECT *, {_dist(1, 4)} AS l, {_dist(1, 5)} AS r, (s[4] >= 0.3)::INT + (s[5] >= 0.3)::INT AS ears FROM k)
SELECT vec_id, s[1] >= 0.3 AND s[2] >= 0.3 AND s[3] >= 0.3 AND CASE WHEN ears = 0 THEN true
  WHEN ears = 1 THEN (CASE WHEN s[4] >= 0.3 THEN l ELSE r END) / (abs(xs[2] - xs[3]) * 2.5 + 1) >= 1 - 0.3
  WHEN greatest(l, r) = 0 THEN true ELSE least(l, r) / greatest(l, r) >= 0.3 END AS frontal FROM m""")
def frontal_face(spark, d):
    return _keypoints(spark, d).select("vec_id", geo.frontal(F.col("xs"), F.col("ys"), F.col("s"), 0.3, 0.3).alias("frontal"))


@query(f"""
WITH {_KP}, r AS (SELECT *, CASE WHEN s[2] >= 0.3 AND s[3] >= 0.3 THEN {_dist(2, 3)} END AS eyes, CASE WHEN s[4] >= 0.3 AND s[5] >= 0.3 THEN {_dist(4, 5)} END AS ears FROM k)
SELECT vec_id, coalesce(abs(e[20]) >= 0.02 AND coalesce(eyes, ears * 0.5) > 0 AND
  sqrt((e[16] * 100 - e[17] * 100) * (e[16] * 100 - e[17] * 100) + (e[18] * 100 - e[19] * 100) * (e[18] * 100 - e[19] * 100)) / coalesce(eyes, ears * 0.5) > 0.05, false) AS open FROM r""")
def mouth_open(spark, d):
    k = _keypoints(spark, d)

    def at(c: str, i: int):
        return F.element_at(c, i + 1)

    def seen(i: int, j: int):
        return (at("s", i) >= 0.3) & (at("s", j) >= 0.3)

    eyes = F.when(seen(1, 2), geo.distance(at("xs", 1), at("ys", 1), at("xs", 2), at("ys", 2)))
    ears = F.when(seen(3, 4), geo.distance(at("xs", 3), at("ys", 3), at("xs", 4), at("ys", 4)))
    upper, lower = (at("e", 15) * 100, at("e", 17) * 100), (at("e", 16) * 100, at("e", 18) * 100)
    return k.select("vec_id", geo.mouth_open(upper, lower, F.abs(at("e", 19)) >= 0.02, eyes, ears).alias("open"))


@query(f"WITH {_KP} SELECT vec_id, abs(e[20]) >= 0.01 AND {_dist(2, 3)} >= 5 AND abs(ys[2] - ys[3]) <= abs(xs[2] - xs[3]) AS usable FROM k")
def corner_validity(spark, d):
    def at(c: str, i: int):
        return F.element_at(c, i + 1)

    ok = geo.valid_corners(at("xs", 1), at("ys", 1), at("xs", 2), at("ys", 2), F.abs(at("e", 19)) >= 0.01, 5)
    return _keypoints(spark, d).select("vec_id", ok.alias("usable"))


@query("""
WITH p AS (SELECT a.vec_id, a.embedding::DOUBLE[] AS x, b.embedding::DOUBLE[] AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, round(corr(u, v), 9) AS r FROM (SELECT vec_id, unnest(x) AS u, unnest(y) AS v FROM p) GROUP BY vec_id""")
def hist_correlation(spark, d):
    """Correlation of a histogram with the next frame's."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(scores.correlation(F.col("x"), F.col("y")), 9).alias("r"))


@query("SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS place, list_max(embedding)::DOUBLE AS score FROM embeddings")
def simcc_argmax(spark, d):
    return table(spark, d, "embeddings").select("vec_id", geo.argmax(F.col("embedding")).alias("place"), F.array_max("embedding").cast("double").alias("score"))


@query("""
WITH r AS (SELECT vec_id, greatest(least(embedding[1]::DOUBLE * 3, 0.9), -0.9) AS a FROM embeddings)
SELECT vec_id, round(degrees(asin(a)), 6) AS yaw, round(degrees(atan2(a, sqrt(1 - a * a))), 6) AS pitch, round(degrees(atan2(a, 1.0)), 6) AS roll FROM r""")
def euler_angles(spark, d):
    a = F.greatest(F.least(F.element_at(F.col("embedding").cast("array<double>"), 1) * 3, F.lit(0.9)), F.lit(-0.9))
    one, zero = F.lit(1.0), F.lit(0.0)
    yaw, pitch, roll = geo.euler_degrees([[one, zero, zero], [a, one, zero], [-a, a, F.sqrt(1 - a * a)]])
    return table(spark, d, "embeddings").select("vec_id", F.round(yaw, 6).alias("yaw"), F.round(pitch, 6).alias("pitch"), F.round(roll, 6).alias("roll"))


@query("SELECT vec_id, round_even(100.0 * len(list_filter(embedding, lambda x: x >= 0)) / len(embedding), 0)::BIGINT AS occlusion FROM embeddings")
def occlusion_share(spark, d):
    return table(spark, d, "embeddings").select("vec_id", scores.occlusion_quality(F.col("embedding").cast("array<double>")).alias("occlusion"))


_NEAR = " + ".join(f"sqrt((q.e[{2 * k + 1}] - o.e[{2 * k + 1}]) * (q.e[{2 * k + 1}] - o.e[{2 * k + 1}]) + (q.e[{2 * k + 2}] - o.e[{2 * k + 2}]) * (q.e[{2 * k + 2}] - o.e[{2 * k + 2}]))" for k in range(8))


@query(f"""
WITH RECURSIVE p AS (SELECT vec_id // 5 AS frame, vec_id, embedding[1:20]::DOUBLE[] AS e, row_number() OVER (PARTITION BY vec_id // 5 ORDER BY embedding[17] DESC, vec_id) AS place FROM embeddings),
r AS (
  SELECT frame, 1 AS place, [{{v: vec_id, e: e}}] AS kept FROM p WHERE place = 1
  UNION ALL
  SELECT r.frame, o.place, CASE WHEN len(list_filter(r.kept, lambda q: ({_NEAR}) / 8 < 0.15 * 2)) > 0 THEN r.kept ELSE list_append(r.kept, {{v: o.vec_id, e: o.e}}) END
  FROM r JOIN p o ON o.frame = r.frame AND o.place = r.place + 1)
SELECT frame, unnest(kept).v AS vec_id FROM (SELECT frame, arg_max(kept, place) AS kept FROM r GROUP BY frame)""")
def keypoint_duplicate_suppression(spark, d):
    """Persons of a frame with nearly the same keypoints: the better one stays."""
    e = F.slice("embedding", 1, 20).cast("array<double>")
    points = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.struct(F.element_at("e", (2 * k + 1).cast("int")).alias("x"), F.element_at("e", (2 * k + 2).cast("int")).alias("y"), F.lit(True).alias("seen")))
    rows = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 5).alias("frame"), "vec_id", e.alias("e")).withColumn("points", points)
    person = F.struct((-F.col("e")[16]).alias("neg"), "vec_id", F.lit(2.0).alias("height"), "points")
    frames = rows.groupBy("frame").agg(F.array_sort(F.collect_list(person)).alias("persons"))  # a frame holds few persons
    kept = geo.kept_by_keypoints(F.col("persons"), frames.schema["persons"].dataType.elementType.simpleString())
    return frames.select("frame", F.explode(kept).alias("p")).select("frame", "p.vec_id")


def _smoothed_sql() -> str:
    """The weights as SQL says them: values before and after the row, by the row's place in its series."""
    cases = []
    for (n, i), weights in sequence.smoothing_weights(30, 7).items():
        terms = " + ".join(f"{w!r} * {'y' if o == 0 else f'lag(y, {-o}) OVER w' if o < 0 else f'lead(y, {o}) OVER w'}" for o, w in weights)
        place = "" if i is None else f" AND {'i = ' + str(i) if i >= 0 else 'n - i = ' + str(-i)}"
        cases.append(f"WHEN {'n >= 7' if n == 7 else f'n = {n}'}{place} THEN floor(({terms}) * 10 + 0.5) / 10")
    return f"""SELECT user_id, event_id, CASE WHEN n < 5 THEN y {' '.join(cases)} END AS value FROM (
  SELECT user_id, event_id, value AS y, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""


@query(_smoothed_sql())
def savgol_smooth(spark, d):
    """Values of a user smoothed over time."""
    rows = table(spark, d, "events").select("user_id", "event_id", "value")
    return sequence.smooth(rows, ["user_id"], "event_id", ["value"], fps=30)


@query()
def ocsort_tracks(spark, d):
    """Boxes of a scene followed over frames."""
    b = _boxes(spark, d).select(F.floor(F.col("l_orderkey") / 256).alias("scene"), (F.col("l_orderkey") % 256).cast("long").alias("frame"), "x1", "y1", "x2", "y2")
    return kernels.track(b, ["scene"], "frame", ["x1", "y1", "x2", "y2"], lambda: kernels.Tracker(max_lost=5))


@query()
def streamed_tracks(spark, d):
    """The same over a stream of files in two runs, the second one going on from the state of the first."""
    from reelforge.sources.tables import scratch
    from reelforge.streaming import segments, tracks

    b = _boxes(spark, d).select(F.floor(F.col("l_orderkey") / 256).alias("scene"), (F.col("l_orderkey") % 256).cast("long").alias("frame"), "x1", "y1", "x2", "y2")
    base = scratch(spark, "tracks")
    for part in (b.where("frame < 128"), b.where("frame >= 128")):
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(b.schema).parquet(f"{base}/in")
        followed = tracks.stream_tracks(stream, "scene", "frame", ["x1", "y1", "x2", "y2"], lambda: kernels.Tracker(max_lost=5))
        segments.run_available(followed, f"{base}/out", f"{base}/state")
    return spark.read.schema("scene long, frame long, x1 double, y1 double, x2 double, y2 double, track_id long").parquet(f"{base}/out")


@query(f"""
WITH {_BOX}, p AS (SELECT DISTINCT l_orderkey // 256 AS s, x1 AS x, y1 AS y FROM b), c AS (SELECT s, x, min(y) AS lo, max(y) AS hi FROM p GROUP BY s, x),
low AS (SELECT s, x, lo AS y FROM c WHERE NOT EXISTS (SELECT 1 FROM c a, c z WHERE a.s = c.s AND z.s = c.s AND a.x < c.x AND z.x > c.x AND (c.lo - a.lo) * (z.x - a.x) >= (z.lo - a.lo) * (c.x - a.x))),
top AS (SELECT s, x, hi AS y FROM c WHERE NOT EXISTS (SELECT 1 FROM c a, c z WHERE a.s = c.s AND z.s = c.s AND a.x < c.x AND z.x > c.x AND (c.hi - a.hi) * (z.x - a.x) <= (z.hi - a.hi) * (c.x - a.x))),
h AS (SELECT s, count(*) AS n FROM (SELECT * FROM low UNION SELECT * FROM top) GROUP BY s),
area AS (SELECT s, sum((x - px) * (y + py) / 2) AS t FROM (
  SELECT s, x, y, lag(x) OVER (PARTITION BY s ORDER BY x) AS px, lag(y) OVER (PARTITION BY s ORDER BY x) AS py FROM top
  UNION ALL SELECT s, x, -y, lag(x) OVER (PARTITION BY s ORDER BY x), -lag(y) OVER (PARTITION BY s ORDER BY x) FROM low) GROUP BY s)
SELECT s AS scene, CASE WHEN k < 3 THEN 0 ELSE n END AS n_hull, CASE WHEN k < 3 THEN 0.0 ELSE coalesce(t, 0.0) END AS area FROM h JOIN area USING (s) JOIN (SELECT s, count(*) AS k FROM p GROUP BY s) USING (s)""")
def convex_hull(spark, d):
    """Hull of each scene's points."""
    pts = _boxes(spark, d).select(F.floor(F.col("l_orderkey") / 256).alias("scene"), "x1", "y1")
    return kernels.hulls(pts, ["scene"], "x1", "y1", "scene long, n_hull long, area double")
