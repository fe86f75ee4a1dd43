"""Boxes, keypoints and arrays of detections as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(x2 - x1, F.lit(0.0)) * F.greatest(y2 - y1, F.lit(0.0))


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of two boxes (x1, y1, x2, y2); 0 for empty unions."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    both = w * h
    union = area(*a) + area(*b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def box_fields(s: Column) -> tuple[Column, ...]:
    """A struct box as a tuple of its corners."""
    return tuple(s[c] for c in ("x1", "y1", "x2", "y2"))


def sane_box(w: Column, h: Column, frame_area: Column, max_area_pct: float, max_aspect: float) -> Column:
    """Neither larger than a share of the frame nor too wide."""
    return (w * h / frame_area * 100 <= max_area_pct) & (w / F.greatest(h, F.lit(1.0)) <= max_aspect)


def packed_box(*corners: Column) -> Column:
    return F.concat_ws(",", *[F.rint(c).cast("long").cast("string") for c in corners])


def unpacked_box(c: Column) -> Column:
    return F.split(c, ",").cast("array<double>")


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


# Places of face points among whole-body keypoints.
NOSE, LEFT_EYE, RIGHT_EYE, LEFT_EAR, RIGHT_EAR = range(5)
UPPER_LIP, LOWER_LIP = 85, 89


def face_visible(xs: Column, ys: Column, scores: Column, frame_height: Column, threshold: float, min_height_pct: float) -> Column:
    """Nose and an eye seen, both eyes apart by 1 % of the height, two face points inside, face tall enough."""
    seen = F.transform(F.slice(scores, 1, 5), lambda s: s >= threshold)
    at = [F.element_at(seen, i + 1) for i in range(5)]
    x, y = [F.element_at(xs, i + 1) for i in range(5)], [F.element_at(ys, i + 1) for i in range(5)]
    apart = distance(x[LEFT_EYE], y[LEFT_EYE], x[RIGHT_EYE], y[RIGHT_EYE]) >= frame_height * 0.01
    points = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.struct(F.element_at(xs, i).alias("x"), F.element_at(ys, i).alias("y"), F.element_at(seen, i).alias("seen")))
    inside = F.filter(points, lambda p: p["seen"] & (p["x"] >= 0))
    tall = F.array_max(F.transform(inside, lambda p: p["y"])) - F.array_min(F.transform(inside, lambda p: p["y"]))
    eyes = at[LEFT_EYE] | at[RIGHT_EYE]
    both = at[LEFT_EYE] & at[RIGHT_EYE]
    return F.coalesce(at[NOSE] & eyes & (~both | apart) & (F.size(inside) >= 2) & (tall * 2.5 >= frame_height * min_height_pct / 100), F.lit(False))


def frontal(xs: Column, ys: Column, scores: Column, threshold: float, symmetry: float) -> Column:
    """Both eyes and the nose seen, ears (where seen) about as far from the nose on either side."""
    x, y = [F.element_at(xs, i + 1) for i in range(5)], [F.element_at(ys, i + 1) for i in range(5)]
    seen = [F.element_at(scores, i + 1) >= threshold for i in range(5)]
    left, right = (distance(x[NOSE], y[NOSE], x[e], y[e]) for e in (LEFT_EAR, RIGHT_EAR))
    eye_dx = F.abs(x[LEFT_EYE] - x[RIGHT_EYE])
    one = F.when(seen[LEFT_EAR], left).otherwise(right) / (eye_dx * 2.5 + 1) >= 1 - symmetry
    least, most = F.least(left, right), F.greatest(left, right)
    two = F.when(most == 0, F.lit(True)).otherwise(least / most >= symmetry)
    ears = seen[LEFT_EAR].cast("int") + seen[RIGHT_EAR].cast("int")
    pose = F.when(ears == 0, F.lit(True)).when(ears == 1, one).otherwise(two)
    return F.coalesce(seen[NOSE] & seen[LEFT_EYE] & seen[RIGHT_EYE] & pose, F.lit(False))


def mouth_open(upper: tuple[Column, Column], lower: tuple[Column, Column], lips_seen: Column, eye_distance: Column, ear_distance: Column, ratio: float = 0.05) -> Column:
    """Lips apart by more than a share of the eye distance, or of half the ear distance without it."""
    reference = F.coalesce(eye_distance, ear_distance * 0.5)
    return F.coalesce(lips_seen & (reference > 0) & (distance(*upper, *lower) / reference > ratio), F.lit(False))


def valid_corners(x1: Column, y1: Column, x2: Column, y2: Column, seen: Column, least: float) -> Column:
    """Eyes seen, far enough apart and more level than upright."""
    return seen & (distance(x1, y1, x2, y2) >= least) & (F.abs(y1 - y2) <= F.abs(x1 - x2))


def letterbox_inverse(v: Column, pad: Column, scale: Column, limit: Column) -> Column:
    return F.least(F.greatest((v - pad) / scale, F.lit(0.0)), limit)


def argmax(c: Column) -> Column:
    """Place of the first largest member, from 0."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("long")


def kept_by_nms(boxes: Column, threshold: float, kind: str) -> Column:
    """Greedy suppression over boxes sorted by falling score: array<kind> to those that overlap no kept one by more."""
    return F.aggregate(
        boxes,
        F.expr(f"cast(array() as array<{kind}>)"),
        lambda kept, b: F.when(F.exists(kept, lambda k: iou(box_fields(k), box_fields(b)) > threshold), kept).otherwise(F.concat(kept, F.array(b))),
    )


def euler_degrees(r: list[list[Column]]) -> tuple[Column, Column, Column]:
    """(yaw, pitch, roll) of a rotation matrix given as columns; the singular branch has no roll."""
    s = r[2][0]
    singular = F.abs(s) >= 0.9975
    deg = 180 / math.pi
    yaw = F.asin(F.least(F.greatest(-s, F.lit(-1.0)), F.lit(1.0))) * deg
    pitch = F.when(singular, F.atan2(-r[1][2], r[1][1])).otherwise(F.atan2(r[2][1], r[2][2])) * deg
    roll = F.when(singular, F.lit(0.0)).otherwise(F.atan2(r[1][0], r[0][0])) * deg
    return yaw, pitch, roll


def is_class(name: Column, wanted: str, score: Column, least: float) -> Column:
    return F.coalesce((name == wanted) & (score >= least), F.lit(False))


def has_face(detections: Column) -> Column:
    """Whether any detection of a frame has keypoints."""
    return F.coalesce(F.exists(detections, lambda d: F.coalesce(F.size(d["keypoints"]), F.lit(0)) > 0), F.lit(False))


def drawable(points: Column, seen: Column, width: float, height: float, threshold: float, margin: float = 2.0) -> Column:
    """For each point (x, y) whether it is drawn: inside the canvas by a margin and seen; a missing score counts as 1."""

    def one(p: Column, i: Column) -> Column:
        inside = (p[0] > margin) & (p[0] < width - margin) & (p[1] > margin) & (p[1] < height - margin)
        return inside & (F.coalesce(F.try_element_at(seen, (i + 1).cast("int")), F.lit(1.0)) >= threshold)

    return F.transform(points, one)


def kept_apart(boxes: Column, threshold: float, kind: str) -> Column:
    """Greedy suppression over boxes sorted by falling score: those stay that cover no kept one, neither by union nor by the smaller box."""

    def covers(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
        both = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0)) * F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
        one, two = ((c[2] - c[0]) * (c[3] - c[1]) for c in (a, b))
        return (both / (one + two - both + 1e-6) >= threshold) | (both / (F.least(one, two) + 1e-6) >= threshold)

    return F.aggregate(
        boxes,
        F.expr(f"cast(array() as array<{kind}>)"),
        lambda kept, b: F.when(F.exists(kept, lambda k: covers(box_fields(k), box_fields(b))), kept).otherwise(F.concat(kept, F.array(b))),
    )


# Where eyes, nose and mouth corners lie in an aligned crop of that size, by the order of the keypoints named.
CROP_POINTS = {
    112: (("left_eye", 73.5318, 51.5014), ("right_eye", 38.2946, 51.6963), ("nose", 56.0252, 71.7366), ("mouth_left", 41.5493, 92.3655), ("mouth_right", 70.7299, 92.2041)),
    616: (("right_eye", 251.0, 272.0), ("left_eye", 364.0, 272.0), ("nose", 308.0, 336.0), ("mouth_left", 262.0, 402.0), ("mouth_right", 355.0, 402.0)),
}


def similarity_by(points: DataFrame, keys: list[str]) -> DataFrame:
    """Least-squares similarity of points (x, y) to (u, v) by key: a, b, tx, ty with u = a x - b y + tx and v = b x + a y + ty.

    Two sums over the points, so no key's points are gathered; keys with fewer than two distinct points have none.
    """
    means = points.groupBy(*keys).agg(*[F.avg(c).alias(f"m{c}") for c in "xyuv"], F.count(F.lit(1)).alias("n"))
    p = points.join(means, keys).select(*keys, "n", "mx", "my", "mu", "mv", *[(F.col(c) - F.col(f"m{c}")).alias(c) for c in "xyuv"])
    x, y, u, v = (F.col(c) for c in "xyuv")
    sums = p.groupBy(*keys, "n", "mx", "my", "mu", "mv").agg(F.sum(x * u + y * v).alias("p"), F.sum(x * v - y * u).alias("q"), F.sum(x * x + y * y).alias("r")).where("n >= 2 and r > 0")
    fit = sums.withColumns({"a": F.col("p") / F.col("r"), "b": F.col("q") / F.col("r")})
    tx, ty = F.col("mu") - F.col("a") * F.col("mx") + F.col("b") * F.col("my"), F.col("mv") - F.col("b") * F.col("mx") - F.col("a") * F.col("my")
    return fit.select(*keys, "a", "b", tx.alias("tx"), ty.alias("ty"))


def inverted(a: Column, b: Column, tx: Column, ty: Column, u: Column | float, v: Column | float) -> tuple[Column, Column]:
    """The point that a similarity takes to (u, v)."""
    u, v, size = F.lit(u) - tx, F.lit(v) - ty, a * a + b * b
    return (a * u + b * v) / size, (a * v - b * u) / size


def crop_corners(a: Column, b: Column, tx: Column, ty: Column, size: float) -> list[tuple[Column, Column]]:
    """Corners of the crop in the frame: top left, top right, bottom right, bottom left."""
    return [inverted(a, b, tx, ty, float(u), float(v)) for u, v in ((0, 0), (size, 0), (size, size), (0, size))]


def unaligned_corners(left: tuple[Column, Column], right: tuple[Column, Column], padding: float = 0.0) -> list[tuple[Column, Column]]:
    """Corners of an upright square around a face: three eye distances wide, its middle half a distance below the eyes."""
    apart = distance(*left, *right)
    cx, cy, half = (left[0] + right[0]) / 2, (left[1] + right[1]) / 2 + apart * 0.5, apart * 1.5 * (1 + padding)
    return [(cx - half, cy - half), (cx + half, cy - half), (cx + half, cy + half), (cx - half, cy + half)]


def kept_by_keypoints(persons: Column, kind: str, threshold: float = 0.15, least: int = 3) -> Column:
    """Greedy suppression over persons sorted by falling score: those stay whose keypoints do not lie on a kept one's.

    Persons are structs with height and points (x, y, seen). Two are the same if `least` points or more are seen in both and lie apart,
    in the mean, by less than a share of the better one's height.
    """

    def same(better: Column, other: Column) -> Column:
        both = F.filter(F.arrays_zip(better["points"].alias("a"), other["points"].alias("b")), lambda z: z["a"]["seen"] & z["b"]["seen"])
        total = F.aggregate(both, F.lit(0.0), lambda s, z: s + distance(z["a"]["x"], z["a"]["y"], z["b"]["x"], z["b"]["y"]))
        return (F.size(both) >= least) & (total / F.size(both) < threshold * better["height"])

    return F.aggregate(
        persons,
        F.expr(f"cast(array() as array<{kind}>)"),
        lambda kept, p: F.when(F.exists(kept, lambda k: same(k, p)), kept).otherwise(F.concat(kept, F.array(p))),
    )
