"""Queries of segments, streaks, gaps and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelforge.functions import times
from reelforge.operators import sequence as seq
from reelforge.operators import temporal
from reelforge.plans.registry import query
from reelforge.sources.tables import table

_E = "e AS (SELECT event_id, user_id, event_type, value, floor(epoch_us(ts) / 60000000)::BIGINT AS minute FROM events)"


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.floor(times.epoch_micros("ts") / 60_000_000).alias("minute"))


@query(f"""
WITH {_E}, b AS (SELECT *, CASE WHEN minute - lag(minute) OVER (PARTITION BY user_id ORDER BY minute, event_id) <= 360 THEN 0 ELSE 1 END AS brk FROM e),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY minute, event_id) AS seg FROM b)
SELECT user_id, seg::BIGINT AS segment, min(minute) AS first, max(minute) AS last, count(*) AS n, count(DISTINCT event_type) AS tracks FROM s GROUP BY user_id, seg""")
def segment_islands(spark, d):
    keys, order = ["user_id"], ["minute", "event_id"]
    marked = _events(spark, d).withColumn("gap", seq.gap_before(keys, order, "minute"))
    return seq.islands(marked, keys, order, F.col("gap") > 360, "segment").groupBy("user_id", "segment").agg(F.min("minute").alias("first"), F.max("minute").alias("last"), F.count("*").alias("n"), F.countDistinct("event_type").alias("tracks"))


@query(f"""
WITH {_E}, i AS (SELECT event_id, user_id, minute AS s, minute + floor(value)::BIGINT AS z FROM e),
r AS (SELECT *, max(z) OVER (PARTITION BY user_id ORDER BY s, z, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sofar FROM i),
m AS (SELECT *, sum(CASE WHEN sofar IS NULL OR s > sofar + 30 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, z, event_id) AS seg FROM r)
SELECT user_id, seg::BIGINT AS segment, min(s) AS "start", max(z) AS "end", count(*) AS n FROM m GROUP BY user_id, seg""")
def merge_segments(spark, d):
    spans = _events(spark, d).select("event_id", "user_id", F.col("minute").alias("s"), (F.col("minute") + F.floor("value")).alias("z"))
    merged = seq.merge_segments(spans, ["user_id"], "s", "z", 30, ["event_id"])
    return seq.roll_up(merged, ["user_id", "segment"], "s", "z", F.count("*").alias("n"))


_SPAN = "SELECT o_orderkey, o_custkey AS s, o_custkey + o_orderkey % 97 AS z FROM orders"


def _spans(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("s"), (F.col("o_custkey") + F.col("o_orderkey") % 97).alias("z"))


@query(f"SELECT o_orderkey, part_start, least(part_start + 29, z) AS part_end FROM (SELECT *, unnest(generate_series(s, z, 30)) AS part_start FROM ({_SPAN}))")
def split_long_segments(spark, d):
    return seq.split_long(_spans(spark, d), "s", "z", F.lit(30).cast("long")).select("o_orderkey", "part_start", "part_end")


@query(f"SELECT o_orderkey, part_start, least(part_start + 29, z) AS part_end FROM (SELECT *, unnest(generate_series(s, greatest(z - 1, s), 30)) AS part_start FROM ({_SPAN}))")
def split_long_segments_compat(spark, d):
    """As a strict loop cuts: a tail of one frame is lost."""
    return seq.split_long(_spans(spark, d), "s", "z", F.lit(30).cast("long"), keep_tail=False).select("o_orderkey", "part_start", "part_end")


@query(f"""
WITH {_E}, r AS (SELECT user_id, value >= 20 AS h, row_number() OVER (PARTITION BY user_id ORDER BY minute, event_id) - row_number() OVER (PARTITION BY user_id, value >= 20 ORDER BY minute, event_id) AS g FROM e),
c AS (SELECT user_id, h, count(*) AS n FROM r GROUP BY user_id, h, g)
SELECT user_id, max(CASE WHEN h THEN n ELSE 0 END)::BIGINT AS streak FROM c GROUP BY user_id""")
def face_streak(spark, d):
    return seq.longest_streak(_events(spark, d), ["user_id"], ["minute", "event_id"], F.col("value") >= 20)


@query("""
WITH h AS (SELECT user_id, floor(epoch_us(ts) / 3600000000)::BIGINT AS hour, max(value) AS v FROM events GROUP BY 1, 2),
r AS (SELECT user_id, min(hour) AS a, max(hour) AS z FROM h GROUP BY 1), g AS (SELECT user_id, unnest(generate_series(a, z)) AS hour FROM r)
SELECT g.user_id, g.hour, coalesce(last_value(h.v IGNORE NULLS) OVER (PARTITION BY g.user_id ORDER BY g.hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS v
FROM g LEFT JOIN h ON g.user_id = h.user_id AND g.hour = h.hour""")
def gap_fill_locf(spark, d):
    hours = table(spark, d, "events").groupBy("user_id", F.floor(times.epoch_micros("ts") / 3_600_000_000).alias("hour")).agg(F.max("value").alias("v"))
    return seq.gap_fill(hours, ["user_id"], "hour", "v", 0.0).select("user_id", "hour", "v")


@query(f"""
WITH {_E}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY minute, event_id) - 1 AS rn FROM e)
SELECT user_id, event_id, rn // 5 AS sample FROM r WHERE rn % 5 = 0 AND rn < 150""")
def stride_sample(spark, d):
    return seq.stride_sample(_events(spark, d), ["user_id"], ["minute", "event_id"], 5, 30).select("user_id", "event_id", "sample")


@query(f"""
WITH {_E}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY minute, event_id) - 1 AS rn FROM e)
SELECT user_id, event_id FROM r WHERE rn = 0""")
def stride_sample_compat(spark, d):
    return seq.stride_sample(_events(spark, d), ["user_id"], ["minute", "event_id"], 5, 30, compat=True).select("user_id", "event_id")


@query(f"""
WITH RECURSIVE {_E}, s AS (SELECT DISTINCT user_id, minute FROM e WHERE value >= 120),
a(user_id, minute) AS (
  SELECT user_id, min(minute) FROM s GROUP BY user_id
  UNION ALL SELECT user_id, nxt FROM (SELECT a.user_id, (SELECT min(s.minute) FROM s WHERE s.user_id = a.user_id AND s.minute >= a.minute + 1440) AS nxt FROM a) WHERE nxt IS NOT NULL)
SELECT user_id, minute FROM a""")
def cut_cooldown(spark, d):
    return seq.accepted_cuts(_events(spark, d), ["user_id"], "minute", F.col("value") >= 120, 1440)


@query(f"WITH {_E} SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY minute, event_id) - 1)::BIGINT AS frame FROM e")
def frame_renumber(spark, d):
    return seq.renumbered(_events(spark, d), ["user_id"], ["minute", "event_id"]).select("user_id", "event_id", "frame")


@query("""
WITH b AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts) AS seg FROM b)
SELECT user_id, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM s GROUP BY user_id, seg""")
def session_segments(spark, d):
    found = temporal.sessions(table(spark, d, "events"), ["user_id"], "ts", "6 hours")
    return found.select("user_id", "n", times.epoch_micros("first_at").alias("first_us"), times.epoch_micros("last_at").alias("last_us"))


@query("""
WITH b AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts) AS seg FROM b),
g AS (SELECT user_id, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM s GROUP BY user_id, seg)
SELECT * FROM g WHERE last_us + 6::BIGINT * 3600 * 1000000 <= (SELECT epoch_us(max(ts)) FROM events)""")
def stream_segments(spark, d):
    """The same by a stream over files with an availableNow trigger: what the watermark has closed."""
    import uuid

    from reelforge.sources.tables import reliable
    from reelforge.streaming.segments import session_segments as over_stream

    reliable(spark.range(0))  # sets the shared folder where none is
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    events = table(spark, d, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{d.rstrip('/')}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    from reelforge.streaming.segments import run_available

    run_available(over_stream(stream, ["user_id"], "ts", "6 hours", "0 seconds"), f"{base}/out", f"{base}/state")
    out = spark.read.schema("user_id long, n long, first_at timestamp, last_at timestamp").parquet(f"{base}/out")
    return out.select("user_id", "n", times.epoch_micros("first_at").alias("first_us"), times.epoch_micros("last_at").alias("last_us"))
