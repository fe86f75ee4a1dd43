"""Queries of lineage joins, resumption, integrity and the stage graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelforge.functions import text, times
from reelforge.operators import lineage, temporal
from reelforge.operators import topk as top
from reelforge.plans import stages
from reelforge.plans.registry import query
from reelforge.sources.tables import table


@query("""
SELECT c_custkey, coalesce(last_event::VARCHAR, '') AS last_event FROM customer
LEFT JOIN (SELECT user_id, arg_max(event_id, event_id) AS last_event FROM events GROUP BY user_id) ON user_id = c_custkey""")
def lookup_last_wins(spark, d):
    events, customers = table(spark, d, "events"), table(spark, d, "customer").select("c_custkey")
    found = lineage.lookup_last_wins(customers, events.select("user_id", "event_id"), F.col("c_custkey"), F.col("user_id"), F.col("event_id").cast("string"), F.col("event_id"), "last_event", "")
    return found.select("c_custkey", "last_event")


@query("""
SELECT event_id, CASE WHEN event_type = 'purchase' THEN c_custkey ELSE s_suppkey END AS parent FROM events
LEFT JOIN customer ON c_custkey = user_id * 7 LEFT JOIN supplier ON s_suppkey = user_id""")
def polymorphic_parent(spark, d):
    parents = {
        "purchase": (table(spark, d, "customer"), F.col("c_custkey"), F.col("user_id") * 7),
        "other": (table(spark, d, "supplier"), F.col("s_suppkey"), F.col("user_id")),
    }
    kind = F.when(F.col("event_type") == "purchase", "purchase").otherwise("other")
    return lineage.polymorphic_parent(table(spark, d, "events").select("event_id", "user_id", "event_type"), kind, parents, "other", "parent").select("event_id", "parent")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(spark, d):
    return lineage.resume(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def pair_semijoin(spark, d):
    return lineage.with_sibling(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id, lang, quality, toxic, b.item_id IS NOT NULL AS benchmark FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = doc_id")
def sidecar_star_join(spark, d):
    flags = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit(True).alias("benchmark"))
    out = lineage.star(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], table(spark, d, "labels"), flags)
    return out.withColumn("benchmark", F.coalesce("benchmark", F.lit(False)))


@query("""
SELECT o_orderkey, coalesce(n, o_custkey) AS o_custkey, coalesce(n, o_custkey) IS DISTINCT FROM o_custkey AS changed
FROM orders LEFT JOIN (SELECT c_custkey, c_custkey + 1 AS n FROM customer WHERE c_custkey % 3 = 0) ON c_custkey = o_orderkey % 1000""")
def parent_refresh_update(spark, d):
    current = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("slot"), (F.col("c_custkey") + 1).alias("o_custkey"))
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 1000).alias("slot"))
    return lineage.refreshed(rows, current, ["slot"], "o_custkey").select("o_orderkey", "o_custkey", "changed")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def broken_provenance(spark, d):
    pool = table(spark, d, "customer").where("c_acctbal >= 0")
    return lineage.broken_provenance(table(spark, d, "orders").select("o_orderkey", "o_custkey"), pool, "o_custkey", "c_custkey").select("o_custkey", "o_orderkey")


@query("""
SELECT status, count(*) AS n FROM (
  SELECT CASE WHEN b.k IS NULL THEN 'removed' WHEN a.k IS NULL THEN 'added' WHEN a.v <> b.v THEN 'drift' ELSE 'match' END AS status
  FROM (SELECT p_partkey AS k, p_size AS v FROM part WHERE p_partkey % 11 <> 0) a
  FULL JOIN (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS v FROM part WHERE p_partkey % 13 <> 0) b ON a.k = b.k)
GROUP BY status""")
def golden_diff(spark, d):
    part = table(spark, d, "part")
    base = part.where("p_partkey % 11 <> 0").select("p_partkey", F.col("p_size").alias("v"))
    now = part.where("p_partkey % 13 <> 0").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("v"))
    return lineage.golden_diff(base, now, "p_partkey", "v").groupBy("status").agg(F.count("*").alias("n"))


@query("""
SELECT r_name, n_name, count(*) AS n_items, sum(l_extendedprice::DECIMAL(28,4))::DOUBLE AS revenue
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
GROUP BY r_name, n_name""")
def lineage_chain_up(spark, d):
    """Quality to crop to clip to download: four links upwards."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order"), "l_extendedprice")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("customer"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_nationkey").alias("nation"))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("nation"), "n_name", F.col("n_regionkey").alias("region"))
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("region"), "r_name")
    up = lineage.chain((items, ""), (orders, "order"), (customers, "customer"), (nations, "nation"), (regions, "region"))
    return up.groupBy("r_name", "n_name").agg(F.count("*").alias("n_items"), F.sum(F.col("l_extendedprice").cast("decimal(28,4)")).cast("double").alias("revenue"))


@query("""
SELECT c_custkey, coalesce(o.n, 0) AS n_orders, coalesce(i.n, 0) AS n_items FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) i ON i.o_custkey = c_custkey""")
def lineage_fanout_down(spark, d):
    """Counts of descendants; children are counted before they are joined upwards."""
    per_order = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("items"))
    per_customer = table(spark, d, "orders").join(per_order, "o_orderkey", "left").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.sum(F.coalesce("items", F.lit(0))).alias("n_items"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_orders", "n_items")}
    return table(spark, d, "customer").select("c_custkey").join(per_customer, "c_custkey", "left").withColumns(zero)


@query("""
WITH p AS (SELECT event_id, user_id, floor(epoch_us(ts) / 3600000000)::BIGINT AS f FROM events WHERE event_type = 'click'),
k AS (SELECT event_id AS frame, user_id, floor(epoch_us(ts) / 3600000000)::BIGINT AS f FROM events WHERE event_type = 'view')
SELECT user_id, event_id, frame, frame_at FROM (
  SELECT p.user_id, p.event_id, k.frame, k.f AS frame_at, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(k.f - p.f), k.f, k.frame) AS rn
  FROM p JOIN k ON p.user_id = k.user_id AND abs(k.f - p.f) <= 1) WHERE rn = 1""")
def nearest_frame(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.floor(times.epoch_micros("ts") / 3_600_000_000).alias("at"))
    probe = events.where("event_type = 'click'").drop("event_type")
    frames = events.where("event_type = 'view'").select("user_id", "at", F.col("event_id").alias("frame"))
    return temporal.nearest(probe, frames, ["user_id"], "at", 1, "event_id", "frame")


_TURNS = """
t AS (SELECT conv_id, turn, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a, length(text)::BIGINT AS n FROM conversations),
i AS (SELECT conv_id, turn, a, a + n AS b FROM t WHERE n > 0),
q AS (SELECT conv_id, turn AS probe, a + n // 2 AS "at" FROM t)
"""


def _captions(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("n")).withColumn("a", F.coalesce(F.sum("n").over(w), F.lit(0)))
    spans = turns.where("n > 0").select("conv_id", "turn", F.col("a").alias("start"), (F.col("a") + F.col("n")).alias("end"))
    return turns.select("conv_id", F.col("turn").alias("probe"), (F.col("a") + F.floor(F.col("n") / 2)).alias("at")), spans


@query(f"""WITH {_TURNS} SELECT q.conv_id, probe, "at", turn FROM q JOIN i ON q.conv_id = i.conv_id AND a <= "at" AND "at" < b""")
def subtitle_at_time(spark, d):
    points, spans = _captions(spark, d)
    return temporal.first_match(temporal.point_in_interval_bucketed(points, spans, ["conv_id"], "at", "start", "end", 2000), ["conv_id", "probe"], "start").select("conv_id", "probe", "at", "turn")


@query(f"""WITH {_TURNS} SELECT q.conv_id, probe, "at", turn FROM q JOIN i ON q.conv_id = i.conv_id AND a <= "at" AND "at" < b""")
def subtitle_at_time_bucketed(spark, d):
    points, spans = _captions(spark, d)
    return temporal.point_in_interval_bucketed(points, spans, ["conv_id"], "at", "start", "end", 500).select("conv_id", "probe", "at", "turn")


@query("SELECT doc_id, coalesce(l.quality, p.quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN labels p ON p.doc_id = d.doc_id - d.doc_id % 10")
def caption_fallback(spark, d):
    """A crop's own transcription, else its parent clip's."""
    labels = table(spark, d, "labels")
    own, parent = labels.select("doc_id", F.col("quality").alias("own")), labels.select(F.col("doc_id").alias("clip"), F.col("quality").alias("parent"))
    rows = table(spark, d, "documents").select("doc_id", (F.col("doc_id") - F.col("doc_id") % 10).alias("clip"))
    return rows.join(own, "doc_id", "left").join(parent, "clip", "left").select("doc_id", F.coalesce("own", "parent", F.lit(-1)).alias("quality"))


@query("SELECT s_suppkey, p_partkey FROM (SELECT s_suppkey, p_partkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY p_partkey) AS rn FROM supplier LEFT JOIN part ON p_size = s_suppkey % 60) WHERE rn = 1")
def first_source_hit(spark, d):
    """The first source of the name, or none."""
    first = table(spark, d, "part").groupBy(F.col("p_size").cast("long").alias("slot")).agg(F.min("p_partkey").alias("p_partkey"))
    return table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 60).alias("slot")).join(first, "slot", "left").select("s_suppkey", "p_partkey")


@query("SELECT l_orderkey, l_linenumber, c_name FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN customer ON c_custkey = l_partkey AND c_nationkey = s_nationkey")
def two_key_attach(spark, d):
    """Sibling by folder and file name: a join on two keys."""
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("l_partkey"), F.col("c_nationkey").alias("nation"), "c_name")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").join(suppliers, "l_suppkey", "left").join(customers, ["l_partkey", "nation"], "left").select("l_orderkey", "l_linenumber", "c_name")


@query("SELECT conv_id, string_agg(role || '=' || n, ',' ORDER BY role) AS summary FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2) GROUP BY conv_id")
def quality_map_backprop(spark, d):
    """Summaries per track as a map on the parent, here written out."""
    per = table(spark, d, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    maps = per.groupBy("conv_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "n")))).alias("m"))
    return maps.select("conv_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("summary"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem WHERE l_quantity > 5) WHERE rn = 1")
def largest_original(spark, d):
    rows = table(spark, d, "lineitem").where("l_quantity > 5").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
    return top.top_one(rows, ["l_orderkey"], -F.col("l_extendedprice"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("""
SELECT p_partkey, running FROM (SELECT p_partkey, (sum(round(p_retailprice * 100)::BIGINT) OVER (ORDER BY p_size, p_partkey))::BIGINT AS running FROM part) WHERE running <= 50000000""")
def size_budget_prefix(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_size", F.round(F.col("p_retailprice") * 100).cast("long").alias("bytes"))
    return top.budget_prefix(parts, ["p_size", "p_partkey"], "bytes", 50_000_000).select("p_partkey", "running")


@query("SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS turn FROM events")
def round_robin_interleave(spark, d):
    return top.round_robin(table(spark, d, "events").select("event_id", "event_type", "ts"), "event_type", ["ts", "event_id"]).select("event_id", "event_type", "turn")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100")
def smallest_samples(spark, d):
    """The n smallest sources (a top-k report)."""
    return top.smallest(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 100, F.col("o_totalprice"), F.col("o_orderkey"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000")
def newest_results(spark, d):
    """Catalogue results by date, newest first, up to the configured number (a top-k report)."""
    return table(spark, d, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1000)


@query("SELECT DISTINCT source || '/' || lang AS folder FROM documents")
def union_of_listings(spark, d):
    """Listings of several folders as one, each path once."""
    docs = table(spark, d, "documents").select(F.concat("source", F.lit("/"), "lang").alias("folder"))
    return docs.union(docs.where(F.col("folder").endswith("/en"))).distinct()


_EDGES = ", ".join(f"('{s}', '{n}')" for s, (needs, _) in stages.STAGES.items() for n in needs)
_MEDIA = ", ".join(f"('{s}', '{m}')" for s, (_, media) in stages.STAGES.items() for m in media or stages.MEDIA)
_NAMES = ", ".join(f"('{s}')" for s in stages.STAGES)


@query(f"""
WITH RECURSIVE e(stage, needs) AS (VALUES {_EDGES}), gone(skipped, stage) AS (
  SELECT 'clips', 'clips' UNION SELECT g.skipped, e.stage FROM gone g JOIN e ON e.needs = g.stage)
SELECT stage FROM gone""")
def stage_closure(spark, d):
    return stages.closure(spark, spark.createDataFrame([("clips",)], "stage string"))


@query(f"""
WITH m(stage, media) AS (VALUES {_MEDIA}), s(stage) AS (VALUES {_NAMES}), a(name, media) AS (VALUES ('v', 'video'), ('i', 'image'), ('a', 'audio'), ('t', 'text'), ('vt', 'video'), ('vt', 'text'))
SELECT n.name, s.stage, EXISTS (SELECT 1 FROM m JOIN a ON a.media = m.media WHERE a.name = n.name AND m.stage = s.stage) AS runs
FROM (SELECT DISTINCT name FROM a) n, s""")
def stage_media_matrix(spark, d):
    sets = [("v", "video"), ("i", "image"), ("a", "audio"), ("t", "text"), ("vt", "video"), ("vt", "text")]
    return stages.enabled(spark, spark.createDataFrame(sets, "name string, media string"))


@query("""
SELECT sha256('video|' || url) AS artifact_id, regexp_extract(url, '[^/]*$') AS filename_downloaded, 'video' AS media_type, url AS source_path, 'public' AS license
FROM pages WHERE regexp_extract(url, '[^/]*$') NOT IN (SELECT regexp_extract(url, '[^/]*$') FROM pages WHERE page_id % 2 = 0)""")
def register_sources(spark, d):
    from reelforge.sources.tables import register

    pages = table(spark, d, "pages")
    manifest = pages.where("page_id % 2 = 0").select(text.basename(F.col("url")).alias("filename_downloaded"))
    return register(pages.select(F.col("url").alias("path")), manifest, "video", {"license": "public"})
