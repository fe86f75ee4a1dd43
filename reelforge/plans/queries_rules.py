"""Queries of provenance, constraints, gates, summaries and rules of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelforge.functions import catalog_query, geometry, maps, scores, text
from reelforge.operators import aggregates as agg
from reelforge.operators import fair, runs, sequence
from reelforge.plans import scorers, stages
from reelforge.plans.registry import query
from reelforge.sources.tables import table

# --- provenance -------------------------------------------------------------------------------------


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'own' ELSE 'new' || c_custkey END AS uuid, '1.0' AS schema_version,
  CASE WHEN c_custkey % 4 <> 0 THEN 'p' || c_custkey END AS parent_uuid, CASE WHEN c_custkey % 5 = 0 THEN 'item' || c_custkey END AS org,
  CASE WHEN c_custkey % 5 = 0 THEN 'public-domain' WHEN c_custkey % 2 = 0 THEN 'cc' END AS license
FROM customer""")
def fair_injection(spark, d):
    """Identity, parent and source of sidecars, filled in where they are missing."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        k, F.when(k % 3 == 0, F.lit("own")).alias("uuid"), F.when((k % 5 != 0) & (k % 2 == 0), F.struct(F.lit(None).cast("string").alias("archive_org_id"), F.lit(None).cast("string").alias("archive_org_url"), F.lit("cc").alias("license"))).alias("source"),
    )
    out = fair.with_fair_fields(rows, "face_crop", F.concat(F.lit("new"), k), F.when(k % 4 != 0, F.concat(F.lit("p"), k)), F.lit(None).cast("string"), F.when(k % 5 == 0, F.concat(F.lit("item"), k)).otherwise(F.lit("")), F.lit(None).cast("string"))
    return out.select(k, "uuid", "schema_version", F.col("parent_clip.uuid").alias("parent_uuid"), F.col("source.archive_org_id").alias("org"), F.col("source.license").alias("license"))


@query("""SELECT n_nationkey::BIGINT AS id, '{"uuid":"u' || n_nationkey || '","schema_version":"1.0","source":"s","parent_clip":"p","name":"' || n_name || '","frames":3}' AS sidecar FROM nation""")
def fair_key_order(spark, d):
    """Sidecars with the keys of provenance first and all others in their order."""
    n = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.lit("p").alias("parent_clip"), F.lit("1.0").alias("schema_version"), F.lit(3).alias("frames"), F.lit("s").alias("source"), F.concat(F.lit("u"), "n_nationkey").alias("uuid"),
    )
    names = fair.fair_order([c for c in n.columns if c != "id"])
    return n.select("id", F.to_json(F.struct(*names)).alias("sidecar"))


# The constraints of text documents and of clips, as far as these queries use them.
_UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
DOCUMENT_SCHEMA = {
    "type": "object",
    "required": ["uuid", "schema_version", "source_file", "extraction_method", "word_count", "char_count", "text_file", "processed_at"],
    "properties": {
        "uuid": {"type": "string", "pattern": _UUID}, "schema_version": {"type": "string", "enum": ["1.0"]}, "source_file": {"type": "string"}, "extraction_method": {"type": "string", "enum": ["text_layer", "ocr_paddleocr", "native"]},
        "page_count": {"type": "integer", "minimum": 0}, "word_count": {"type": "integer", "minimum": 0}, "char_count": {"type": "integer", "minimum": 0}, "text_file": {"type": "string"}, "processed_at": {"type": "string"},
    },
    "additionalProperties": False,
}
DETECTION_SCHEMA = {
    "type": "object",
    "required": ["image_path", "detections"],
    "properties": {
        "image_path": {"type": "string"},
        "detections": {"type": "array", "items": {"type": "object", "required": ["bbox_tlbr"], "properties": {"bbox_tlbr": {"type": "array", "items": {"type": "number"}, "minItems": 4, "maxItems": 4}}}},
        "parent": {"type": ["array", "object"]},
    },
    "oneOf": [{"required": ["parent"]}, {"required": ["image_path"]}],
}


@query("""
SELECT doc_id, list_aggregate(list_sort(list_filter([
  CASE WHEN doc_id % 7 = 1 THEN '$:additionalProperties' END, CASE WHEN doc_id % 5 = 2 THEN '$:required text_file' END, CASE WHEN doc_id % 11 = 3 THEN 'extraction_method:enum' END,
  CASE WHEN doc_id % 13 = 4 THEN 'page_count:minimum' END, CASE WHEN doc_id % 17 = 5 THEN 'uuid:pattern' END, CASE WHEN doc_id % 19 = 6 THEN 'word_count:type' END
], lambda x: x IS NOT NULL)), 'string_agg', ',') AS broken FROM documents""")
def document_schema_check(spark, d):
    """Documents with planted faults against their whole schema."""
    k = F.col("doc_id")

    def when(m: int, r: int, value, other):
        return F.when(k % m == r, value).otherwise(other)

    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(k.cast("string"), 12, "0"))
    parts = [
        F.concat(F.lit('"uuid":"'), when(17, 5, F.lit("not-a-uuid"), uuid), F.lit('"')), F.lit('"schema_version":"1.0","source_file":"a.pdf","processed_at":"2020-01-01T00:00:00Z"'),
        F.concat(F.lit('"extraction_method":"'), when(11, 3, F.lit("guess"), F.lit("native")), F.lit('"')), F.concat(F.lit('"page_count":'), when(13, 4, F.lit("-1"), F.lit("2.0"))),
        F.concat(F.lit('"word_count":'), when(19, 6, F.lit('"many"'), F.lit("7"))), F.lit('"char_count":0'), F.when(k % 5 != 2, F.lit('"text_file":"a.txt"')), F.when(k % 7 == 1, F.lit('"extra":null')),
    ]
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("json"))
    return rows.select("doc_id", F.nullif(F.array_join(fair.schema_violations(F.col("json"), DOCUMENT_SCHEMA), ","), F.lit("")).alias("broken"))


@query("""
SELECT vec_id, CASE vec_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'detections:items' WHEN 2 THEN '$:oneOf' WHEN 3 THEN 'detections:type' WHEN 4 THEN 'json' ELSE '$:oneOf,$:required image_path' END AS broken FROM embeddings""")
def detection_schema_check(spark, d):
    """Nested arrays, alternatives and types of detections."""
    docs = [
        '{"image_path": "a", "detections": [{"bbox_tlbr": [1, 2, 3.5, 4]}]}', '{"image_path": "a", "detections": [{"bbox_tlbr": [1, 2, 3, 4]}, {"bbox_tlbr": [1, 2, 3]}]}', '{"image_path": "a", "detections": [], "parent": {}}',
        '{"image_path": "a", "detections": {}}', '{"image_path": "a", ', '{"detections": []}',
    ]
    doc = F.element_at(F.array(*map(F.lit, docs)), (F.col("vec_id") % 6 + 1).cast("int"))
    broken = F.array_join(fair.schema_violations(doc, DETECTION_SCHEMA), ",")
    return table(spark, d, "embeddings").select("vec_id", broken.alias("broken"))


@query("""SELECT o_orderkey, '{"a":{"uuid":"<volatile>","x":["p/q",{"timestamp":"<volatile>"}]},"b":' || o_custkey || ',"uuid":"<volatile>"}' AS masked FROM orders""")
def volatile_keys_masked(spark, d):
    """Documents of any shape with what changes from run to run masked, at every depth."""
    doc = F.concat(F.lit('{"uuid": "'), "o_orderkey", F.lit('", "b": '), "o_custkey", F.lit(', "a": {"x": ["p\\\\q", {"timestamp": 5}], "uuid": null}}'))
    return table(spark, d, "orders").select("o_orderkey", fair.masked_json(doc, ("uuid", "timestamp")).alias("masked"))


# --- labels and paths -------------------------------------------------------------------------------


@query("SELECT page_id, coalesce(nullif(trim(CASE WHEN page_id % 3 = 0 THEN ' ' WHEN page_id % 3 = 1 THEN 'eng ' END), ''), 'und') AS language, replace(replace(url, '/', chr(92)), chr(92), '/') AS path FROM pages")
def language_and_separators(spark, d):
    lang = F.when(F.col("page_id") % 3 == 0, F.lit(" ")).when(F.col("page_id") % 3 == 1, F.lit("eng "))
    back = F.replace("url", F.lit("/"), F.lit("\\"))
    return table(spark, d, "pages").select("page_id", text.language_or_unknown(lang).alias("language"), text.normal_separators(back).alias("path"))


@query("SELECT n_nationkey, 'DATA/clips/' || n_name || '/{unknown}' AS path FROM nation")
def template_paths(spark, d):
    """Paths with {key} filled in; values may name each other, unknown keys stay."""
    template = F.concat(F.lit("{clips}/"), "n_name", F.lit("/{unknown}"))
    return table(spark, d, "nation").select("n_nationkey", text.resolved(template, {"root": "DATA", "clips": "{root}/clips"}).alias("path"))


@query("SELECT p_partkey, CASE WHEN p_size * 2 <= 33 THEN 'low' WHEN p_size * 2 <= 66 THEN 'middle' ELSE 'high' END AS band FROM part")
def documented_bands(spark, d):
    return table(spark, d, "part").select("p_partkey", scores.documented_band(F.col("p_size") * 2).alias("band"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS stamp FROM events")
def iso_stamps(spark, d):
    return table(spark, d, "events").select("event_id", text.iso_stamp(F.col("ts").cast("timestamp")).alias("stamp"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem")
def quality_summary(spark, d):
    """All keys but those of provenance."""
    dropped = {"l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus", "l_tax", "l_extendedprice"}
    t = table(spark, d, "lineitem")
    return t.select(*text.without_columns(t.columns, dropped))


# --- gates ------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'N' AND l_discount >= 0.05")
def person_detections(spark, d):
    """Detections of one class with a score of the threshold or more."""
    return table(spark, d, "lineitem").where(geometry.is_class(F.col("l_returnflag"), "N", F.col("l_discount"), 0.05)).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, count(CASE WHEN l_quantity > 25 THEN 1 END) > 0 AS has_face FROM lineitem GROUP BY l_orderkey")
def frame_has_face(spark, d):
    """Frames with a detection that has any keypoint; detections without the field or with an empty list count as none."""
    points = F.when(F.col("l_quantity") > 25, F.array(F.array(F.col("l_quantity"), F.lit(1.0)))).when(F.col("l_quantity") > 12, F.expr("cast(array() as array<array<double>>)"))
    frames = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_discount").alias("score"), points.alias("keypoints"))).alias("detections"))
    return frames.select("l_orderkey", geometry.has_face(F.col("detections")).alias("has_face"))


@query("""
SELECT vec_id, len(list_filter(range(0, 8), lambda i: p[i * 2 + 1] * 100 > 2 AND p[i * 2 + 1] * 100 < 48 AND p[i * 2 + 2] * 100 > 2 AND p[i * 2 + 2] * 100 < 38 AND coalesce(s[i + 1], 1) >= 0.1)) AS drawn
FROM (SELECT vec_id, list_transform(embedding, lambda x: abs(x)::DOUBLE) AS p, list_transform(embedding[17:22], lambda x: abs(x)::DOUBLE) AS s FROM embeddings)""")
def drawn_keypoints(spark, d):
    """Keypoints that are drawn: inside the canvas by a margin, and seen; a missing score counts as seen."""
    e = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    points = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.array(F.element_at(e, (i * 2 + 1).cast("int")) * 100, F.element_at(e, (i * 2 + 2).cast("int")) * 100))
    drawn = geometry.drawable(points, F.slice(e, 17, 6), 50, 40, 0.1)
    return table(spark, d, "embeddings").select("vec_id", F.size(F.filter(drawn, lambda x: x)).cast("long").alias("drawn"))


_OVERLAPS = """
WITH RECURSIVE b AS (
  SELECT l_orderkey AS g, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber, l_partkey, l_suppkey) AS k, l_linenumber AS n, l_linenumber * 10 AS x1, l_quantity AS y1, l_linenumber * 10 + l_quantity AS x2, 3 * l_quantity AS y2
  FROM lineitem WHERE l_orderkey % 4 = 0
), r AS (
  SELECT g, 1 AS k, [n] AS kept, [{x1: x1, y1: y1, x2: x2, y2: y2}] AS boxes FROM b WHERE k = 1
  UNION ALL
  SELECT r.g, b.k, CASE WHEN hit THEN r.kept ELSE list_append(r.kept, b.n) END, CASE WHEN hit THEN r.boxes ELSE list_append(r.boxes, {x1: b.x1, y1: b.y1, x2: b.x2, y2: b.y2}) END
  FROM r JOIN b ON b.g = r.g AND b.k = r.k + 1, LATERAL (SELECT len(list_filter(r.boxes, lambda o:
      (greatest(0, least(o.x2, b.x2) - greatest(o.x1, b.x1)) * greatest(0, least(o.y2, b.y2) - greatest(o.y1, b.y1))) / ((o.x2 - o.x1) * (o.y2 - o.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
        - greatest(0, least(o.x2, b.x2) - greatest(o.x1, b.x1)) * greatest(0, least(o.y2, b.y2) - greatest(o.y1, b.y1)) + 1e-6) >= 0.5
      OR (greatest(0, least(o.x2, b.x2) - greatest(o.x1, b.x1)) * greatest(0, least(o.y2, b.y2) - greatest(o.y1, b.y1))) / (least((o.x2 - o.x1) * (o.y2 - o.y1), (b.x2 - b.x1) * (b.y2 - b.y1)) + 1e-6) >= 0.5)) > 0 AS hit)
)
SELECT g AS l_orderkey, string_agg(n::VARCHAR, ',' ORDER BY i) AS kept FROM (SELECT g, unnest(kept) AS n, generate_subscripts(kept, 1) AS i FROM (SELECT g, arg_max(kept, k) AS kept FROM r GROUP BY g)) GROUP BY g"""


@query(_OVERLAPS)
def suppress_overlapping(spark, d):
    """Of tracks that cover the same person (by union or by the smaller box) the better scored stays. Every fourth frame has tracks."""
    n, q = F.col("l_linenumber").cast("double"), F.col("l_quantity")
    box = F.struct((-F.col("l_discount")).alias("o"), F.col("l_linenumber").alias("n"), "l_partkey", "l_suppkey", (n * 10).alias("x1"), q.alias("y1"), (n * 10 + q).alias("x2"), (q * 3).alias("y2"))
    frames = table(spark, d, "lineitem").where("l_orderkey % 4 = 0").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(box)).alias("boxes"))
    kept = geometry.kept_apart(F.col("boxes"), 0.5, frames.schema["boxes"].dataType.elementType.simpleString())
    return frames.select("l_orderkey", F.array_join(F.transform(kept, lambda b: b["n"].cast("string")), ",").alias("kept"))


_FIT_POINTS = "SELECT l_orderkey AS g, l_linenumber * 3.0 AS x, l_quantity AS y, l_linenumber * 5.0 + l_discount AS u, l_quantity * 2.0 + l_tax AS v FROM lineitem"


@query(f"""
WITH p AS ({_FIT_POINTS}), m AS (SELECT g, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv FROM p GROUP BY g),
f AS (
  SELECT g, any_value(mx) AS mx, any_value(my) AS my, any_value(mu) AS mu, any_value(mv) AS mv,
    sum((x - mx) * (u - mu) + (y - my) * (v - mv)) / sum((x - mx) ** 2 + (y - my) ** 2) AS a, sum((x - mx) * (v - mv) - (y - my) * (u - mu)) / sum((x - mx) ** 2 + (y - my) ** 2) AS b
  FROM p JOIN m USING (g) GROUP BY g HAVING count(*) >= 2 AND sum((x - mx) ** 2 + (y - my) ** 2) > 0)
SELECT g AS l_orderkey, floor(a * 1e4 + 0.123)::BIGINT AS a, floor(b * 1e4 + 0.123)::BIGINT AS b, floor((mu - a * mx + b * my) * 1e3 + 0.123)::BIGINT AS tx, floor((mv - b * mx - a * my) * 1e3 + 0.123)::BIGINT AS ty,
  floor((a * (0 - (mu - a * mx + b * my)) + b * (0 - (mv - b * mx - a * my))) / (a * a + b * b) * 1e3 + 0.123)::BIGINT AS left_x,
  floor((a * (112 - (mv - b * mx - a * my)) - b * (112 - (mu - a * mx + b * my))) / (a * a + b * b) * 1e3 + 0.123)::BIGINT AS low_y
FROM f WHERE a * a + b * b > 1e-6""")
def similarity_fits(spark, d):
    """Least-squares similarity of each frame's points to their places in a crop, and two coordinates of the crop's corners in the frame."""
    t = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 3.0).alias("x"), F.col("l_quantity").alias("y"), (F.col("l_linenumber") * 5.0 + F.col("l_discount")).alias("u"), (F.col("l_quantity") * 2.0 + F.col("l_tax")).alias("v"))
    fits = geometry.similarity_by(t, ["l_orderkey"]).where("a * a + b * b > 1e-6")
    corners = geometry.crop_corners(F.col("a"), F.col("b"), F.col("tx"), F.col("ty"), 112)

    def thousandths(c, n=1e3):
        # Sums differ in their last bits by the order of rows. A value that lies at an edge belongs above it; of 8 million frames one did (to 2e-12), the next one lay 5e-9 off.
        return F.floor(c * n + 0.123 + 1e-9)

    return fits.select("l_orderkey", *[thousandths(F.col(c), 1e4).alias(c) for c in "ab"], *[thousandths(F.col(c)).alias(c) for c in ("tx", "ty")], thousandths(corners[0][0]).alias("left_x"), thousandths(corners[2][1]).alias("low_y"))


# --- catalogue --------------------------------------------------------------------------------------

_CATALOGUE = """lang:(en OR fr) AND n_chars:[500 TO 5000] AND source:*rc1* AND NOT source:(src10 OR "src11") AND (source:src1 OR NOT lang:en)"""


@query("""
SELECT doc_id, source, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents
WHERE coalesce(lang IN ('en', 'fr') AND n_chars BETWEEN 500 AND 5000 AND source LIKE '%rc1%' AND NOT source IN ('src10', 'src11') AND (source = 'src1' OR NOT lang = 'en'), false)
QUALIFY place <= 50""")
def catalog_query_string(spark, d):
    """A query string over the catalogue, the fifty longest hits in order (a top-k report)."""
    hits = table(spark, d, "documents").where(catalog_query.predicate(_CATALOGUE)).select("doc_id", "source", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(50)
    found = hits.agg(F.array_sort(F.collect_list(F.struct((-F.col("n_chars")).alias("o"), "doc_id", "source"))).alias("h"))  # at most fifty
    return found.select(F.posexplode("h").alias("p", "r")).select("r.doc_id", "r.source", (F.col("p") + 1).cast("long").alias("place"))


@query("SELECT event_id FROM events WHERE list_contains(['u' || user_id % 3, 't' || event_id % 2], 'u1') AND NOT list_contains(['u' || user_id % 3, 't' || event_id % 2], 't0')")
def catalog_query_lists(spark, d):
    """Fields that hold several values: a term holds where one of them meets it."""
    tags = F.array(F.concat(F.lit("u"), F.col("user_id") % 3), F.concat(F.lit("t"), F.col("event_id") % 2))
    return table(spark, d, "events").select("event_id", tags.alias("subject")).where(catalog_query.predicate("subject:u1 NOT subject:t0", frozenset({"subject"}))).select("event_id")


# --- summaries --------------------------------------------------------------------------------------


@query("SELECT lang AS language, count(*) AS n, sum(n_chars)::BIGINT AS n_words, sum(doc_id * 0.5) AS seconds FROM documents GROUP BY lang")
def transcription_totals(spark, d):
    """Transcriptions by language: how many, their words and their seconds."""
    rows = table(spark, d, "documents").select(F.col("lang").alias("language"), F.col("n_chars").alias("word_count"), (F.col("doc_id") * 0.5).alias("duration_seconds"))
    return agg.transcription_totals(rows)


@query("SELECT n, share FROM (SELECT count(*) AS n, coalesce(avg(toxic), 0.0) AS share FROM labels WHERE quality = 1) UNION ALL SELECT 0 AS n, 0.0 AS share")
def filtered_summary(spark, d):
    """Crops that passed: how many and their mean score, 0 without any."""
    rows = table(spark, d, "labels")
    return agg.count_and_mean(rows.where("quality = 1"), "toxic").unionAll(agg.count_and_mean(rows.where("quality = 9"), "toxic"))


@query("SELECT o_orderstatus, count(*) AS n, sum(o_custkey % 4)::BIGINT AS persons, round(avg(o_totalprice), 4) AS confidence FROM orders GROUP BY o_orderstatus")
def detection_summary(spark, d):
    """Images by state: how many, their persons and mean confidence."""
    rows = table(spark, d, "orders").withColumn("num_persons", F.col("o_custkey") % 4)
    return agg.detection_totals(rows, ["o_orderstatus"], "num_persons", "o_totalprice")


@query("""
WITH e AS (SELECT user_id, event_type, arg_max(value, event_id) AS last FROM events GROUP BY user_id, event_type)
SELECT user_id, string_agg(event_type || '=' || last, ';' ORDER BY event_type) AS merged FROM e GROUP BY user_id""")
def map_merge(spark, d):
    """Maps of a key's rows merged in order, the last value of a field staying, without a map of all rows being built."""
    merged = maps.merged_by(table(spark, d, "events"), ["user_id"], "event_type", "value", "event_id")
    return merged.select("user_id", F.array_join(F.transform(F.array_sort(F.map_entries("merged")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";").alias("merged"))


@query("""
SELECT c_custkey, '7=' || c_acctbal || ',9=' || CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS quality, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS nine, NULL::VARCHAR AS none FROM customer""")
def map_upsert(spark, d):
    """One field of a map set anew or put in, and fields looked up; an absent one is null."""
    k = F.col("c_custkey")
    m = F.create_map(F.lit("9"), F.lit("old"))
    up = maps.upserted(maps.upserted(m, F.lit("7"), F.col("c_acctbal").cast("string")), F.when(k % 2 == 0, F.lit("9")), F.lit("new"))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries(up)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return table(spark, d, "customer").select("c_custkey", shown.alias("quality"), F.try_element_at(up, F.lit("9")).alias("nine"), F.try_element_at(up, F.lit("0")).alias("none"))


@query("""
SELECT o_orderkey, s AS part_start, least(s + 99, e) AS part_end, greatest(1, floor(face * ((least(s + 99, e) - s + 1)::DOUBLE / (e - b + 1)))::BIGINT) AS face, floor(mouth * ((least(s + 99, e) - s + 1)::DOUBLE / (e - b + 1)))::BIGINT AS mouth
FROM (SELECT o_orderkey, o_orderkey % 50 AS b, o_orderkey % 50 + o_custkey % 700 AS e, o_custkey % 97 AS face, o_custkey % 31 AS mouth FROM orders), LATERAL (SELECT unnest(range(b, e + 1, 100)) AS s)""")
def split_prorated(spark, d):
    """Long segments cut, their counters shared out by length and rounded down; each part has one visible face frame at least."""
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 50).cast("long").alias("b"), (F.col("o_orderkey") % 50 + F.col("o_custkey") % 700).cast("long").alias("e"), (F.col("o_custkey") % 97).alias("face"), (F.col("o_custkey") % 31).alias("mouth"))
    parts = sequence.prorated(sequence.split_long(o, "b", "e", F.lit(100)), "b", "e", {"face": 1, "mouth": 0})
    return parts.select("o_orderkey", "part_start", "part_end", "face", "mouth")


@query("""
SELECT kind, name FROM (SELECT CASE WHEN s_nationkey % 2 = 0 THEN 'hard' ELSE 'drift' END AS kind, s_name AS name, row_number() OVER (PARTITION BY s_nationkey % 2 ORDER BY s_name, s_suppkey) AS k FROM supplier) WHERE k <= CASE WHEN kind = 'hard' THEN 50 ELSE 20 END""")
def report_lines(spark, d):
    """The first findings of each kind, as a report shows them (fifty hard ones, twenty that drift)."""
    rows = table(spark, d, "supplier").select(F.when(F.col("s_nationkey") % 2 == 0, "hard").otherwise("drift").alias("kind"), F.col("s_name").alias("name"), "s_suppkey")
    return runs.first_of_each(rows, "kind", {"hard": 50, "drift": 20}, "name", "s_suppkey").select("kind", "name")


# --- runs -------------------------------------------------------------------------------------------

_STAGE_ROWS = ", ".join(f"('{s}', {i})" for i, s in enumerate(stages.STAGES))
_EDGE_ROWS = ", ".join(f"('{s}', '{n}')" for s, (needs, _) in stages.STAGES.items() for n in needs)


@query(f"""
WITH s(stage, i) AS (VALUES {_STAGE_ROWS}), e(stage, needs) AS (VALUES {_EDGE_ROWS}),
t AS (SELECT n_nationkey AS run, stage, (n_nationkey * 7 + i * 5) % 23 AS last_end, (n_nationkey + i) % 4 <> 0 AS finished, (n_nationkey * i) % 41 = 40 AS failed FROM nation, s),
d AS (SELECT t.run, t.stage, bool_or(n.failed) AS any_failed, bool_and(n.finished) AS all_finished, max(n.last_end) AS newest FROM t JOIN e USING (stage) JOIN t n ON n.run = t.run AND n.stage = e.needs GROUP BY t.run, t.stage)
SELECT t.run, t.stage, CASE WHEN d.stage IS NULL THEN 'finished' WHEN any_failed THEN 'deps_failed' WHEN all_finished AND t.last_end >= newest THEN 'finished' WHEN newest > t.last_end THEN 'rerun' ELSE 'wait' END AS next,
  t.stage IN ('quality', 'filter', 'transcribe_video') AND NOT coalesce(all_finished, true) AS deferred
FROM t LEFT JOIN d ON d.run = t.run AND d.stage = t.stage""")
def progressive_rounds(spark, d):
    """What each stage of a run does next: done, again because something it needs has ended later, waiting, or stopped; stages that load models wait for an end."""
    names = spark.createDataFrame([(s, i) for i, s in enumerate(stages.STAGES)], "stage string, i int")
    n = F.col("n_nationkey")
    states = table(spark, d, "nation").crossJoin(F.broadcast(names)).select(  # thirteen stages
        n.alias("run"), "stage", ((n * 7 + F.col("i") * 5) % 23).alias("last_end"), ((n + F.col("i")) % 4 != 0).alias("finished"), ((n * F.col("i")) % 41 == 40).alias("failed")
    )
    return runs.next_steps(states, stages.edges(spark), stages.DEFERRED)


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'audio,video' WHEN 1 THEN 'text' ELSE 'video' END AS media, CASE WHEN p_partkey % 3 = 0 THEN 'other,zoom' ELSE '' END AS unknown FROM part""")
def requests(spark, d):
    """Media of a request that are known, video without any, and the stages in it that nobody knows."""
    k = F.col("p_partkey")
    asked = F.when(k % 4 == 0, F.array(F.lit("VIDEO"), F.lit(" Audio"), F.lit("bogus"))).when(k % 4 == 1, F.array(F.lit("text"))).when(k % 4 == 2, F.array(F.lit("bogus")))
    steps = F.when(k % 3 == 0, F.array(F.lit("zoom"), F.lit("clips"), F.lit("other"))).otherwise(F.array(F.lit("docs")))
    return table(spark, d, "part").select("p_partkey", F.array_join(stages.known_media(asked), ",").alias("media"), F.array_join(stages.strange_stages(steps), ",").alias("unknown"))


# --- scorers ----------------------------------------------------------------------------------------

_H = "('0x' || substr(sha256(text), 1, 8))::BIGINT"
_PAGES = "CAST(greatest(1, ceil(length(text) / 2000.0)) AS INT)"


def _scored(spark, d, make, schema):
    docs = table(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("media"))
    return scorers.score(docs, make, "media", schema, ["doc_id"])


@query(f"SELECT doc_id, ({_H} % 4)::INT AS n, CASE WHEN {_H} % 4 > 0 THEN ({_H} % 500)::DOUBLE END AS x1, CASE WHEN {_H} % 4 > 0 THEN ({_H} % 1000) / 1000.0 END AS score FROM documents")
def person_detector(spark, d):
    s = _scored(spark, d, scorers.StubPersonDetector, scorers.PERSON_DETECTOR)
    return s.select("doc_id", F.size("boxes").alias("n"), F.try_element_at("boxes", F.lit(1))[0].alias("x1"), F.try_element_at("scores", F.lit(1)).alias("score"))


@query(f"SELECT doc_id, 133 AS n, (({_H} + 37 * 132) % 1000)::DOUBLE AS last_x, (({_H} + 132) % 100) / 100.0 AS last_score FROM documents")
def pose_estimator(spark, d):
    s = _scored(spark, d, scorers.StubPoseEstimator, scorers.POSE_ESTIMATOR)
    return s.select("doc_id", F.size("keypoints").alias("n"), F.col("keypoints")[132][0].alias("last_x"), F.col("keypoint_scores")[132].alias("last_score"))


@query(f"SELECT doc_id, ({_H} % 10001) / 100.0 AS score FROM documents")
def face_scorer(spark, d):
    return _scored(spark, d, scorers.StubFaceScorer, scorers.FACE_SCORER).select("doc_id", "score")


@query("SELECT doc_id, " + ", ".join(f"(('0x' || substr(sha256('{m}' || text), 1, 8))::BIGINT % 101)::DOUBLE AS {m}" for m in scorers.OFIQ_MEASURES) + " FROM documents")
def face_quality_scorer(spark, d):
    return _scored(spark, d, scorers.StubFaceQuality, scorers.FACE_QUALITY).select("doc_id", *scorers.OFIQ_MEASURES)


@query("SELECT doc_id, CASE WHEN text = '' THEN '' ELSE 'und' END AS language, left(text, 40) AS said, length(text) / 16.0 AS seconds FROM documents")
def transcriber(spark, d):
    s = _scored(spark, d, scorers.StubTranscriber, scorers.TRANSCRIBER)
    return s.select("doc_id", "language", F.col("transcription").alias("said"), F.coalesce(F.try_element_at("segments", F.lit(1))["end"], F.lit(0.0)).alias("seconds"))


@query(f"SELECT doc_id, md5(text) AS text, 'native' AS method, {_PAGES} AS pages, length(text)::BIGINT AS chars FROM documents")
def document_extractor(spark, d):
    s = _scored(spark, d, scorers.StubDocumentExtractor, scorers.DOCUMENT_EXTRACTOR)
    return s.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text"), F.col("extraction_method").alias("method"), F.col("page_count").alias("pages"), F.col("char_count").alias("chars"))


@query("SELECT doc_id % 2 = 1 AS failed, count(*) AS n FROM documents GROUP BY 1")
def scorer_errors(spark, d):
    """Media that a scorer fails on are told with the reason, and the others of their batch are scored."""
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit("ok").cast("binary")).alias("media"))
    s = scorers.score(docs, scorers.StubFaceScorer, "media", scorers.FACE_SCORER, ["doc_id"])
    return s.groupBy((F.col("score").isNull() & F.col("error").isNotNull()).alias("failed")).agg(F.count("*").alias("n"))
