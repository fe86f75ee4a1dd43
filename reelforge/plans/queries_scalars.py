"""Queries of scalar derivations, filters and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelforge.functions import scores, text, times
from reelforge.operators import aggregates as agg
from reelforge.operators import gates
from reelforge.plans.registry import query
from reelforge.sources.tables import table

# DuckDB's RE2 has no flag for Unicode white space, so the class is spelled out.
_WS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
_STRIP = rf"regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g')"


@query(f"""
SELECT lang, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars,
  sum(len(list_filter(regexp_split_to_array(text, '{_WS}+'), lambda x: x <> '')))::BIGINT AS n_words
FROM documents WHERE length({_STRIP}) >= 50 GROUP BY lang""")
def doc_extract_summary(spark, d):
    docs = table(spark, d, "documents").where(text.keeps_document(F.col("text")))
    return docs.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum(F.length("text")).cast("long").alias("n_chars"), F.sum(text.word_count(F.col("text"))).alias("n_words"))


@query(f"SELECT doc_id, length({_STRIP})::BIGINT AS n_strip FROM documents WHERE length({_STRIP}) >= 50")
def doc_min_length_filter(spark, d):
    return table(spark, d, "documents").where(text.keeps_document(F.col("text"))).select("doc_id", text.strip_len(F.col("text")).cast("long").alias("n_strip"))


@query(f"SELECT CASE WHEN length({_STRIP}) >= 100 THEN 'text_layer' WHEN length({_STRIP}) >= 50 THEN 'ocr' ELSE 'dropped' END AS tier, count(*) AS n FROM documents GROUP BY 1")
def doc_extraction_tier(spark, d):
    return table(spark, d, "documents").groupBy(text.extraction_tier(F.col("text")).alias("tier")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, md5(CASE WHEN length(text) > 10000 THEN substr(text, 1, 10000) || ' [truncated]' ELSE text END) AS shown FROM documents")
def text_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.truncated(F.col("text"), 10_000, " [truncated]").cast("binary")).alias("shown"))


@query(r"SELECT page_id, regexp_extract(url, '[^/]*$') AS base, regexp_replace(regexp_extract(url, '[^/]*$'), '^(.+)\.[^.]+$', '\1') AS stem FROM pages")
def path_stem_basename(spark, d):
    return table(spark, d, "pages").select("page_id", text.basename(F.col("url")).alias("base"), text.stem(F.col("url")).alias("stem"))


@query(r"SELECT page_id, CASE WHEN regexp_extract(url, '^(.*)/[^/]*$', 1) = '' THEN '' ELSE replace(regexp_extract(url, '^(.*)/[^/]*$', 1), '/', '__') || '__' END AS prefix FROM pages")
def path_prefix(spark, d):
    return table(spark, d, "pages").select("page_id", text.parent_prefix(F.col("url")).alias("prefix"))


_CODES = "['bul', 'hrv', 'cze', 'dan', 'dut', 'eng', 'est', 'fin', 'fre', 'ger', 'gre', 'hun', 'gle', 'ita', 'lav', 'lit', 'mlt', 'pol', 'por', 'rum', 'slo', 'slv', 'spa', 'swe', 'rus', 'ukr', 'srp', 'mkd', 'bel', 'ell', 'xyz']"
_SHORT = "['bg', 'hr', 'cs', 'da', 'nl', 'en', 'et', 'fi', 'fr', 'de', 'el', 'hu', 'ga', 'it', 'lv', 'lt', 'mt', 'pl', 'pt', 'ro', 'sk', 'sl', 'es', 'sv']"


@query(f"""
WITH c AS (SELECT doc_id, lang, {_CODES}[doc_id % 31 + 1] AS one, {_CODES}[doc_id * 7 % 31 + 1] AS two FROM documents)
SELECT doc_id, CASE lang WHEN 'en' THEN 'eng' WHEN 'de' THEN 'ger' WHEN 'fr' THEN 'fre' WHEN 'es' THEN 'spa' END AS code, {_SHORT}[doc_id % 31 + 1] AS short,
  CASE WHEN one IN ('bul', 'rus', 'ukr', 'srp', 'mkd', 'bel') THEN 'cyrillic' WHEN one IN ('gre', 'ell') THEN 'greek'
    WHEN two IN ('bul', 'rus', 'ukr', 'srp', 'mkd', 'bel') THEN 'cyrillic' WHEN two IN ('gre', 'ell') THEN 'greek' ELSE 'latin' END AS script,
  coalesce(nullif(trim(lang), ''), 'und') AS folder
FROM c""")
def lang_to_script(spark, d):
    """Language codes both ways, and the script of lists of two languages, of which the first may be in capitals."""
    codes = F.array(*[F.lit(c) for c in (*text.TWO_LETTERS, "rus", "ukr", "srp", "mkd", "bel", "ell", "xyz")])
    one, two = (F.element_at(codes, (F.col("doc_id") * k % 31 + 1).cast("int")) for k in (1, 7))
    return table(spark, d, "documents").select(
        "doc_id", text.iso_639(F.col("lang")).alias("code"), text.two_letters(one).alias("short"), text.script_of(F.array(F.upper(one), two)).alias("script"), text.language_or_unknown(F.col("lang")).alias("folder")
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity::BIGINT || ',' || l_linenumber || ',' || (l_quantity::BIGINT * 2) || ',' || (l_linenumber * 3) AS packed, (l_quantity + l_linenumber * 4.0 + l_quantity)::DOUBLE AS corners
FROM lineitem""")
def packed_bbox_roundtrip(spark, d):
    x, y = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    from reelforge.functions.geometry import packed_box, unpacked_box

    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", packed_box(x, y, x * 2, y * 3).alias("packed"))
    c = unpacked_box(F.col("packed"))
    return rows.withColumn("corners", c[2] + c[1] + c[3])


@query("""
SELECT event_id,
  printf('%02dm%02ds', (event_id % 9000) // 60, (event_id % 9000) % 60) AS label,
  CASE WHEN event_id % 9000 >= 3600 THEN printf('%dh %dm %ds', (event_id % 9000) // 3600, (event_id % 9000) % 3600 // 60, event_id % 60)
       WHEN event_id % 9000 >= 60 THEN printf('%dm %ds', (event_id % 9000) // 60, event_id % 60) ELSE printf('%ds', event_id % 9000) END AS elapsed,
  printf('frame_%06d', event_id) AS file
FROM events""")
def timecode_label(spark, d):
    s = F.col("event_id") % 9000
    return table(spark, d, "events").select("event_id", times.minute_label(s).alias("label"), times.elapsed_label(s).alias("elapsed"), times.frame_file(F.col("event_id")).alias("file"))


@query("""
SELECT o_orderkey, o_orderkey / 25.0::DOUBLE AS start_s, (o_custkey + 1) / 25.0::DOUBLE AS duration_s, CASE WHEN o_custkey % 7 > 0 THEN o_orderkey / (o_custkey % 7)::DOUBLE END AS guarded_s
FROM orders""")
def frames_to_seconds(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, d, "orders").select("o_orderkey", times.frame_seconds(k, F.lit(25.0)).alias("start_s"), times.clip_duration(k, k + c, F.lit(25.0)).alias("duration_s"), times.frame_seconds(k, (c % 7).cast("double")).alias("guarded_s"))


@query("SELECT CASE WHEN value >= 70 THEN 'green' WHEN value >= 40 THEN 'amber' ELSE 'red' END AS band, user_id % 8 AS colour, count(*) AS n FROM events GROUP BY 1, 2")
def score_band(spark, d):
    return table(spark, d, "events").groupBy(scores.band(F.col("value")).alias("band"), scores.palette(F.col("user_id")).alias("colour")).agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, sha256('order|' || o_orderkey) AS artifact_id, '1.0' AS schema_version, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS parent_clip, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS parent_crop
FROM orders""")
def fair_source_struct(spark, d):
    crop = F.col("o_orderstatus") == "F"
    source = F.struct(F.when(~crop, F.col("o_custkey")).alias("parent_clip"), F.when(crop, F.col("o_custkey")).alias("parent_crop"))
    made = table(spark, d, "orders").select("o_orderkey", F.sha2(F.concat_ws("|", F.lit("order"), "o_orderkey"), 256).alias("artifact_id"), F.lit("1.0").alias("schema_version"), source.alias("source"))
    return made.select("o_orderkey", "artifact_id", "schema_version", "source.parent_clip", "source.parent_crop")


@query("SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k, array_to_string(list_filter([event_type, CASE WHEN user_id % 2 = 0 THEN 'even' END, ''], lambda x: x IS NOT NULL AND x <> ''), '; ') AS tags FROM events")
def metadata_flatten(spark, d):
    tags = text.joined_list(F.array("event_type", F.when(F.col("user_id") % 2 == 0, "even"), F.lit("")))
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), tags.alias("tags"))


_VALUE = "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_totalprice END"


@query(f"""
SELECT o_orderpriority AS source_video, count(*) AS n_clips, sum({_VALUE}::DECIMAL(28,4))::DOUBLE AS duration, coalesce(sum({_VALUE}::DECIMAL(28,4))::DOUBLE, 0) / count(*) AS mean_conf,
  sum(o_custkey % 4)::BIGINT AS persons
FROM orders GROUP BY 1""")
def clip_log_summary(spark, d):
    v = F.when(F.col("o_custkey") % 5 != 0, F.col("o_totalprice"))
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("source_video")).agg(F.count("*").alias("n_clips"), agg.exact_sum(v).alias("duration"), agg.mean_over_all_rows(v).alias("mean_conf"), F.sum(F.col("o_custkey") % 4).alias("persons"))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def by_language_counts(spark, d):
    return agg.counts_by(table(spark, d, "documents"), "lang")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def by_type_counts(spark, d):
    return agg.counts_by(table(spark, d, "events"), "event_type")


@query("SELECT count(*) AS n_frames, count(DISTINCT user_id) AS n_clips FROM events")
def distinct_clips(spark, d):
    return table(spark, d, "events").agg(F.count("*").alias("n_frames"), F.countDistinct("user_id").alias("n_clips"))


@query("SELECT sum(n_chars)::BIGINT AS chars, count(*) AS n_docs, count(*) FILTER (WHERE lang = 'en') AS n_en FROM documents")
def document_totals(spark, d):
    return table(spark, d, "documents").agg(F.sum("n_chars").alias("chars"), F.count("*").alias("n_docs"), F.count_if(F.col("lang") == "en").alias("n_en"))


@query("""
SELECT d.lang, count(*) AS n, count(*) FILTER (WHERE l.quality = 1) AS n_pass, 100.0::DOUBLE * count(*) FILTER (WHERE l.quality = 1) / count(*) AS pass_pct,
  sum(d.n_chars::DECIMAL(28,4))::DOUBLE / count(d.n_chars) AS mean_chars, sum(l.toxic::DECIMAL(28,4))::DOUBLE / count(l.toxic) AS mean_toxic
FROM documents d JOIN labels l USING (doc_id) GROUP BY d.lang""")
def quality_means_and_pass_rate(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id")
    passed = F.count_if(F.col("quality") == 1)
    return rows.groupBy("lang").agg(F.count("*").alias("n"), passed.alias("n_pass"), (F.lit(100.0) * passed / F.count("*")).alias("pass_pct"), agg.exact_mean(F.col("n_chars")).alias("mean_chars"), agg.exact_mean(F.col("toxic")).alias("mean_toxic"))


@query("""
SELECT user_id, max(value) AS s_max, sum(value::DECIMAL(28,4))::DOUBLE / count(value) AS s_mean, quantile_cont(value, 0.1) AS s_p10, quantile_cont(value, 0.5) AS s_p50, quantile_cont(value, 0.9) AS s_p90,
  count(*) AS frames_scored
FROM events GROUP BY user_id""")
def pct_stats_per_crop(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(*agg.pct_stats(F.col("value"), "s_"), F.count("*").alias("frames_scored"))


@query("""
SELECT event_type, min(value) AS lo, max(value) AS hi, sum(value::DECIMAL(28,4))::DOUBLE / count(value) AS mean, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90
FROM events GROUP BY 1""")
def score_distribution(spark, d):
    """Five event types hold all rows, so percentiles come from ranks over ranges."""
    v, events = F.col("value"), table(spark, d, "events")
    per = events.groupBy("event_type").agg(F.min(v).alias("lo"), F.max(v).alias("hi"), agg.exact_mean(v).alias("mean"))
    at = agg.ranged_percentiles(events, "event_type", "value", (0.1, 0.5, 0.9)).select("event_type", *[F.col("percentiles")[k].alias(n) for k, n in enumerate(("p10", "median", "p90"))])
    return per.join(at, "event_type").select("event_type", "lo", "hi", "mean", "median", "p10", "p90")


@query("SELECT user_id, max(value) AS best, count(*) AS n FROM events GROUP BY user_id HAVING max(value) >= 200")
def quality_threshold_max(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max("value").alias("best"), F.count("*").alias("n")).where("best >= 200")


@query("SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ROLLUP(source)")
def index_rollup(spark, d):
    return agg.with_total(table(spark, d, "documents"), "source", F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""
SELECT n_baseline, n_current, n_current::DOUBLE / n_baseline AS ratio, n_current::DOUBLE / n_baseline BETWEEN 0.25 AND 4 AS in_bounds
FROM (SELECT (SELECT count(*) FROM documents) AS n_baseline, (SELECT count(*) FROM labels) AS n_current)""")
def volume_check(spark, d):
    return agg.volume_check(table(spark, d, "documents"), table(spark, d, "labels"))


@query("""
SELECT event_id, round(100 / (1 + exp((23 - value) / 2.6)), 6) AS unified FROM events""")
def magface_calibration(spark, d):
    return table(spark, d, "events").select("event_id", F.round(scores.unified_face_score(F.col("value")), 6).alias("unified"))


@query("""
SELECT event_id,
  round(least(greatest(-14 + 115 / (1 + exp(-((value / 10 + 20) / 15))), 0), 100), 6) AS sharpness,
  round(least(greatest(-0.0278 + 103 / (1 + exp(-((value / 500 - 0.3308) / 0.092))), 0), 100), 6) AS compression,
  round(least(greatest(100 * (1 / (1 + exp(-((value * 20 + 5000) / 5000)))), 0), 100), 6) AS expression
FROM events""")
def ofiq_sigmoid(spark, d):
    v = F.col("value")
    at = {"sharpness": v / 10, "compression": v / 500, "expression": v * 20}
    return table(spark, d, "events").select("event_id", *[F.round(scores.measure_quality(x, m), 6).alias(m) for m, x in at.items()])


_STEP = "1 / (1 + exp(({} - 0.02) / 0.1))"


@query(f"""
SELECT event_id, CASE WHEN x <= 0 THEN 100.0 WHEN x >= 0.95 THEN 0.0 ELSE round(({_STEP.format('x')} - {_STEP.format('0.95::DOUBLE')}) / ({_STEP.format('0::DOUBLE')} - {_STEP.format('0.95::DOUBLE')}) * 100, 6) END AS covering
FROM (SELECT event_id, value / 100 - 0.01 AS x FROM events)""")
def head_covering_quality(spark, d):
    return table(spark, d, "events").select("event_id", F.round(scores.covering_quality(F.col("value") / 100 - 0.01), 6).alias("covering"))


@query("SELECT event_id, round_even(greatest(cos(radians(value)), 0) * greatest(cos(radians(value)), 0) * 100, 0)::BIGINT AS pose FROM events")
def pose_quality(spark, d):
    return table(spark, d, "events").select("event_id", scores.pose_quality(F.col("value")).alias("pose"))


@query("""
SELECT violation, count(*) AS n FROM (
  SELECT unnest(list_filter([
    CASE WHEN value IS NULL OR value < 1 THEN 'value_minimum' END, CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'type_enum' END,
    CASE WHEN NOT regexp_matches(props, '^\\{"k": [0-9]{2}\\}$') THEN 'props_pattern' END], lambda x: x IS NOT NULL)) AS violation FROM events)
GROUP BY violation""".replace("\\\\", "\\"))
def schema_violations(spark, d):
    rules = {
        "value_minimum": gates.required("value") & gates.at_least("value", 1),
        "type_enum": gates.one_of("event_type", "click", "view", "purchase", "signup"),
        "props_pattern": gates.matching("props", r'^\{"k": [0-9]{2}\}$'),
    }
    return gates.violations(table(spark, d, "events"), rules).select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, sha256(n_nationkey || '|' || n_name || '|' || n_regionkey) AS digest FROM nation")
def canonical_row_hash(spark, d):
    return table(spark, d, "nation").select("n_nationkey", gates.row_digest("n_nationkey", "n_name", "n_regionkey").alias("digest"))


@query("""
SELECT count(*) AS n_rows, sum(('0x' || substr(sha256(o_orderkey || '|' || o_custkey || '|' || o_orderstatus), 1, 15))::BIGINT::HUGEINT)::VARCHAR AS digest FROM orders""")
def canonical_table_hash(spark, d):
    return gates.table_digest(table(spark, d, "orders"), "o_orderkey", "o_custkey", "o_orderstatus")


@query("""
SELECT p_partkey, p_name, p_size, NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name FROM part
UNION ALL SELECT NULL, NULL, NULL, s_suppkey, s_name FROM supplier""")
def open_schema_union(spark, d):
    return gates.open_union(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), table(spark, d, "supplier").select("s_suppkey", "s_name"))


@query("""
SELECT p_partkey, p_name, p_size, p_retailprice FROM part
WHERE p_size > 10 AND NOT (p_name LIKE '%widget%' OR p_name LIKE '%ring%') AND regexp_extract(p_brand, '#([0-9]+)$', 1) IN ('1', '2', '3', '11', '12', '13')""")
def source_file_filter(spark, d):
    """Selection of source files: size, names of derived files, suffix."""
    name = F.col("p_name")
    suffix = F.regexp_extract("p_brand", r"#([0-9]+)$", 1)
    return table(spark, d, "part").where((F.col("p_size") > 10) & ~name.rlike("widget|ring") & suffix.isin("1", "2", "3", "11", "12", "13")).select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("SELECT event_id FROM events WHERE coalesce(try_cast(CASE WHEN user_id % 3 = 0 THEN 'unknown' ELSE value::VARCHAR END AS DOUBLE) >= 60, true)")
def min_duration_filter(spark, d):
    from reelforge.sources.tables import long_enough

    length = F.when(F.col("user_id") % 3 == 0, "unknown").otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").where(long_enough(length, 1)).select("event_id")


@query("""
SELECT doc_id, source FROM documents WHERE (lang = 'en' OR lang = 'fr') AND n_chars BETWEEN 500 AND 5000 AND source LIKE 'src1%' AND NOT source IN ('src10', 'src11')""")
def catalog_search(spark, d):
    """Catalogue predicates: and, or, not, ranges and wildcards, pushed to the scan."""
    s = F.col("source")
    return table(spark, d, "documents").where(F.col("lang").isin("en", "fr") & F.col("n_chars").between(500, 5000) & s.startswith("src1") & ~s.isin("src10", "src11")).select("doc_id", "source")
