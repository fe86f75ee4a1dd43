"""Queries of sources and sinks: what is written is read back through them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.functions import text
from reelforge.operators import documents, gates
from reelforge.plans.registry import query
from reelforge.sources import frames as media
from reelforge.sources import tables as src
from reelforge.sources.tables import table

# --- listings -------------------------------------------------------------------------------------

# A small archive of files of one byte (empty ones are not listed): clips, crops, images, audio and documents with some of their sidecars.
_N = 40
_NAMES = (
    ("raw/v{0}.MP4", 2), ("raw/deep/w{0}.webm", 5), ("raw/still{0}.JPEG", 3), ("raw/scan{0}.png", 4), ("sound/a{0}.mp3", 2), ("sound/live/b{0}.FLAC", 3), ("papers/d{0}.pdf", 4), ("papers/n{0}.TXT", 7),
    ("clips/c{0}.mp4", 1), ("clips/c{0}.transcription.json", 3), ("clips/c{0}_face_0.mp4", 2), ("clips/c{0}_face_0.magface.json", 4), ("clips/c{0}_face_1.png", 5), ("clips/c{0}_face_1_mask.png", 5), ("clips/c{0}_progress.json", 6),
    ("texts/a{0}.txt", 4), ("texts/live/b{0}.txt", 6), ("clips/lost{0}.json", 8), ("clips/e{0}.quality.json", 9),
)
_ARCHIVE = "WITH archive(path) AS (" + " UNION ALL ".join(f"SELECT replace('{name}', '{{0}}', i::VARCHAR) FROM range({_N}) t(i) WHERE i % {k} = 0" for name, k in (*_NAMES, ("clips/c{0}.json", 1))) + ") "


def _archive(spark: SparkSession) -> tuple[DataFrame, str]:
    """(files of the archive by their path below it, its folder)."""
    app = spark.sparkContext.applicationId
    if app not in _MADE:
        _MADE[app] = _write_archive(spark)
    base = _MADE[app]
    return src.list_files(spark, base, ("mp4", "webm", "jpeg", "png", "mp3", "flac", "pdf", "txt", "json")).select(src.within(F.col("path"), base).alias("path")), base


#: The archive's folder by application, written once for each.
_MADE: dict[str, str] = {}


def _write_archive(spark: SparkSession) -> str:
    names = [(n.format(i), b"-") for n, k in _NAMES for i in range(0, _N, k)]
    names += [(f"clips/c{i}.json", f'{{"uuid": "u{i}", "source_video": "v{i}.MP4", "start_frame": {i * 10}, "end_frame": {i * 10 + 9}}}'.encode()) for i in range(_N)]
    return src.put_files(spark, src.scratch(spark, "archive"), names)


def _of_kind(kind: str):
    def run(spark, d):
        _, base = _archive(spark)
        return src.list_files(spark, base, kind).select(src.within(F.col("path"), base).alias("path"))

    return run


for _kind, _suffixes in (("video", "'mp4', 'webm'"), ("image", "'jpeg', 'png'"), ("audio", "'mp3', 'flac'"), ("text", "'pdf', 'txt'")):
    _run = _of_kind(_kind)
    _run.__name__ = f"list_{_kind}_files"
    query(_ARCHIVE + rf"SELECT path FROM archive WHERE lower(regexp_extract(path, '\.([^./]+)$', 1)) IN ({_suffixes})")(_run)


@query(_ARCHIVE + "SELECT path FROM archive WHERE path LIKE '%\\_face\\_%' ESCAPE '\\' AND (path LIKE '%.mp4' OR path LIKE '%.png') AND path NOT LIKE '%\\_mask.png' ESCAPE '\\'")
def list_crop_files(spark, d):
    return src.list_crops(_archive(spark)[0]).select("path")


@query(_ARCHIVE + r"""
SELECT path, replace(regexp_replace(path, '\.[^./]+$', '.txt'), 'sound/', 'texts/') AS output FROM archive
WHERE path LIKE 'sound/%' AND replace(regexp_replace(path, '\.[^./]+$', '.txt'), 'sound/', 'texts/') NOT IN (SELECT path FROM archive)""")
def pending_audio(spark, d):
    """Audio files whose text does not lie at the mirrored place yet."""
    files, _ = _archive(spark)
    below = [files.where(F.col("path").startswith(f)).select(F.substring("path", len(f) + 1, 1 << 30).alias("path")) for f in ("sound/", "texts/")]
    todo = src.pending(below[0], below[1], ".txt")
    return todo.select(F.concat(F.lit("sound/"), "path").alias("path"), F.concat(F.lit("texts/"), "output").alias("output"))


@query(f"SELECT 'c' || i AS clip, 'u' || i AS uuid, (i * 10)::BIGINT AS start_frame, 10::BIGINT AS n_frames FROM range({_N}) t(i) WHERE i % 3 <> 0")
def pending_clips(spark, d):
    """Clips without a transcription, with what their sidecars say."""
    files, base = _archive(spark)
    todo = src.pending_clips(files)
    sidecars = src.read_sidecars(spark, base, "uuid string, source_video string, start_frame long, end_frame long").withColumn("path", src.within(F.col("path"), base))
    return sidecars.join(todo, "path", "left_semi").select(text.stem(F.col("path")).alias("clip"), "uuid", "start_frame", (F.col("end_frame") - F.col("start_frame") + 1).alias("n_frames"))


@query(_ARCHIVE + r"""
SELECT path, NOT path LIKE '%.quality.json' AS in_images FROM archive WHERE path LIKE '%.json'
AND NOT regexp_matches(path, '(_progress|\.magface|\.ofiq_attr|\.transcription)\.json$')""")
def index_sidecars(spark, d):
    """Sidecars that an index shows; auxiliary ones are left out, in folders of images those of quality too."""
    files, _ = _archive(spark)
    shown = src.main_sidecars(files, image=True).withColumn("in_images", F.lit(True))
    return src.main_sidecars(files).join(shown, "path", "left").select("path", F.coalesce("in_images", F.lit(False)).alias("in_images"))


@query(_ARCHIVE + "SELECT path, row_number() OVER (ORDER BY encode(path)) AS place FROM archive")
def sorted_paths(spark, d):
    """Places of paths in the order of their bytes: listings are counted by ranges, so no task sorts them all."""
    from reelforge.operators.topk import running_total

    files, _ = _archive(spark)
    return running_total(files.withColumn("one", F.lit(1)), ["path"], "one", "place").select("path", "place")


@query("""SELECT n_nationkey::BIGINT AS id, n_name AS name, n_nationkey % 5 AS region FROM nation""")
def sidecar_round_trip(spark, d):
    """One JSON document a row, written and read with an explicit schema."""
    nations = table(spark, d, "nation")
    path = src.scratch(spark, "sidecars")
    nations.select(F.col("n_nationkey").cast("long").alias("id"), F.struct(F.col("n_name").alias("name"), (F.col("n_nationkey") % 5).alias("region")).alias("nation")).write.option("maxRecordsPerFile", 1).json(path)
    read = src.read_sidecars(spark, path, "id long, nation struct<name:string,region:int>")
    return read.select("id", "nation.name", "nation.region")


@query("SELECT n_nationkey::BIGINT AS n_nationkey, '{\"uuid\":\"u' || n_nationkey || '\",\"name\":\"' || n_name || '\"}' AS sidecar FROM nation")
def sidecar_json(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.concat(F.lit("u"), "n_nationkey").alias("uuid"), F.col("n_name").alias("name"))
    return src.sidecar(rows, "uuid", "name").select("n_nationkey", "sidecar")


# --- logs and tables --------------------------------------------------------------------------------


@query("""
SELECT o_orderkey::VARCHAR AS uuid, 'say "' || o_orderpriority || '",' || chr(10) || 'then' AS source_video, o_totalprice AS fps, (o_orderkey * 3)::BIGINT AS start_frame,
  CASE WHEN o_custkey % 5 <> 0 THEN o_orderstatus END AS output_path FROM orders""")
def log_round_trip(spark, d):
    """A CSV log with quotes, separators and line ends in its cells and empty cells for null, appended to twice and read by its schema."""
    path = src.scratch(spark, "log")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("uuid"), F.concat(F.lit('say "'), "o_orderpriority", F.lit('",\nthen')).alias("source_video"), F.col("o_totalprice").alias("fps"),
        (F.col("o_orderkey").cast("long") * 3).alias("start_frame"), F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderstatus")).alias("output_path"),
    )
    for part in (rows.where("fps < 150000"), rows.where("fps >= 150000")):
        src.write_log(part, path)
    return src.read_log(spark, path, "uuid string, source_video string, fps double, start_frame long, output_path string")


@query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type")
def append_in_parts(spark, d):
    """Appends to one table, each made visible as a whole by the committer; partitions are pruned on reading."""
    path, events = src.scratch(spark, "appended"), table(spark, d, "events").select("event_id", "event_type")
    for k in range(2):
        src.append(events.where(F.col("event_id") % 2 == k), path, ["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT doc_id, quality FROM labels WHERE quality = 1")
def passed_partition(spark, d):
    """Results laid out by whether they passed; those that did are read alone, and nothing is moved."""
    path = src.scratch(spark, "passed")
    src.write_passed(table(spark, d, "labels").select("doc_id", "quality"), path, F.col("quality") == 1)
    return spark.read.parquet(path).where("passed = 'true'").drop("passed")


@query("""
SELECT doc_id, 'd' || doc_id || '.txt' AS text_file, md5(text) AS text_md5, 'd' || doc_id || '.json' AS annotation_file,
  '{"source":' || doc_id || ',"char_count":' || length(text) || '}' AS annotation FROM documents""")
def text_annotation_pair(spark, d):
    pairs = src.text_pairs(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", F.concat(F.lit("d"), "doc_id"))
    return pairs.select("doc_id", "text_file", F.md5(F.col("text").cast("binary")).alias("text_md5"), "annotation_file", "annotation")


@query("SELECT conv_id, string_agg(turn || ':' || role, ',' ORDER BY turn) AS frames FROM conversations GROUP BY conv_id")
def frame_manifests(spark, d):
    made = src.frame_manifest(table(spark, d, "conversations"), "conv_id", "turn", "role")
    return made.select("conv_id", F.array_join(F.transform("frames", lambda f: F.concat_ws(":", f["turn"].cast("string"), f["role"])), ",").alias("frames"))


_GOLDEN = ("region", "nation", "supplier", "benchmark")


@query(
    " UNION ALL ".join(f"SELECT 'table' AS kind, '{t}.parquet' AS path, count(*) AS n_rows FROM {t}" for t in _GOLDEN)
    + " UNION ALL SELECT 'json' AS kind, 'nation/' || n_nationkey AS path, 1 AS n_rows FROM nation"
)
def golden_manifest(spark, d):
    """The manifest of a snapshot: one row an artifact with its kind, path, size and digest; paths are the same for another run."""
    out = None
    for name in _GOLDEN:
        t = table(spark, d, name)
        one = gates.table_digest(t, *t.columns).select(F.lit("table").alias("kind"), F.lit(f"{name}.parquet").alias("path"), F.col("n_rows"), "digest")
        out = one if out is None else out.unionAll(one)
    nations = table(spark, d, "nation")
    docs = nations.select(F.lit("json").alias("kind"), F.concat(F.lit("nation/"), "n_nationkey").alias("path"), F.lit(1).cast("long").alias("n_rows"), gates.row_digest(*nations.columns).alias("digest"))
    return out.unionAll(docs).where(F.length("digest") > 0).drop("digest")


# --- contents ---------------------------------------------------------------------------------------


@query("SELECT doc_id, md5(text) AS text FROM documents")
def text_charsets(spark, d):
    """Texts stored in UTF-8, with and without its mark, UTF-16 of both orders and Latin-1, told apart by their bytes."""
    t, c = F.col("text"), F.col("doc_id") % 5
    narrow = t.rlike(r"^[\x00-\xFF]*$") & t.rlike(r"[\xC0-\xFF][\x00-\x7F]") & ~t.rlike(r"[\xC2-\xF4][\x80-\xBF]")
    stored = (
        F.when(c == 1, F.concat(F.unhex(F.lit("EFBBBF")), t.cast("binary"))).when(c == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode(t, "UTF-16LE")))
        .when(c == 3, F.concat(F.unhex(F.lit("FEFF")), F.encode(t, "UTF-16BE"))).when((c == 4) & narrow, F.encode(t, "ISO-8859-1")).otherwise(t.cast("binary"))
    )
    return table(spark, d, "documents").select("doc_id", F.md5(documents.decoded(stored).cast("binary")).alias("text"))


@query("""
SELECT conv_id, md5(string_agg(shown, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE shown <> '')) AS text, count(*)::INT AS page_count FROM (
  SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN '' ELSE trim(regexp_replace(left(text, 60), '[^A-Za-z0-9 ().]', ' ', 'g'), ' ') END AS shown FROM conversations) GROUP BY conv_id""")
def pdf_text_layer(spark, d):
    """PDF files of one page a turn, some without text, read back; pages are joined by an empty line."""
    shown = F.when(F.col("turn") % 3 == 2, F.lit("")).otherwise(F.trim(F.regexp_replace(F.substring("text", 1, 60), r"[^A-Za-z0-9 ().]", " ")))
    per = table(spark, d, "conversations").select("conv_id", "turn", shown.alias("shown")).groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "shown"))), lambda s: s["shown"]).alias("pages"))
    escaped = F.transform("pages", lambda p: F.regexp_replace(p, r"([()\\])", r"\\\\$1"))
    bodies = F.transform(escaped, lambda p, i: F.concat(
        F.lit("\n"), (2 * i + 10).cast("string"), F.lit(" 0 obj << /Type /Page /Contents "), (2 * i + 11).cast("string"), F.lit(" 0 R >> endobj\n"),
        (2 * i + 11).cast("string"), F.lit(" 0 obj << /Length 0 >>\nstream\nBT /F1 12 Tf ("), p, F.lit(") Tj ET\nendstream\nendobj"),
    ))
    files = per.select("conv_id", F.concat(F.lit("%PDF-1.4"), F.array_join(bodies, ""), F.lit("\n%%EOF")).cast("binary").alias("content"))
    return documents.text_layer(files, "conv_id", "content").where("error is null").select(F.col("id").alias("conv_id"), F.md5(F.nullif(F.col("text"), F.lit("")).cast("binary")).alias("text"), "page_count")


@query("""
SELECT label::BIGINT AS id, frame, frame / 12.5 AS seconds, 8 AS width, 8 AS height, md5(pixels) AS pixels FROM (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, rpad(left(vec_id::VARCHAR, 64), 64, '.') AS pixels FROM embeddings) WHERE frame >= 2 AND (frame - 2) % 3 = 0""")
def video_frames(spark, d):
    """Frames of a video a label, from the third on every third one."""
    pixel = F.rpad(F.col("vec_id").cast("string"), 64, ".")
    frames = table(spark, d, "embeddings").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("vec_id", pixel.alias("p")))).alias("f"))
    video = F.concat(F.lit("YUV4MPEG2 W8 H8 F25:2 Cmono\n"), F.array_join(F.transform("f", lambda x: F.concat(F.lit("FRAME\n"), x["p"])), ""))
    read = media.read_frames(frames.select("label", video.cast("binary").alias("content")), "label", "content", start=2, stride=3)
    return read.select("id", "frame", "seconds", "width", "height", F.md5("pixels").alias("pixels"))


@query("SELECT item_id::BIGINT AS id, k::BIGINT AS frame, 4 AS width, 4 AS height, md5(rpad(item_id || '-' || k, 16, '.')) AS pixels FROM benchmark, range(3) t(k) WHERE item_id % 2 = 0 OR k = 0")
def crop_frames(spark, d):
    """Crops are videos with frames or images with one."""
    pixel = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.rpad(F.concat(F.col("item_id").cast("string"), F.lit("-"), k.cast("string")), 16, "."))
    image = F.concat(F.lit("P5 4 4 255\n"), pixel[0])
    video = F.concat(F.lit("YUV4MPEG2 W4 H4 F25:1 Cmono\n"), F.array_join(F.transform(pixel, lambda p: F.concat(F.lit("FRAME\n"), p)), ""))
    crops = table(spark, d, "benchmark").select("item_id", F.when(F.col("item_id") % 2 == 0, video).otherwise(image).cast("binary").alias("content"))
    return media.read_frames(crops, "item_id", "content").select("id", "frame", "width", "height", F.md5("pixels").alias("pixels"))
