"""Tables: Parquet, logs in CSV, sidecars in JSON, listings of files, and sinks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File suffixes by kind of media.
SUFFIXES = {
    "video": ("mp4", "avi", "mkv", "mov", "webm", "m4v"),
    "image": ("jpg", "jpeg", "png", "bmp", "webp", "tif", "tiff"),
    "audio": ("mp3", "wav", "aac", "flac", "ogg", "m4a", "wma"),
    "text": ("pdf", "txt"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; where it is unset a session in one process gets a folder of its own.

    On a cluster without it no job starts, as each machine would write to its own disk.
    """
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and re.fullmatch(r"local(\[.*\])?", sc.master):
        path = tempfile.mkdtemp(prefix="reelforge-")
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def reliable(df: DataFrame) -> DataFrame:
    """Cuts lineage in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Bytes of one Arrow batch on its way to Python, and the row that passes them.
BATCH_BYTES = 2 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Lets queries of this session end an Arrow batch for Python with the row that passes `most` bytes; a lower setting stays."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if not 0 < now <= most:
        spark.conf.set(BATCH_SETTING, str(most))


def put_files(spark: SparkSession, base: str, files: Iterable[tuple[str, bytes]]) -> str:
    """Writes a few small files (relative path, bytes) through Hadoop's file systems, as fixtures and markers need; returns base."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, data in files:
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{base}/{name}"), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    return base


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV log: quoted cells may span lines, empty cells are null, rows that do not parse are kept in _corrupt_record."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("nullValue", "").option("mode", "PERMISSIVE")
    return reader.schema(schema).csv(path)


def read_sidecars(spark: SparkSession, path: str, schema: str, recursive: bool = True) -> DataFrame:
    """JSON documents, one a file, with an explicit schema (open maps stay MAP columns) and the path."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json")
    return reader.schema(schema).json(path).withColumn("path", F.col("_metadata.file_path"))


def list_files(spark: SparkSession, path: str, kind: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """path, length and modified of files of a kind; contents are never read, repeated paths count once."""
    suffixes = SUFFIXES[kind] if isinstance(kind, str) else tuple(kind)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    return files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes)).dropDuplicates(["path"])


def list_crops(files: DataFrame) -> DataFrame:
    """Face crops among listed files, without masks."""
    return files.where(F.col("path").rlike(r"_face_[^/]*\.(mp4|jpg|png)$") & ~F.col("path").rlike(r"_mask\.png$"))


def within(path: Column, base: str) -> Column:
    """The part of a path below a folder, whatever store or scheme stands before it."""
    return F.element_at(F.split(path, F.lit(re.escape(base.rstrip("/").rsplit("/", 1)[-1]) + "/"), 2), -1)


# Sidecars that hold results of later stages or progress, by the end of their names.
AUXILIARY = ("_progress.json", ".done", ".magface.json", ".ofiq_attr.json", ".transcription.json")
QUALITY_SIDECAR = ".quality.json"


def main_sidecars(files: DataFrame, name: str = "path", image: bool = False) -> DataFrame:
    """JSON sidecars that describe an artifact themselves; in folders of images quality sidecars are auxiliary too."""
    c = F.col(name)
    ends = F.lit(False)
    for end in (*AUXILIARY, *((QUALITY_SIDECAR,) if image else ())):
        ends = ends | c.endswith(end)
    return files.where(c.endswith(".json") & ~ends)


def mirrored(path: Column, suffix: str) -> Column:
    """Where the result of a file lies: the same folders and stem, another suffix."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", ""), F.lit(suffix))


def pending(files: DataFrame, done: DataFrame, suffix: str, overwrite: bool = False) -> DataFrame:
    """Files (path relative to their folder) with output, the mirrored path; those whose output is in done(path) go, unless it is to be overwritten."""
    out = files.withColumn("output", mirrored(F.col("path"), suffix))
    return out if overwrite else out.join(done.select(F.col("path").alias("output")).distinct(), "output", "left_anti")


def pending_clips(files: DataFrame, overwrite: bool = False) -> DataFrame:
    """Sidecars among listed files (path) whose clip lies beside them and that have no transcription yet."""
    sidecars = main_sidecars(files).withColumn("_stem", F.regexp_replace("path", r"\.json$", ""))

    def beside(suffix: str) -> DataFrame:
        return files.where(F.col("path").endswith(suffix)).select(F.expr(f"substring(path, 1, length(path) - {len(suffix)})").alias("_stem")).distinct()

    out = sidecars.join(beside(".mp4"), "_stem", "left_semi")
    return (out if overwrite else out.join(beside(".transcription.json"), "_stem", "left_anti")).drop("_stem")


def original_files(files: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """Source files of a catalogue(name, size, private): neither tiny, private nor derived, with a wanted suffix."""
    name = F.lower("name")
    derived = name.contains("__") | name.rlike("thumb|preview|derivative")
    return files.where((F.col("size") > 100) & ~F.coalesce(F.col("private"), F.lit(False)) & ~derived & F.regexp_extract(name, r"\.([^./]+)$", 1).isin(*suffixes))


def long_enough(seconds: Column, minutes: float) -> Column:
    """A length that does not parse keeps its file."""
    return F.coalesce(seconds.try_cast("double") >= minutes * 60, F.lit(True))


def register(files: DataFrame, manifest: DataFrame, media_type: str, extras: dict[str, str] | None = None) -> DataFrame:
    """Manifest rows for files that it does not name yet; ids are hashes of kind and path, so reruns agree."""
    name = F.element_at(F.split("path", "/"), -1)
    new = files.select(F.sha2(F.concat_ws("|", F.lit(media_type), "path"), 256).alias("artifact_id"), name.alias("filename_downloaded"), F.lit(media_type).alias("media_type"), F.col("path").alias("source_path"))
    new = new.join(manifest.select("filename_downloaded").distinct(), "filename_downloaded", "left_anti")
    return new.withColumns({k: F.lit(v) for k, v in (extras or {}).items()}) if extras else new


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files in any of the usual charsets: path and text."""
    from reelforge.operators.documents import decoded

    return read_bytes(spark, path, "*.txt").select("path", decoded(F.col("content")).alias("text"))


def write_log(df: DataFrame, path: str) -> None:
    """Appends to a CSV log: a header in every file, quotes doubled, null as an empty cell, files made visible by the committer at once."""
    df.write.mode("append").option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "").csv(path)


def read_bytes(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """path and content of whole files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Appends to a table; the committer makes it atomic."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_widening(df: DataFrame, path: str) -> None:
    """Appends rows with new columns; read the table with read_widened."""
    df.write.mode("append").parquet(path)


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def write_passed(df: DataFrame, path: str, passed: Column) -> None:
    """Results partitioned by whether they passed; nothing is ever moved."""
    df.withColumn("passed", passed).write.mode("overwrite").partitionBy("passed").parquet(path)


def sidecar(df: DataFrame, *cols: str, out: str = "sidecar") -> DataFrame:
    """Adds the row's JSON document."""
    return df.withColumn(out, F.to_json(F.struct(*cols)))


def text_pairs(extracted: DataFrame, key: str, text: str, stem: Column) -> DataFrame:
    """Text and annotation of a document as two columns of one table, under the names that their files would have."""
    note = F.to_json(F.struct(F.col(key).alias("source"), F.length(text).alias("char_count")))
    return extracted.select(key, F.concat(stem, F.lit(".txt")).alias("text_file"), F.col(text).alias("text"), F.concat(stem, F.lit(".json")).alias("annotation_file"), note.alias("annotation"))


def frame_manifest(frames: DataFrame, video: str, frame: str, *cols: str) -> DataFrame:
    """One row a video with its frames in order; videos are bounded, tables of videos are not."""
    return frames.groupBy(video).agg(F.array_sort(F.collect_list(F.struct(frame, *cols))).alias("frames"))
