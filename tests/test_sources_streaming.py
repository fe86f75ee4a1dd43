import json

import pandas as pd
from pyspark.sql import functions as F

from reelforge.operators import gates, kernels, lineage, topk
from reelforge.plans import scorers, stages
from reelforge.sources import tables as src
from reelforge.streaming import segments, tracks


def test_logs_and_sidecars(spark, tmp_path):
    (tmp_path / "log.csv").write_text('uuid,note,n\nu1,"two\nlines, ""quoted""",3\nu2,,\n')
    rows = src.read_log(spark, str(tmp_path / "log.csv"), "uuid string, note string, n int").collect()
    assert [tuple(r) for r in rows] == [("u1", 'two\nlines, "quoted"', 3), ("u2", None, None)]
    (tmp_path / "s").mkdir()
    for k in range(3):
        (tmp_path / "s" / f"c{k}.json").write_text(json.dumps({"uuid": f"u{k}", "frame_data": {"1": [{"score": 0.5}], "2": []}}, indent=1))
    side = src.read_sidecars(spark, str(tmp_path / "s"), "uuid string, frame_data map<string, array<struct<score: double>>>")
    tall = side.select("uuid", F.explode("frame_data").alias("frame", "found"))
    assert tall.count() == 6 and tall.where(F.size("found") > 0).count() == 3


def test_listings_and_registration(spark, tmp_path):
    for n in ("a.mp4", "sub/b.MKV", "c.txt", "x_face_1.jpg", "x_face_1_mask.png"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"0" * 200)
    videos = src.list_files(spark, str(tmp_path), "video")
    assert sorted(r["path"].rsplit("/", 1)[1] for r in videos.collect()) == ["a.mp4", "b.MKV"]
    assert src.list_crops(src.list_files(spark, str(tmp_path), "image")).count() == 1
    manifest = spark.createDataFrame([("a.mp4",)], "filename_downloaded string")
    new = src.register(videos, manifest, "video", {"license": "public"}).collect()
    assert [r["filename_downloaded"] for r in new] == ["b.MKV"] and new[0]["license"] == "public"
    assert src.read_texts(spark, str(tmp_path)).first()["text"] == "0" * 200


def test_widening_and_partitioned_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    src.append(spark.createDataFrame([(1, "a")], "id int, x string"), path)
    src.append_widening(spark.createDataFrame([(2, "b", 0.5)], "id int, x string, y double"), path)
    assert [tuple(r) for r in src.read_widened(spark, path).orderBy("id").collect()] == [(1, "a", None), (2, "b", 0.5)]
    src.write_passed(spark.range(10), str(tmp_path / "p"), F.col("id") >= 7)
    assert spark.read.parquet(str(tmp_path / "p")).where("passed = 'true'").count() == 3
    one = src.frame_manifest(spark.createDataFrame([("v", 2), ("v", 1)], "video string, frame int"), "video", "frame").first()
    assert [f["frame"] for f in one["frames"]] == [1, 2]
    assert json.loads(src.sidecar(spark.range(1), "id").first()["sidecar"]) == {"id": 0}


def test_source_selection(spark):
    rows = [("a.mp4", 500, False), ("a_thumb.mp4", 500, None), ("b.mp4", 50, None), ("c.mp4", 500, True), ("d__x.mp4", 500, None), ("e.gif", 500, None), ("f.MP4", 500, None)]
    df = spark.createDataFrame(rows, "name string, size long, private boolean")
    assert [r["name"] for r in src.original_files(df, ["mp4"]).collect()] == ["a.mp4", "f.MP4"]


def test_stage_plan():
    assert stages.plan(["text"]) == ["download", "docs"]
    assert stages.plan(["image"], skip=["quality"]) == ["download", "images", "face_crops_image"]
    assert stages.allowed_media(["Video ", "smell"]) == ["video"] and stages.allowed_media([]) == ["video"]
    assert stages.unknown_stages(["clips", "nothing"]) == ["nothing"]


def test_running_total_over_ranges(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v")).repartition(5)
    got = {r["id"]: r["running"] for r in topk.running_total(df, ["id"], "v").collect()}
    total = 0
    for i in range(1000):
        total += i % 7
        assert got[i] == total


def test_polymorphic_and_overwrite(spark):
    rows = spark.createDataFrame([(1, "clip", 5), (2, "file", 5), (3, "other", 6)], "id int, kind string, ref int")
    clips, files = spark.createDataFrame([(5,)], "c int"), spark.createDataFrame([(6,)], "f int")
    parents = {"clip": (clips, F.col("c"), F.col("ref")), "file": (files, F.col("f"), F.col("ref"))}
    got = lineage.polymorphic_parent(rows, F.col("kind"), parents, "file", "parent")
    assert {r["id"]: r["parent"] for r in got.collect()} == {1: 5, 2: None, 3: 6}
    assert lineage.resume(rows, rows, ["id"]).count() == 0 and lineage.resume(rows, rows, ["id"], overwrite=True).count() == 3


def test_violations(spark):
    df = spark.createDataFrame([("6f1c1c1e-3f3c-4b3a-8a53-2f0c5d6e7f80", [1.0] * 4, "a", None), ("x", [1.0], None, None)], "uuid string, box array<double>, parent_clip string, parent_crop string")
    rules = {"uuid": gates.matching("uuid", gates.UUID), "box": gates.items_between("box", 4, 4), "parent": gates.exactly_one("parent_clip", "parent_crop")}
    assert [r["violations"] for r in gates.violations(df, rules).collect()] == [[], ["uuid", "box", "parent"]]


def test_scorer_failures_become_nulls(spark):
    class Picky:
        def __call__(self, media):
            if any(m is None for m in media):
                raise ValueError
            return scorers.StubFaceScorer()(media)

    df = spark.createDataFrame([(1, bytearray(b"a")), (2, None), (3, bytearray(b"a"))], "id int, media binary").coalesce(1)
    got = {r["id"]: r["score"] for r in scorers.score(df, Picky, "media", "score double", ["id"]).collect()}
    assert got[2] is None and got[1] == got[3] and 0 <= got[1] <= 100


def test_scorers_get_media_in_bounded_batches(spark):
    """Few rows where media are small, few bytes where they are large: neither grows with the table."""
    from reelforge.plans import scorers

    class Told:
        def __call__(self, media):
            return pd.DataFrame({"n": [len(media)] * len(media), "size": [sum(map(len, media))] * len(media)})

    df = spark.range(0, 3000, 1, 1).selectExpr("id", "cast(repeat('x', case when id < 1000 then 40000 else 10 end) as binary) as media")
    got = scorers.score(df, Told, "media", "n long, size long", ["id"]).collect()
    assert sorted(r["id"] for r in got) == list(range(3000))
    assert max(r["n"] for r in got) <= 256 and max(r["size"] for r in got) < 3 << 20


def test_stateful_segments_resume(spark, tmp_path):
    def frames(name, rows):
        pd.DataFrame([(u, pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)) for u, s in rows], columns=["user", "ts"]).to_parquet(tmp_path / "in" / f"{name}.parquet", coerce_timestamps="us")

    (tmp_path / "in").mkdir()
    schema = "user long, ts timestamp"

    def run():
        stream = segments.read_frames(spark, str(tmp_path / "in"), schema)
        segments.run_available(segments.stateful_segments(stream, "user", "ts", 10, "0 seconds"), str(tmp_path / "out"), str(tmp_path / "state"))
        return sorted((r["user"], r["first_at"].second, r["n"]) for r in spark.read.schema("user long, first_at timestamp, last_at timestamp, n long").parquet(str(tmp_path / "out")).collect())

    frames("a", [(1, 0), (1, 5), (1, 30), (2, 1)])
    first = run()
    assert (1, 0, 2) in first
    frames("b", [(1, 35), (2, 59), (1, 59)])
    second = run()
    assert (1, 30, 2) in second and (2, 1, 1) in second and len([r for r in second if r == (1, 0, 2)]) == 1


def test_streamed_tracks_are_those_of_the_batch(spark, tmp_path):
    """Two runs over a stream, the second one going on from the state of the first, against all frames at once."""
    rows = [(scene, f, float(10 + 3 * f + 100 * k), 20.0, float(40 + 3 * f + 100 * k), 80.0) for scene in (1, 2) for f in range(20) for k in range(scene) if (f, k) not in ((7, 0), (12, 1))]
    schema = "scene long, frame long, x1 double, y1 double, x2 double, y2 double"
    box = ["x1", "y1", "x2", "y2"]

    def run():
        stream = segments.read_frames(spark, str(tmp_path / "in"), schema)
        segments.run_available(tracks.stream_tracks(stream, "scene", "frame", box), str(tmp_path / "out"), str(tmp_path / "state"))
        return spark.read.schema(f"{schema}, track_id long").parquet(str(tmp_path / "out"))

    for name, part in (("a", [r for r in rows if r[1] < 9]), ("b", [r for r in rows if r[1] >= 9])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = run()
    whole = kernels.track(spark.createDataFrame(rows, schema), ["scene"], "frame", box)
    key = lambda r: (r["scene"], r["frame"], r["x1"], r["track_id"] or 0)
    assert sorted(map(key, got.collect())) == sorted(map(key, whole.collect())) and any(r["track_id"] for r in got.collect())
