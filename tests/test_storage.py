"""Sources, sinks, catalog and streams."""

import datetime as dt
import json
import os
import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from camlytics import fixtures, schemas
from camlytics.operators import catalog, detect, stats, track
from camlytics.plans import parsing, streams, views
from camlytics.session import scratch_path, shared_folder
from camlytics.sinks import tables
from camlytics.sources import files, topics
from camlytics.streaming import app, sinks, state

ONCE = {"availableNow": True}
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_topic_options():
    options = topics.frame_options("h:1", max_per_trigger=10)
    assert options["subscribe"].split(",")[6] == "camera-7-frames" and options["failOnDataLoss"] == "false"
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "10"
    assert topics.camera_options("h:1", 3)["subscribe"] == "camera-3-frames"
    assert topics.frame_options("h:1", start="earliest")["startingOffsets"] == "earliest"
    assert topics.detection_options("h:1")["subscribePattern"] == "camera-.*-detections"
    assert "subscribe" not in topics.detection_options("h:1")
    for camera in (0, 8):
        with pytest.raises(ValueError):
            topics.camera_options("h:1", camera)


def test_config_from_environment():
    config = app.Config.from_env({"KAFKA_SERVERS": "h:1", "CONFIDENCE_THRESHOLD": "0.7", "HDFS_PATH": "p"})
    assert (config.servers, config.threshold, config.path) == ("h:1", 0.7, "p")
    assert config.topics == topics.FRAME_TOPICS


def session_with(named, current, master):
    """As much of a session as the folder rule looks at."""
    chosen = [current]
    context = SimpleNamespace(
        master=master, getConf=lambda: {}, getCheckpointDir=lambda: chosen[0],
        setCheckpointDir=lambda path: chosen.__setitem__(0, path),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named)), chosen


def test_shared_folder_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    session, chosen = session_with("hdfs://shared/folder", None, "yarn")
    assert shared_folder(session) == "hdfs://shared/folder" == chosen[0]
    assert shared_folder(session_with(None, "hdfs://set/before", "yarn")[0]) == "hdfs://set/before"
    with pytest.raises(RuntimeError):
        shared_folder(session_with(None, None, "yarn")[0])


def test_schemas_parse():
    for ddl in (schemas.FRAME_ENVELOPE, schemas.DETECTION_ANSWER, schemas.TRACKS,
                schemas.SCORING_RESULT):
        assert schemas.struct_of(ddl).fields


# Files ---------------------------------------------------------------------

def decoder(path):
    for n in range(5):
        yield (None if n == 1 else f"{os.path.basename(path)}-{n}".encode()), 4, 6, 3


def test_videos(spark, tmp_path, rows):
    for name in ("cam1.mp4", "cam7.mp4", "notes.txt"):
        (tmp_path / name).write_bytes(b"12345")
    videos = files.camera_videos(spark, str(tmp_path))
    assert rows(videos, "camera_id", "length") == [(1, 5), (7, 5)]
    assert rows(files.missing_videos(spark, str(tmp_path), (1, 2, 7))) == [(2,)]
    frames = files.frames_from_videos(videos, decoder, max_frames=3, batch_rows=2)
    one = [r for r in frames.orderBy("frame_id").collect() if r.camera_id == 1]
    assert [(r.frame_id, r.image) for r in one] == [
        (0, b"cam1.mp4-0"), (1, None), (2, b"cam1.mp4-2"), (3, b"cam1.mp4-3")
    ]
    assert one[0].frame_shape == [4, 6, 3]


SAMPLE = {
    "camera_id": 1, "frame_id": 2, "class_counts": "{\"person\": 1, \"car\": 1}", "error": None,
    "detections": [{"class_id": 0, "class_name": "person", "bbox_x": 100, "bbox_width": 80}],
    "nested": {"a": 1, "b": {"c": "x"}},
}
SAMPLE_DDL = (
    "camera_id int, frame_id int, class_counts string, error string, "
    "detections array<struct<class_id int, class_name string, bbox_x int, bbox_width int>>, "
    "nested struct<a int, b struct<c string>>"
)


def test_json_to_parquet(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"camera_{n}_frame.json").write_text(json.dumps(SAMPLE | {"camera_id": n}, indent=2))
    out = str(tmp_path / "out")
    tables.json_to_parquet(spark, str(tmp_path), out, SAMPLE_DDL)
    back = spark.read.parquet(out)
    assert back.columns == ["camera_id", "frame_id", "class_counts", "error", "detections", "nested.a", "nested.b.c"]
    assert sorted(r.camera_id for r in back.collect()) == [0, 1, 2]
    assert back.first()["nested.b.c"] == "x" and back.first().detections[0].bbox_x == 100


def test_month_with_and_without_zero(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "frame_id int")
    tables.append_to_day(df, str(tmp_path / "t"), 3, "2025-09-07")
    df.write.parquet(str(tmp_path / "t/year=2025/month=09/day=08/camera_id=4"))
    got = spark.read.parquet(str(tmp_path / "t"))
    assert {tuple(r) for r in got.collect()} == {(1, 2025, 9, 7, 3), (1, 2025, 9, 8, 4)}
    assert os.path.isdir(tmp_path / "t/year=2025/month=9/day=7")


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.createDataFrame(
        [(f"2025-01-{d:02d}T10:00:00", c, d) for d in range(1, 11) for c in (1, 2)] + [(None, 1, 99)],
        "detection_timestamp string, camera_id int, frame_id int",
    )
    from camlytics.functions.text import with_date_parts

    tables.write_partitioned(with_date_parts(df, "detection_timestamp"), path)
    # Keeps the plan text from being cut short.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    got = files.scan_detections(spark, path, start=dt.date(2025, 1, 3), end=dt.date(2025, 1, 4), cameras=[2])
    assert sorted(r.frame_id for r in got.collect()) == [3, 4]
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "make_date" in filters and "camera_id" in filters
    assert len(got.inputFiles()) <= 21 and got.select(F.input_file_name()).distinct().count() == 2
    undated = spark.read.parquet(path).where("year is null")
    assert [r.frame_id for r in undated.collect()] == [99]
    assert any("__HIVE_DEFAULT_PARTITION__" in p for p in undated.inputFiles())


def test_catalog(spark, tmp_path, rows):
    base = tmp_path / "base"
    df = spark.range(3).coalesce(1)
    df.write.parquet(str(base / "detections/year=2025/camera_id=1"))
    df.write.parquet(str(base / "detections/year=2025/camera_id=2"))
    df.write.json(str(base / "logs/day=1"))
    got = {r.dataset: r for r in catalog.dataset_stats(spark, str(base)).collect()}
    assert (got["detections"].parquet_files, got["logs"].parquet_files) == (2, 0) and got["logs"].bytes > 0
    assert rows(catalog.dataset_listing(spark, str(base)), "dataset", "partition", "files") == [
        ("detections", "year=2025/camera_id=1", 1), ("detections", "year=2025/camera_id=2", 1), ("logs", "day=1", 1)
    ]
    assert catalog.dataset_listing(spark, f"file://{base}/").count() == 3
    assert "camera_id=2" in catalog.recent_files(spark, str(base), 1).first().path
    assert catalog.recent_files(spark, str(base), 5, by_time=True).count() == 2


def test_tracks_table(spark, tmp_path, tiny):
    rows = fixtures.det(spark, tiny)
    tracks = track.as_tracks_table(track.track_objects(rows.drop("value"), track.Settings(min_iou=0.01)))
    expected = schemas.struct_of(schemas.TRACKS)
    assert [(f.name, f.dataType) for f in tracks.schema] == [(f.name, f.dataType) for f in expected]
    path = str(tmp_path / "tracks")
    tables.write_tracks(tracks, path)
    some = tracks.first()
    one = tables.find_tracks(spark, path, camera=some.camera_id, frame=some.frame_id)
    assert some.id in {r.id for r in one.collect()}
    span = tables.find_tracks(spark, path, start="2024-01-02", end="2024-01-05 12:00:00")
    wanted = tracks.where("timestamp >= '2024-01-02' and timestamp < '2024-01-05 12:00:00'")
    assert span.count() == wanted.count() > 0


# Streams -------------------------------------------------------------------

def answers(spark, sf):
    return streams._answers(streams._events(spark, sf))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        sinks.start(spark.range(1), "nope")


def test_restart_adds_no_rows(spark, tiny, tmp_path):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    for _ in range(2):
        sinks.start(answers(spark, tiny), "parquet", path=path, checkpoint=checkpoint, trigger=ONCE).awaitTermination()
    read = spark.read.parquet(path)
    assert read.count() == 1000
    assert set(tables.PARTITIONS) < set(read.columns) and "ingestion_timestamp" in read.columns


def test_processing_time_partitions(spark, tiny, tmp_path):
    path = str(tmp_path / "t")
    sinks.start(answers(spark, tiny), "hdfs", path=path, checkpoint=str(tmp_path / "c"), trigger=ONCE,
                partition_time="processing").awaitTermination()
    assert {r.year for r in spark.read.parquet(path).select("year").distinct().collect()} != {2024}


def test_console(spark, tiny):
    query = sinks.start(answers(spark, tiny), "console", trigger=ONCE)
    query.awaitTermination()
    assert query.exception() is None


def test_topic_rows_of_the_stream(spark, tiny):
    from camlytics.operators import messages

    sent = messages.detection_messages(answers(spark, tiny))
    assert sent.isStreaming and sent.columns == ["topic", "key", "value"]
    sent = sinks.topic_rows(answers(spark, tiny).withColumns({"nms_threshold": F.lit(0.4), "error": F.lit(None).cast("string"),
                            "detection_classes": F.array(F.lit("x")), "class_counts": F.lit("{}")}))
    assert sent.isStreaming and sent.columns == ["topic", "key", "value"]


def test_stream_tracks_equal_batch(spark, tiny):
    batch = fixtures.as_lanes(views.det(spark, tiny))
    expected = {(r.event_id, r.track_id, r.is_confirmed) for r in track.track_objects(batch).collect()}
    got = streams.stream_tracks(spark, tiny)
    assert {(r.event_id, r.track_id, r.is_confirmed) for r in got.collect()} == expected
    assert got.where("late").isEmpty()


def test_stream_of_many_files_equals_one(spark, tiny, tmp_path):
    """Files cut inside frames, one per batch: nothing is late, nullable numbers stay."""
    rows = fixtures.as_lanes(views.det(spark, tiny)).withColumn(
        "other", F.when(F.col("event_id") % 3 == 0, F.col("event_id") + F.lit(2**53 + 1))
    )
    rows = rows.unionByName(rows.limit(5).withColumn("frame_id", F.lit(None).cast("int")))
    parts = rows.orderBy("frame_id", "event_id").collect()
    for at in range(0, len(parts), 101):
        spark.createDataFrame(parts[at : at + 101], rows.schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={at:05d}")
        for f in (tmp_path / "in" / f"part={at:05d}").glob("*.parquet"):
            os.utime(f, (at + 1, at + 1))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = str(tmp_path / "out")
    state.track_objects(stream).writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(**ONCE).start(out).awaitTermination()
    got, batch = spark.read.parquet(out), track.track_objects(rows)
    assert got.where("late").isEmpty() and got.count() == len(parts)
    assert sorted(got.drop("late").select(batch.columns).collect(), key=repr) == sorted(batch.collect(), key=repr)


def test_stream_tracks_over_several_batches(spark, tmp_path, tiny):
    """State carries tracks across batches; a frame that comes too late is kept and marked."""
    source = tmp_path / "in"
    rows = views.det(spark, tiny).drop("value").where("camera_id <= 2").orderBy("event_id").coalesce(1).cache()
    cut = 8
    late = "frame_id = 3 and class_id = 0"
    schema = rows.schema
    settings = track.Settings(min_iou=0.05)
    for part in (f"frame_id < {cut} and not ({late})", f"frame_id >= {cut} or ({late})"):
        rows.where(part).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        query = state.track_objects(stream, settings).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query.option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    on_time = track.track_objects(rows.where(f"not ({late})"), settings)
    columns = ("event_id", "track_id", "is_confirmed")
    assert rows.count() == got.count()
    assert got.where("not late").select(*columns).exceptAll(on_time.select(*columns)).isEmpty()
    assert got.where("late").count() == rows.where(late).count() > 0
    rows.unpersist()


def test_streaming_totals_equal_batch(spark, tiny, rows):
    got = streams.stream_running_totals(spark, tiny)
    assert rows(got) == rows(stats.camera_class_counts(views.det(spark, tiny)))


def test_job_from_messages_to_table(spark, tiny, tmp_path):
    """Frame messages in files, through detector and sink, equal to the batch result."""
    source = str(tmp_path / "messages")
    parsing._frame_messages(spark, tiny).select("value", "topic").write.parquet(source)
    stream = spark.readStream.schema("value binary, topic string").parquet(source)

    def factory():
        return lambda batch: [
            [{"class_id": 0, "class_name": "person", "confidence": 0.9, "x1": 0, "y1": 0, "x2": i, "y2": 2}
             for i in range(len(bytes(image).split(b",")))]
            for image in batch["image"]
        ]

    path = str(tmp_path / "t")
    rows = app.answers(stream, factory)
    sinks.start(rows, "parquet-flattened", path=path, checkpoint=str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    read = spark.read.parquet(f"{path}_flattened")
    assert read.count() == 1000 and {"hour", "total_detections_in_frame"} <= set(read.columns)
    batch = app.answers(spark.read.parquet(source), factory)
    assert batch.agg(F.sum("total_detections")).first()[0] == 1000


def test_published_detections(spark):
    message = {"metadata": {"frame_id": 4, "total_detections": 0}, "detections": []}
    df = spark.createDataFrame([(bytearray(json.dumps(message).encode()), "camera-6-detections")], "value binary, topic string")
    row = app.published_detections(df).first()
    assert (row.camera_id, row.frame_id, row.detections) == (6, 4, [])


def test_tracks_of_each_batch_are_written_once(spark, tmp_path):
    seen = []
    write = sinks.tracks_to(lambda batch: seen.append(batch.count()))
    write(spark.range(5), 0)
    assert seen == [5]


def test_detector_is_one_python_step(spark, tiny):
    frames = app.answers(parsing._frame_messages(spark, tiny), parsing.stub_detector)
    plan = frames._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert isinstance(detect.split_errors(frames), tuple)
