"""Messages, topics, names, dates and their edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from camlytics.functions import boxes, text
from camlytics.operators import messages, parse, reshape

GOOD = {"metadata": {"camId": 1, "frameId": 0, "timestamp": "2025-10-12T10:30:00.123456",
                     "frame_shape": [1080, 1920, 3], "encoding": "base64_jpeg", "source": "hdfs"},
        "frame_data": "aGVsbG8="}


def sent(spark, *pairs):
    return spark.createDataFrame(
        [(bytearray(v if isinstance(v, bytes) else json.dumps(v).encode()), t) for v, t in pairs],
        "value binary, topic string",
    )


def test_envelope(spark):
    row = parse.parse_frames(sent(spark, (GOOD, "camera-2-frames"))).first()
    assert (row.camera_id, row.topic_camera_id, row.camera_mismatch) == (1, 2, True)
    assert (row.frame_id, row.frame_shape, row.encoding, row.frame_data) == (0, [1080, 1920, 3], "base64_jpeg", "aGVsbG8=")


def test_unmatched_topic_is_null(spark):
    row = parse.parse_frames(sent(spark, (GOOD, "other-topic"))).first()
    assert row.topic_camera_id is None and row.camera_id == 1 and row.camera_mismatch is False


def test_camera_falls_back_to_topic(spark):
    row = parse.parse_frames(sent(spark, ({"metadata": {"frameId": 3}}, "camera-7-frames"))).first()
    assert (row.camera_id, row.payload_camera_id, row.frame_id) == (7, None, 3)


def test_malformed_message_is_a_null_row(spark):
    row = parse.parse_frames(sent(spark, (b"{bad", "camera-1-frames"))).first()
    assert row.malformed and row.frame_id is None and row.frame_data is None


def test_one_bad_field_nulls_only_itself(spark):
    answer = {"metadata": {"camera_id": 3, "frame_id": "x", "total_detections": 2,
                           "class_counts": {"car": 2}}, "detections": []}
    df = spark.createDataFrame([(json.dumps(answer),)], "detection_results string")
    row = reshape.flatten_answers(parse.parse_answers(df)).first()
    assert (row.camera_id, row.frame_id, row.total_detections) == (3, None, 2)
    assert json.loads(row.class_counts) == {"car": 2}


def test_frame_log_never_parses_pixels(spark):
    df = parse.frame_log(sent(spark, (GOOD, "camera-1-frames")))
    assert "frame_data" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(df.first()) == ("camera-1-frames", 1, 0, "2025-10-12T10:30:00.123456")


def test_frameless_messages_are_skipped(spark):
    df = spark.createDataFrame([("",), (None,), ("eA==",)], "frame_data string")
    assert parse.with_pixels_only(df).count() == 1


def test_base64(spark):
    df = spark.createDataFrame([("!!!",), (None,), ("aGVsbG8=",)], "t string")
    assert [r[0] for r in df.select(text.decode_base64("t")).collect()] == [None, None, bytearray(b"hello")]
    long = spark.range(1).select(text.encode_base64(F.repeat(F.lit("x"), 500).cast("binary")).alias("e")).first().e
    assert "\n" not in long and "\r" not in long and len(long) == 668


def test_dates(spark):
    df = spark.createDataFrame([("nope",), (None,), ("2025-10-12T10:30:00.1",)], "t string")
    got = [tuple(r)[1:] for r in text.with_date_parts(df, "t").collect()]
    assert got == [(None,) * 4, (None,) * 4, (2025, 10, 12, 10)]


def test_keys_and_topics(spark):
    df = spark.createDataFrame([(4, 17), (None, 1)], "camera_id int, frame_id int")
    got = df.select(
        text.frame_key("camera_id", "frame_id"), text.detection_key("camera_id", "frame_id"),
        text.detection_key("camera_id", "frame_id", False), text.frame_topic("camera_id"),
        text.detection_topic("camera_id"),
    ).collect()
    assert tuple(got[0]) == (
        "cam4_frame17", "cam4_frame17_detections_spark", "cam4_frame17_detections", "camera-4-frames",
        "camera-4-detections",
    )
    assert tuple(got[1]) == (None,) * 5


def test_camera_range(spark, rows):
    df = spark.createDataFrame([(0,), (1,), (7,), (8,), (None,)], "camera_id int")
    good, bad = parse.valid_cameras(df)
    assert rows(good) == [(1,), (7,)]
    assert rows(bad, "error") == [(f"camera out of range: {c}",) for c in ("0", "8", "null")]


def test_names(spark):
    df = spark.createDataFrame([("/a/camera_12_frame_3.json", "2025-09-07"), ("x.json", "bad")], "p string, d string")
    got = df.select(text.camera_from_file("p"), *text.date_fields("d")).collect()
    assert [tuple(r) for r in got] == [(12, 2025, 9, 7), (None, None, None, None)]


def test_clock(spark):
    df = spark.createDataFrame([(0.0,), (59.9,), (3661.0,), (400000.0,)], "s double")
    got = [r[0] for r in df.select(text.clock_text("s")).collect()]
    assert got == ["00:00:00", "00:00:59", "01:01:01", "111:06:40"]


def test_box_rules(spark):
    row = spark.range(1).select(
        boxes.corner_box(F.lit(-0.5), F.lit(1.9), F.lit(3.2), F.lit(4.0)).alias("c"),
        boxes.size_box(F.lit(-5), F.lit(3), F.lit(-3), F.lit(5)).alias("s"),
        boxes.normalized_box(F.lit(0.5), F.lit(0.5), F.lit(0.25), F.lit(0.13), F.lit(100), F.lit(50)).alias("n"),
        boxes.best_class(F.array(F.lit(0.1), F.lit(0.7), F.lit(0.7))).alias("b"),
        boxes.round_confidence(F.lit(0.87654)).alias("r"),
    ).first()
    assert tuple(row.c) == (0, 1, 3, 2, 1, 2)
    assert tuple(row.s) == (-5, 3, -3, 5, -7, 5)
    assert tuple(row.n) == (37, 22, 25, 6)
    assert (row.b, row.r) == (1, 0.8765)


def test_class_names(spark, rows):
    df = spark.createDataFrame([(0,), (79,), (80,), (-1,), (None,)], "class_id int")
    got = dict(rows(boxes.with_class_name(df)))
    assert got == {0: "person", 79: "toothbrush", 80: "unknown", -1: "unknown", None: "unknown"}


def test_threshold(spark, rows):
    df = spark.createDataFrame([(0.39,), (0.4,), (0.41,)], "confidence double")
    assert rows(boxes.confidence_filter(df)) == [(0.41,)]
    assert rows(boxes.confidence_filter(df, inclusive=True)) == [(0.4,), (0.41,)]


FRAME = "camera_id int, frame_id int, detections array<struct<class_id int, class_name string, confidence double, " \
        "bbox struct<x int, y int, width int, height int, center_x int, center_y int>>>"


def frame(camera, number, *names):
    return (camera, number, [(0, n, 0.9, (1, 2, 3, 4, 2, 4)) for n in names])


def test_explode_and_quiet_frames(spark):
    df = spark.createDataFrame([frame(1, 0, "car", "bus"), frame(1, 1), (1, 2, None)], FRAME)
    assert reshape.explode_detections(df).count() == 2
    assert reshape.explode_detections(df, keep_empty=True).count() == 4


def test_explode_then_regroup_is_identity(spark, rows):
    df = spark.createDataFrame([frame(1, 0, "car", "bus"), frame(2, 0, "car")], FRAME)
    flat = reshape.explode_detections(df).withColumn("n", F.monotonically_increasing_id())
    box = F.struct(*[F.col(f"bbox_{f}").alias(f) for f in ("x", "y", "width", "height", "center_x", "center_y")])
    record = F.struct("class_id", "class_name", "confidence", box.alias("bbox"))
    assert rows(reshape.regroup_to_frames(flat, record=record, order=["n"])) == rows(df)


def test_rows_without_a_frame_are_not_gathered(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 2), (2, 1, 3), (2, 1, 4)], "camera_id int, frame_id int, i int")
    got = reshape.regroup_to_frames(df, record=F.col("i"), order=["i"])
    assert sorted((r.camera_id or 0, r.detections) for r in got.collect()) == [(0, [1]), (0, [2]), (2, [3, 4])]


def test_summary_in_first_seen_order(spark):
    df = spark.createDataFrame([frame(1, 0, "car", "bus", "car", None)], FRAME)
    row = messages.with_summary(df).first()
    assert row.total_detections == 4 and list(row.class_counts.items()) == [("car", 2), ("bus", 1), ("unknown", 1)]
    assert row.detection_classes == ["car", "bus", None]


def test_detection_message_keeps_frame_metadata(spark):
    df = spark.createDataFrame([frame(3, 9, "car")], FRAME).withColumns(
        {"timestamp": F.lit("t"), "meta": F.struct(F.lit(3).alias("camId"), F.lit("base64_jpeg").alias("encoding"))}
    )
    sent = messages.detection_messages(df, spark_suffix=False, processing_engine=None, frame_metadata="meta").first()
    value = json.loads(sent.value)
    assert sent.topic == "camera-3-detections" and sent.key == "cam3_frame9_detections"
    assert value["metadata"]["original_frame_metadata"] == {"camId": 3, "encoding": "base64_jpeg"}
    assert value["metadata"]["class_counts"] == {"car": 1} and len(value["detections"]) == 1


def test_frames_that_cannot_be_encoded_are_not_published(spark):
    df = spark.createDataFrame(
        [(1, 0, "t", [2, 2, 3], bytearray(b"x")), (1, 1, "t", [2, 2, 3], None), (1, 2, "t", [2, 2, 3], bytearray(b"y"))],
        "camera_id int, frame_id int, timestamp string, frame_shape array<int>, image binary",
    )
    got = messages.frame_messages(df, source="hdfs").collect()
    assert [r.key for r in got] == ["cam1_frame0", "cam1_frame2"]
    assert json.loads(got[0].value)["metadata"]["source"] == "hdfs"


def test_normalize(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("b"), F.struct(F.lit(2).alias("d")).alias("c")).alias("a"),
                               F.array(F.lit(1)).alias("l"))
    assert reshape.normalize_nested(df).columns == ["a.b", "a.c.d", "l"]


def test_expand_refuses_duplicates(spark):
    df = spark.range(1).select("id", F.struct(F.lit(1).alias("id")).alias("s"))
    with pytest.raises(ValueError):
        reshape.expand_struct(df, "s")
    assert reshape.expand_struct(df.withColumnRenamed("id", "k"), "s").columns == ["k", "id"]
