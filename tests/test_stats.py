"""Totals, liveness, rates, joins and alerts on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from camlytics.operators import alerts, joins, stats, windows
from camlytics.schemas import camera_dimension

T0 = dt.datetime(2025, 1, 1)
FRAMES = "camera_id int, frame_id int, ts timestamp_ntz, total_detections int"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def frames(spark, *data):
    return spark.createDataFrame([(c, f, at(t), n) for c, f, t, n in data], FRAMES)


def test_averages_count_quiet_frames(spark):
    df = frames(spark, (1, 0, 0, 4), (1, 1, 1, 0))
    assert stats.average_detections(df).first()[0] == 2.0
    assert stats.average_detections(df.limit(0)).first()[0] is None


def test_throughput_guard(spark):
    assert stats.throughput(frames(spark, (1, 0, 0, 1))).first().frames_per_second == 0.0
    assert stats.throughput(frames(spark, (1, 0, 0, 1), (1, 1, 4, 1))).first().frames_per_second == 0.5


def test_camera_without_detections_is_listed(spark, rows):
    df = frames(spark, (1, 0, 0, 2), (2, 0, 0, 0))
    assert rows(stats.detections_by_camera(df)) == [(1, 2), (2, 0)]


def test_liveness_is_strict(spark):
    seen = frames(spark, (1, 0, 0, 0), (2, 0, 1, 0))
    found = frames(spark, (1, 0, 0, 0), (2, 0, 20, 0))
    status = stats.camera_status(seen, found, F.lit(at(10)).cast("timestamp_ntz"), cameras=(1, 2, 3))
    got = {r.camera_id: (r.total_frames, r.status, r.detection_status) for r in status.collect()}
    assert got == {1: (1, "inactive", "active"), 2: (1, "active", "active"), 3: (0, "inactive", "inactive")}
    late = stats.camera_status(seen, found, F.lit(at(30)).cast("timestamp_ntz"), cameras=(1, 2))
    assert {r.camera_id: r.detection_status for r in late.collect()} == {1: "inactive", 2: "active"}
    assert stats.any_camera_detecting(late).first()[0] is True


def test_empty_detection_message_moves_last_seen(spark):
    row = stats.last_seen(frames(spark, (1, 0, 0, 1)), frames(spark, (1, 0, 0, 1), (1, 1, 9, 0))).first()
    assert row.last_frame_time == at(0) and row.last_detection_time == at(9)


def test_rates_fill_silent_windows_and_cameras(spark):
    df = frames(spark, (1, 0, 0, 3), (1, 1, 4, 2), (1, 2, 11, 5))
    got = {(r.window_start, r.camera_id): (r.fps, r.detection_rate)
           for r in windows.tumbling_rates(df, 5, cameras=(1, 2)).collect()}
    assert len(got) == 6
    assert got[at(0), 1] == (0.4, 1.0) and got[at(5), 1] == (0.0, 0.0) and got[at(10), 1] == (0.2, 1.0)
    assert got[at(10), 2] == (0.0, 0.0)
    total = {r.window_start: r.shown for r in windows.global_rate(windows.tumbling_rates(df, 5)).collect()}
    assert total == {at(0): 1.0, at(5): 0.0, at(10): 1.0}


def test_long_grid_has_no_gap(spark):
    df = frames(spark, (1, 0, 0, 1), (1, 1, 5 * 10000, 1))
    grid = windows.tumbling_rates(df, 5, cameras=(1,))
    assert grid.count() == grid.select("window_start").distinct().count() == 10001


def test_rate_limit_keeps_newest(spark):
    df = frames(spark, (1, 0, 0.01, 1), (1, 1, 0.05, 1), (1, 2, 0.11, 1))
    got = windows.rate_limited(df).orderBy("frame_id").collect()
    assert [r.frame_id for r in got] == [1, 2]


def test_uptime(spark):
    row = windows.uptime(frames(spark, (1, 0, 0, 1), (1, 1, 3725, 1))).first()
    assert (row.uptime_seconds, row.uptime) == (3725.0, "01:02:05")


def test_running_mean_equals_average(spark):
    xs = [3.0, 5.0, 10.0]
    mean, n = 0.0, 0
    for x in xs:
        n += 1
        mean = (mean * (n - 1) + x) / n
    df = spark.createDataFrame([(x,) for x in xs], "processing_time_ms double")
    assert stats.mean_processing_time(df).first().avg_processing_time_ms == pytest.approx(mean)


def test_service_counters(spark):
    df = spark.createDataFrame(
        [(1, 0, 0.5, True), (1, 0, 0.49, True), (1, 1, 0.9, False), (1, 1, 0.9, None)],
        "camera_id int, frame_id int, confidence double, is_confirmed boolean",
    )
    assert tuple(stats.service_counters(stats.frame_service_counts(df)).first()) == (2, 3, 1)


def test_pivot_and_unknown(spark):
    df = spark.createDataFrame([(1, "car"), (1, None), (1, "car")], "camera_id int, class_name string")
    row = stats.camera_class_counts(df, pivot=["car", "unknown", "bus"]).first()
    assert (row["car"], row["unknown"], row["bus"]) == (2, 1, 0)


DETECTED = "camera_id int, frame_id int, ts timestamp_ntz, detections array<struct<class_name string>>"


def detected(spark, *names, camera=1):
    return spark.createDataFrame([(camera, 0, at(0), [(n,) for n in names])], DETECTED)


def test_crowd_rule(spark):
    six = detected(spark, "person", *["car"] * 5)
    row = alerts.crowd_alerts(six).first()
    assert row.message == "Crowd detected in Camera 1: 6 people" and row.expires_at == at(10)
    assert alerts.crowd_alerts(six, strict=True).isEmpty()
    assert alerts.crowd_alerts(detected(spark, "person", *["car"] * 4)).isEmpty()
    assert alerts.crowd_alerts(detected(spark, *["car"] * 9)).isEmpty()
    assert not alerts.crowd_alerts(detected(spark, *["person"] * 6), strict=True).isEmpty()


def test_traffic_rule(spark):
    assert alerts.traffic_alerts(detected(spark, *["car"] * 4)).isEmpty()
    assert not alerts.traffic_alerts(detected(spark, *["car"] * 4), strict=True).isEmpty()
    row = alerts.traffic_alerts(detected(spark, "car", "truck", "bus", "motorcycle")).first()
    assert row.message == "High traffic in Camera 1: 4 vehicles"


def test_feed_gate_and_lifetime(spark):
    both = detected(spark, "person", "person", "car", "truck", "bus", "motorcycle")
    feed = alerts.alert_feed(both)
    assert sorted(r.alert for r in feed.collect()) == ["crowd", "traffic"]
    assert alerts.alert_feed(both, camera=2).isEmpty() and alerts.alert_feed(detected(spark)).isEmpty()
    shown = lambda t: alerts.active_alerts(feed, F.lit(at(t)).cast("timestamp_ntz")).count()
    assert [shown(t) for t in (-1, 0, 9.9, 10)] == [0, 2, 2, 0]
    sent = alerts.alert_messages(feed).orderBy("key").first()
    assert (sent.topic, sent.key) == ("system-alerts", "cam_1_0_crowd")


def test_missing_and_complete(spark, rows):
    here = spark.createDataFrame([(1,), (1,), (3,)], "camera_id int")
    assert rows(joins.missing(camera_dimension(spark, (1, 2, 3)), here, ["camera_id"])) == [(2,)]
    assert tuple(joins.is_complete(camera_dimension(spark, (1, 2, 3)), here, ["camera_id"]).first()) == (2, 3, False)
    assert joins.is_complete(camera_dimension(spark, (1, 3)), here, ["camera_id"]).first().complete
    new = spark.createDataFrame([(1,), (2,)], "camera_id int")
    assert rows(joins.to_load(new, here, ["camera_id"])) == [(2,)]
    assert joins.to_load(new, here, ["camera_id"], force=True).count() == 2


def test_overlay_keeps_cameras_without_detections(spark, rows):
    f = frames(spark, (1, 0, 0, 1), (1, 1, 5, 1), (2, 0, 0, 1))
    d = frames(spark, (1, 0, 0, 7))
    got = joins.overlay(f, d, frame_columns=["frame_id"], detection_columns=["frame_id", "total_detections"],
                        frame_order=["ts"], detection_order=["ts"])
    assert rows(got) == [(1, 1, 0, 7), (2, 0, None, None)]


def test_camera_list(spark, rows):
    assert rows(stats.camera_list(frames(spark, (2, 0, 0, 1)), (1, 2))) == [(1, False), (2, True)]
