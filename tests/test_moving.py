"""Stream statistics against their batch twins, over one batch and over many."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from camlytics.operators import alerts, joins, ordered, windows
from camlytics.plans import moving
from camlytics.streaming import timers

START = datetime(2024, 1, 1, 12)
DELAY = "10 seconds"


def at(seconds):
    return START + timedelta(seconds=seconds)


def streamed(spark, path, df, cuts):
    """``df`` as a stream of one batch per part; ``cuts`` are times in seconds."""
    edges = [-10**6, *cuts, 10**6]
    for low, high in zip(edges, edges[1:]):
        df.where(F.col("ts").between(F.lit(at(low)), F.lit(at(high) - timedelta(microseconds=1)))).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, rows, mode="append"):
    return moving._run(spark, rows, mode)


def as_set(rows):
    return sorted(map(tuple, rows), key=repr)


CUTS = [[], [5, 18, 55]]
#: Camera 1 falls silent twice, camera 2 sends once, camera 3 goes on to the end.
FRAMES = [(1, i, at(s), 1 + i % 3) for i, s in enumerate([0, 3, 3.5, 9, 30, 31, 39, 70])] + [(2, 0, at(17.25), 4)] + [
    (3, i, at(2 * i + 1), i % 2) for i in range(50)
]
SCHEMA = "camera_id int, frame_id long, ts timestamp_ntz, total_detections long"
UPTO = 99 - 10


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(FRAMES, SCHEMA)


@pytest.mark.parametrize("cuts", CUTS)
def test_liveness(spark, tmp_path, frames, cuts):
    got = run(spark, timers.liveness(streamed(spark, f"{tmp_path}/in", frames, cuts), 10, DELAY))
    want = []
    for camera in (1, 2, 3):
        times = sorted(r[2] for r in FRAMES if r[0] == camera and r[2] <= at(UPTO))
        for k, t in enumerate(times):
            if k == 0 or t - times[k - 1] > timedelta(seconds=10):
                want.append((camera, "active", t))
            ends = t + timedelta(seconds=10)
            if times[k + 1] > ends if k + 1 < len(times) else ends <= at(UPTO):
                want.append((camera, "inactive", ends))
    assert as_set(got.select("camera_id", "status", "ts").collect()) == as_set(want)
    assert {w[0] for w in want if w[1] == "inactive"} == {1, 2}


@pytest.mark.parametrize("cuts", CUTS)
def test_alert_events(spark, tmp_path, cuts):
    rows = [(c, i, at(s), kind, n, f"{kind} {n}") for i, (c, s, kind, n) in enumerate(
        [(1, 0, "crowd", 6), (1, 4, "crowd", 7), (1, 4, "traffic", 4), (2, 33, "crowd", 9), (2, 75, "crowd", 8), (1, 99, "crowd", 6)]
    )]
    feed = spark.createDataFrame(rows, "camera_id int, frame_id int, ts timestamp_ntz, alert string, count int, message string")
    feed = feed.withColumn("expires_at", F.col("ts") + F.expr("interval 10 seconds"))
    got = run(spark, timers.alert_events(streamed(spark, f"{tmp_path}/in", feed, cuts), 10, DELAY))
    for moment in (0, 4, 11, 14, 35, 80, UPTO):
        up = got.where(F.col("at") <= F.lit(at(moment))).groupBy("camera_id", "frame_id", "alert").agg(
            F.count_if(F.col("event") == "raised").alias("raised"), F.count_if(F.col("event") == "expired").alias("over")
        ).where("raised > over").select("camera_id", "frame_id", "alert")
        batch = alerts.active_alerts(feed, F.lit(at(moment))).select("camera_id", "frame_id", "alert")
        assert as_set(up.collect()) == as_set(batch.collect())
    assert got.where("event = 'raised'").count() == 5


@pytest.mark.parametrize("cuts", CUTS)
def test_rates_have_silent_cameras(spark, tmp_path, frames, cuts):
    got = run(spark, timers.rates(streamed(spark, f"{tmp_path}/in", frames, cuts), 5, DELAY))
    batch = windows.tumbling_rates(frames, 5).where(F.col("window_start") + F.expr("interval 5 seconds") <= F.lit(at(UPTO)))
    columns = ["window_start", "camera_id", "fps", "detection_rate"]
    assert as_set(got.select(columns).collect()) == as_set(batch.select(columns).collect())
    assert got.where("camera_id = 7 and fps = 0").count() == UPTO // 5


@pytest.mark.parametrize("cuts", CUTS)
def test_snapshots(spark, tmp_path, frames, cuts):
    got = run(spark, timers.snapshots(streamed(spark, f"{tmp_path}/in", frames, cuts), 4, DELAY))
    batch = windows.snapshots(frames.where(F.col("ts") <= F.lit(at(UPTO))), ["ts"], 4, keys=["camera_id"])
    assert as_set(got.select(batch.columns).collect()) == as_set(batch.collect())


@pytest.mark.parametrize("cuts", CUTS)
def test_last_n(spark, tmp_path, frames, cuts, n=7):
    stream = streamed(spark, f"{tmp_path}/in", frames, cuts)
    held = timers.newest(run(spark, timers.last_n(stream, n, ["frame_id"]), "update"))
    got = held.select(timers.unpacked("row", frames.schema).alias("r")).select("r.*")
    assert as_set(got.collect()) == as_set(ordered.last_n(frames, ["camera_id"], ["frame_id"], n).collect())


@pytest.mark.parametrize("cuts", CUTS)
def test_overlay(spark, tmp_path, frames, cuts):
    answers = frames.where("camera_id < 3 and frame_id % 2 = 0").withColumn("classes", F.concat(F.lit("c"), "frame_id"))
    batch = joins.overlay(
        frames, answers, frame_columns=["frame_id"], detection_columns=["frame_id", "classes"], frame_order=["frame_id"], detection_order=["frame_id"]
    )
    left, right = streamed(spark, f"{tmp_path}/f", frames, cuts), streamed(spark, f"{tmp_path}/a", answers, cuts[:1])
    held = timers.newest(run(spark, timers.overlay(left, right, ["frame_id"]), "update"))
    got = held.select("camera_id", timers.unpacked("frame", frames.schema)["frame_id"], timers.unpacked("answer", answers.schema)["frame_id"],
                      timers.unpacked("answer", answers.schema)["classes"])
    assert as_set(got.collect()) == as_set(batch.select("camera_id", "frame_id", "detection_frame_id", "classes").collect())


def test_stopped_and_restarted(spark, tmp_path, frames):
    """A query stopped after its first batches and started again from its checkpoint ends like one run."""
    cuts = [5, 18, 55]
    path, checkpoint, out = (f"{tmp_path}/{n}" for n in ("in", "checkpoint", "out"))

    def start(stream):
        rows = timers.liveness(stream, 10, DELAY)
        writer = rows.writeStream.outputMode("append").foreachBatch(
            lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/number={number}")
        )
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    early = frames.where(F.col("ts") < F.lit(at(18)))
    start(streamed(spark, path, early, cuts))
    late = frames.where(F.col("ts") >= F.lit(at(18)))
    start(streamed(spark, path, late, cuts))
    whole = run(spark, timers.liveness(streamed(spark, f"{tmp_path}/again", frames, cuts), 10, DELAY))
    got = spark.read.parquet(out).select("camera_id", "status", "ts")
    assert as_set(got.collect()) == as_set(whole.select("camera_id", "status", "ts").collect())
