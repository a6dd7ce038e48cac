"""Block-wise running sums and limits equal the plain windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from camlytics import fixtures
from camlytics.operators import ordered, windows


@pytest.fixture(scope="module")
def det(spark, tiny):
    rows = fixtures.det(spark, tiny).cache()
    yield rows
    rows.unpersist()


@pytest.mark.parametrize("order", [["event_id"], ["ts", "event_id"], ["class_name", "event_id"]])
@pytest.mark.parametrize("block", [10**6, 100, 29])
def test_running_sums(det, order, block):
    upto = lambda *keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    expected = det.select(
        "event_id", F.sum(F.lit(1)).over(upto("camera_id")).alias("n"),
        F.sum("x").over(upto("camera_id", "class_name")).alias("s"), F.sum("y").over(upto(F.lit(0))).alias("g"),
    )
    got = ordered.running_sums_by(
        det,
        {"n": (["camera_id"], F.lit(1)), "s": (["camera_id", "class_name"], F.col("x")), "g": ([], F.col("y"))},
        order, block,
    ).select("event_id", "n", "s", "g")
    assert got.exceptAll(expected).isEmpty() and got.count() == expected.count()


def test_null_keys_and_values(spark, rows):
    data = [(None, i, None if i % 3 == 0 else i) for i in range(20)] + [(1, i, i) for i in range(20)]
    df = spark.createDataFrame(data, "k int, i int, v int")
    upto = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("s", F.sum("v").over(upto))
    assert rows(ordered.running_sums(df, ["k"], ["i"], {"s": F.col("v")}, 4)) == rows(expected)


def test_one_camera_with_a_third_of_the_rows_is_split(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 6 + 2).cast("int")).alias("camera_id"), "id"
    )
    blocked = ordered.in_blocks(df, ["id"], 500)
    largest = blocked.df.groupBy("camera_id", "_block").count().agg(F.max("count")).first()[0]
    assert blocked.many and largest < 600


def test_equal_times_are_split_by_the_second_column(spark):
    df = spark.range(10000).select(F.lit(5).alias("t"), "id")
    largest = ordered.in_blocks(df, ["t", "id"], 500).df.groupBy("_block").count().agg(F.max("count")).first()[0]
    assert largest <= 600


def test_outliers_do_not_unbalance_the_blocks(spark):
    value = F.when(F.col("id") == 7, -1e15).when(F.col("id") == 8, 1e15).otherwise(F.rand(1))
    df = spark.range(200_000).select("id", value.alias("v"))
    sizes = ordered.in_blocks(df, ["v"], 10_000).df.groupBy("_block").count().agg(F.max("count")).first()[0]
    assert sizes < 20_000


@pytest.mark.parametrize("n", [3, 1500])
def test_first_and_last(det, n, monkeypatch, rows):
    monkeypatch.setattr(ordered, "_EARLY_LIMIT", 1000)
    n = min(n, 1500) if n < 1000 else 1001
    base = det.select("camera_id", "event_id")
    for newest, take in ((False, ordered.first_n), (True, ordered.last_n)):
        sort = F.desc("event_id") if newest else F.asc("event_id")
        rank = F.row_number().over(Window.partitionBy("camera_id").orderBy(sort))
        expected = base.withColumn("r", rank).where(F.col("r") <= n).drop("r")
        assert rows(take(base, ["camera_id"], ["event_id"], n, 50)) == rows(expected)


def test_large_n_goes_through_the_blocks(det, monkeypatch, rows):
    monkeypatch.setattr(ordered, "_EARLY_LIMIT", 2)
    base = det.select("camera_id", "event_id")
    for newest, take in ((False, ordered.first_n), (True, ordered.last_n)):
        sort = F.desc("event_id") if newest else F.asc("event_id")
        rank = F.row_number().over(Window.partitionBy("camera_id").orderBy(sort))
        expected = base.withColumn("r", rank).where(F.col("r") <= 20).drop("r")
        assert rows(take(base, ["camera_id"], ["event_id"], 20, 50)) == rows(expected)


def test_limit_is_taken_before_the_shuffle(det):
    plan = ordered.last_n(det, ["camera_id"], ["event_id"], 50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_snapshots_and_sequence(spark, rows):
    df = spark.createDataFrame([(1, i, i % 2) for i in range(25)], "camera_id int, t int, total_detections int")
    assert rows(windows.snapshots(df, ["t"], 10), "t", "messages", "detections_so_far") == [(19, 20, 10), (9, 10, 5)]
    assert rows(windows.frame_sequence(df, ["t"], rows_per_block=4), "t", "frame_id") == sorted(
        [(i, i) for i in range(25)], key=repr
    )


def test_defaults(spark):
    df = spark.createDataFrame(
        [(0, 5, 7, "a"), (1, None, None, None), (2, 3, None, "c")],
        "i int, camera_id int, frame_id int, timestamp string",
    )
    got = windows.with_defaults(df, ["i"], F.lit("now")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [("5", 7, "a"), ("unknown", 1, "now"), ("3", 2, "c")]


def test_span_of_rates_as_given(spark):
    """A wrong clock does not stretch the windows; silent windows at both ends are there."""
    from datetime import datetime

    from camlytics.operators import windows

    rows = [(1, datetime(2024, 1, 1, 12, 0, 7), 2), (2, datetime(2024, 1, 1, 12, 0, 11), 3), (1, datetime(1970, 1, 1), 9), (2, datetime(2124, 1, 1), 9)]
    frames = spark.createDataFrame(rows, "camera_id int, ts timestamp_ntz, total_detections long")
    got = windows.tumbling_rates(frames, 5, cameras=(1, 2), start="2024-01-01 12:00:00", end="2024-01-01 12:00:20").collect()
    want = {(s, c): 0.0 for s in (0, 5, 10, 15) for c in (1, 2)} | {(5, 1): 0.4, (10, 2): 0.6}
    assert {(r.window_start.second, r.camera_id): r.detection_rate for r in got} == want
    silent = windows.tumbling_rates(frames.limit(0), 5, cameras=(1,), start="2024-01-01 12:00:00", end="2024-01-01 12:00:20")
    assert silent.count() == 4


def test_last_rows_over_many_tasks(spark):
    from camlytics.operators import ordered

    rows = spark.range(20_000).selectExpr("id % 3 as camera_id", "id div 2 as at", "id").repartition(40)
    got = ordered.last_n(rows, ["camera_id"], ["at", "id"], 100)
    assert sorted(r.id for r in got.collect()) == list(range(20_000 - 300, 20_000))
