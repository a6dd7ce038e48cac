"""Batches larger than a worker's memory: rows of a key in order by sorted runs."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from test_objects import tracked

from camlytics.operators import track
from camlytics.session import scratch_path
from camlytics.streaming import spilled, state, timers


def test_runs_give_the_order_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(spilled, "ROWS", 100)
    monkeypatch.setattr(spilled, "BLOCK", 16)
    rnd = np.random.default_rng(0)
    for n, kinds in ((0, 9), (50, 9), (1000, 40), (3000, 40), (3000, 1), (3000, 2500)):
        rows = pd.DataFrame({"a": rnd.integers(0, kinds, n), "b": rnd.integers(0, 3, n), "c": range(n)})
        rows["t"] = [None if c % 5 == 0 else str(c) for c in rows["c"]]
        parts = list(spilled.in_order((rows.iloc[i : i + 37] for i in range(0, n, 37)), ["a", "b"]))
        if not n:
            assert not parts
            continue
        wanted = rows.sort_values(["a", "b"], kind="stable", ignore_index=True)
        got = pd.concat(parts, ignore_index=True)
        assert got[["a", "b", "c"]].equals(wanted[["a", "b", "c"]])
        assert [v or None for v in got["t"].where(got["t"].notna(), None)] == [v or None for v in wanted["t"].where(wanted["t"].notna(), None)]
        assert sum(p["a"].nunique() for p in parts) == rows["a"].nunique()
        if kinds == 2500:
            assert max(map(len, parts)) < 1000


class Held:
    """A state of one camera, as Spark hands it to the function."""

    def __init__(self):
        self.value, self.exists = None, False

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value, self.exists = value, True

    def getCurrentWatermarkMs(self):  # noqa: N802
        return 0

    def setTimeoutTimestamp(self, at):  # noqa: N802
        pass


def test_the_state_holds_no_more_than_the_delay(spark, monkeypatch):
    """A first batch of any length: rows wait only as far back as the delay reaches from the newest."""
    given = {}
    monkeypatch.setattr(timers, "GroupState", Held)
    rows = spark.range(5).select(F.lit(1).alias("camera_id"), F.timestamp_seconds("id").alias("ts"))

    class Keyed:
        def applyInPandasWithState(self, function, *_):  # noqa: N802
            given["step"] = function
            return rows.select("camera_id", F.lit("x").alias("status"), F.lit(0).cast("bigint").alias("ts"))

    monkeypatch.setattr(type(rows), "groupBy", lambda *_: Keyed())
    timers.liveness(rows, 10, "10 seconds")
    held, second = Held(), 1_000_000
    batch = [pd.DataFrame({"_at": [k * second for k in range(low, low + 500)], "_row": ['{"ts": ""}'] * 500}) for low in range(1000, 0, -500)]
    out = pd.concat(list(given["step"]((1,), batch, held)))
    assert out["status"].tolist() == ["active"]
    memory = json.loads(held.value[0])
    assert len(memory["waiting"]) == 10 and memory["last"] == 1489 * second


def test_one_batch_in_many_runs_gives_the_same_tracks(spark, monkeypatch):
    """Workers get the limits with the module, so the plain function is run on the batch here."""
    rnd = np.random.default_rng(5)
    n = 4000
    rows = pd.DataFrame({
        "event_id": np.arange(n), "camera_id": 1, "frame_id": np.arange(n) // 4, "x": rnd.integers(0, 90, n), "y": rnd.integers(0, 90, n),
        "w": 40, "h": 40,
    }).sample(frac=1, random_state=1)
    path = scratch_path(spark, "boxes")
    df = spark.createDataFrame(rows, "event_id long, camera_id int, frame_id int, x int, y int, w int, h int")
    df.coalesce(1).write.parquet(path)
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    writer = state.track_objects(spark.readStream.schema(df.schema).parquet(path)).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert tracked(spark.read.parquet(out)) == tracked(track.track_objects(df))
    monkeypatch.setattr(spilled, "ROWS", 300)
    monkeypatch.setattr(spilled, "BLOCK", 16)
    parts = list(spilled.in_order((rows.iloc[i : i + 50] for i in range(0, n, 50)), ["frame_id", "event_id"]))
    assert len(parts) > 10 and pd.concat(parts)["event_id"].tolist() == list(range(n))
