"""Tracks written once, row groups that a lookup leaves out, and file listings against a walk."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from camlytics import plans, schemas
from camlytics.plans import storage
from camlytics.sinks import tables

QUERIES = plans.queries()


def tracks(spark, rows, first=0):
    df = spark.range(first, first + rows).select(
        "id", (F.col("id") % 2).cast("int").alias("camera_id"), (F.col("id") / 4).cast("int").alias("frame_id"),
        (F.col("id") % 7).alias("track_id"), F.lit(datetime(2024, 1, 1)).alias("timestamp"),
    )
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.struct_of(schemas.TRACKS)
    ])


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    once = tables.TracksOnce(str(tmp_path))
    once(tracks(spark, 20), 0)
    once(tracks(spark, 15, 20), 1)
    assert ids(once.read(spark)) == list(range(35))
    # The same batches again, as after a restart; the second one with rows that came late.
    once(tracks(spark, 20), 0)
    once(tracks(spark, 30, 20), 1)
    assert ids(once.read(spark)) == list(range(35))
    assert once.read(spark).columns == [f.name for f in schemas.struct_of(schemas.TRACKS)]


def test_a_batch_without_commit_is_replaced(spark, tmp_path):
    once = tables.TracksOnce(str(tmp_path))
    once(tracks(spark, 4), 0)
    # A crash after half of the second batch's files.
    tables.write_tracks(tracks(spark, 3, 4), f"{tmp_path}/data/query=tracks/batch=1", "overwrite")
    assert ids(once.read(spark)) == list(range(4))
    once(tracks(spark, 9, 4), 1)
    assert ids(once.read(spark)) == list(range(13))


def test_two_streams_and_empty_batches(spark, tmp_path):
    one, two = (tables.TracksOnce(str(tmp_path), n) for n in ("one", "two"))
    one(tracks(spark, 4), 0)
    two(tracks(spark, 4, 10), 0)
    one(tracks(spark, 0), 1)
    assert ids(one.read(spark)) == [0, 1, 2, 3, 10, 11, 12, 13]


def test_a_stream_that_starts_again(spark, tmp_path):
    """The checkpoint forgets the last batch, as if the driver had died before it was noted: the batch runs again."""
    source, checkpoint = f"{tmp_path}/source", f"{tmp_path}/checkpoint"
    once = tables.TracksOnce(f"{tmp_path}/tracks")

    def run():
        stream = spark.readStream.schema(schemas.TRACKS).parquet(source)
        writer = stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    for k in range(2):
        tracks(spark, 10, 10 * k).coalesce(1).write.mode("append").parquet(source)
        run()
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    run()
    assert ids(once.read(spark)) == list(range(20))


def test_a_lookup_leaves_row_groups_out(spark, tmp_path):
    rows = tracks(spark, 400_000).withColumn("embedding", F.expr("transform(sequence(1, 16), i -> cast(hash(id, i) as float))"))
    tables.write_tracks(rows.coalesce(1), str(tmp_path))
    found = tables.find_tracks(spark, str(tmp_path), camera=1, frame=70_000)
    assert found.count() == 2
    found.collect()
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    scan = leaves.apply(0) if leaves.size() else None
    plan = scan.executedPlan() if hasattr(scan, "executedPlan") and "Adaptive" in scan.getClass().getName() else scan
    read = plan.metrics().apply("numOutputRows").value()
    assert 0 < read < 100_000


def test_listings_like_a_walk(spark, tiny, monkeypatch):
    base = storage._datasets(spark, tiny)
    monkeypatch.setattr(storage, "_datasets", lambda *_: base)
    top = base.removeprefix("file:")
    walked = [
        (os.path.relpath(folder, top), name, os.path.getsize(f"{folder}/{name}"))
        for folder, _, names in os.walk(top) for name in names if not name.startswith((".", "_"))
    ]
    by_folder, by_set = {}, {}
    for folder, name, size in walked:
        dataset, _, partition = folder.partition("/")
        n, b = by_folder.get((dataset, partition), (0, 0))
        by_folder[dataset, partition] = n + 1, b + size
        n, b = by_set.get(dataset, (0, 0))
        by_set[dataset] = n + name.endswith(".parquet"), b + size
    assert {(r.dataset, r.partition): (r.files, r.bytes) for r in QUERIES["partition_files"](spark, tiny).collect()} == by_folder
    assert {r.dataset: (r.parquet_files, r.bytes) for r in QUERIES["dataset_files"](spark, tiny).collect()} == by_set
    paths = sorted((f"{folder}/{name}" for folder, name, _ in walked if name.endswith(".parquet")), reverse=True)[:10]
    got = [r.path.split(top + "/")[1] for r in QUERIES["last_ten_files"](spark, tiny).collect()]
    assert sorted(got, reverse=True) == paths
