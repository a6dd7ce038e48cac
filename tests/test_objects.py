"""Suppression, tracking, similarity and detection against plain Python."""

import math
import random
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from camlytics import fixtures
from camlytics.operators import detect, nms, similarity, track


cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def det(spark, tiny):
    rows = fixtures.det(spark, tiny).drop("value").cache()
    yield rows
    rows.unpersist()


def iou(a, b):
    dx = max(min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), 0)
    dy = max(min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]), 0)
    union = a[2] * a[3] + b[2] * b[3] - dx * dy
    return dx * dy / union if union > 0 else 0.0


def greedy(boxes, overlap):
    kept = []
    for b in sorted(boxes, key=lambda b: (-b[5], b[4])):
        if all(iou(k, b) <= overlap for k in kept):
            kept.append(b)
    return sorted(b[4] for b in kept)


# Suppression ---------------------------------------------------------------

@pytest.mark.parametrize("overlap", [0.1, 0.4])
def test_nms_equals_greedy(det, overlap):
    frames = {}
    for r in det.where("confidence > 0.4").collect():
        frames.setdefault((r.camera_id, r.frame_id), []).append((r.x, r.y, r.w, r.h, r.event_id, r.confidence))
    expected = sorted(i for boxes in frames.values() for i in greedy(boxes, overlap))
    got = nms.suppress(det, overlap=overlap)
    assert sorted(r.event_id for r in got.collect()) == expected and got.columns == det.columns


def test_dense_frame_equals_greedy(spark):
    """One frame holds a third of all rows, many of them copies of one box."""
    pick = random.Random(7)
    data = []
    for i in range(900):
        frame = 0 if i % 3 == 0 else i
        if i % 4 == 0:
            box = (10, 10, 20, 20)
        else:
            box = (pick.randrange(200), pick.randrange(200), pick.randrange(0, 90), pick.randrange(1, 60))
        data.append((1, frame, i, pick.randrange(41, 100) / 100, *box))
    df = spark.createDataFrame(
        data, "camera_id int, frame_id int, event_id bigint, confidence double, x int, y int, w int, h int"
    )
    frames = {}
    for c, f, i, s, x, y, w, h in data:
        frames.setdefault(f, []).append((x, y, w, h, i, s))
    expected = sorted(i for boxes in frames.values() for i in greedy(boxes, 0.4))
    got = nms.suppress(df, dense_limit=60)
    assert sorted(r.event_id for r in got.collect()) == expected


@pytest.mark.parametrize("limit", [None, 1])
def test_rows_without_frame_or_box_are_kept(spark, limit):
    df = spark.createDataFrame(
        [(1, None, 1, 0.9, 0, 0, 9, 9), (1, None, 2, 0.8, 0, 0, 9, 9), (1, 0, 3, 0.9, None, 0, 9, 9),
         (1, 0, 4, 0.9, 0, 0, 0, 9), (1, 0, 5, 0.9, 0, 0, 9, 9), (1, 0, 6, 0.8, 0, 0, 9, 9)],
        "camera_id int, frame_id int, event_id bigint, confidence double, x int, y int, w int, h int",
    )
    assert sorted(r.event_id for r in nms.suppress(df, dense_limit=limit).collect()) == [1, 2, 3, 4, 5]


def test_equal_scores_keep_the_lower_id(spark):
    df = spark.createDataFrame(
        [(1, 0, 2, 0.9, 0, 0, 10, 10), (1, 0, 1, 0.9, 1, 0, 10, 10)],
        "camera_id int, frame_id int, event_id bigint, confidence double, x int, y int, w int, h int",
    )
    assert [r.event_id for r in nms.suppress(df).collect()] == [1]


# Tracking ------------------------------------------------------------------

def moving(spark, frames, step=2, **extra):
    """One object sliding right, seen in the given frames."""
    data = [(1, f, f, step * f, 0, 40, 40) for f in frames]
    return spark.createDataFrame(
        data, "camera_id int, frame_id int, event_id bigint, x int, y int, w int, h int"
    )


def plain_tracks(rows, s):
    """The rule written out for one camera: event id -> (track id, confirmed)."""
    out, live, born, last = {}, [], 0, None
    for f in sorted({r.frame_id for r in rows}):
        here = sorted((r for r in rows if r.frame_id == f), key=lambda r: r.event_id)
        boxes = [(r.x, r.y, r.w, r.h) for r in here]
        gap = f - last if s.advance_on_empty and last is not None else 1
        if gap > 1:
            live = [t for t in live if t["hits"] >= s.n_init and t["missed"] + gap - 1 <= s.max_age]
        for t in live:
            t["missed"] += gap
        last = f
        pairs = sorted(
            (-iou(t["box"], b), t["head"], d, t)
            for t in live for d, b in enumerate(boxes) if iou(t["box"], b) >= s.min_iou
        ) if live else []
        owner, used = {}, set()
        for _, head, d, t in pairs:
            if d not in owner and head not in used:
                owner[d] = t
                used.add(head)
        for d, r in enumerate(here):
            t = owner.get(d)
            if t is None:
                born += 1
                t = {"id": born, "hits": 0}
                live.append(t)
            t |= {"head": r.event_id, "box": boxes[d], "missed": 0, "hits": t["hits"] + 1}
            out[r.event_id] = (t["id"], t["hits"] >= s.n_init)
        live = [t for t in live if t["missed"] == 0 or (t["hits"] >= s.n_init and t["missed"] <= s.max_age)]
    return out


def tracked(df):
    return {(r.camera_id, r.event_id): (r.track_id, r.is_confirmed) for r in df.collect()}


@pytest.mark.parametrize("settings", [
    track.Settings(), track.Settings(min_iou=0.05, n_init=2, max_age=5),
    track.Settings(min_iou=0.05, max_age=3, advance_on_empty=True),
])
@pytest.mark.parametrize("segment, warm", [(5000, None), (20, None), (6, 0)])
def test_tracks_equal_the_plain_rule(det, settings, segment, warm):
    per_camera = {}
    for r in det.collect():
        per_camera.setdefault(r.camera_id, []).append(r)
    expected = {(c, i): v for c, rows in per_camera.items() for i, v in plain_tracks(rows, settings).items()}
    got = track.track_objects(det, settings, segment_frames=segment, warm_up=warm)
    assert tracked(got) == expected


def test_confirmed_at_the_third_hit(spark):
    got = track.track_objects(moving(spark, range(5))).orderBy("frame_id").collect()
    assert [(r.track_id, r.is_confirmed) for r in got] == [(1, False), (1, False), (1, True), (1, True), (1, True)]


@pytest.mark.parametrize("lost, same", [(30, True), (31, False)])
def test_lost_object(spark, lost, same):
    """A second object keeps the tracker moving while the first is away."""
    first = moving(spark, [0, 1, 2, 3, 4 + lost], step=0)
    other = first.sparkSession.range(40).select(
        F.lit(1).alias("camera_id"), F.col("id").cast("int").alias("frame_id"), (F.col("id") + 1000).alias("event_id"),
        F.lit(500).alias("x"), F.lit(500).alias("y"), F.lit(40).alias("w"), F.lit(40).alias("h"),
    )
    got = tracked(track.track_objects(first.unionByName(other)))
    assert (got[1, 4 + lost][0] == got[1, 3][0]) is same


def test_long_track_through_many_segments(spark):
    got = track.track_objects(moving(spark, range(64)), segment_frames=4, warm_up=2)
    assert {r.track_id for r in got.collect()} == {1}


def test_rows_without_a_frame_are_kept(spark):
    df = moving(spark, range(3)).unionByName(moving(spark, [9]).withColumn("frame_id", F.lit(None).cast("int")))
    got = tracked(track.track_objects(df))
    assert len(got) == 4 and got[1, 9] == (None, None)


@pytest.mark.parametrize("segment, warm", [(5000, None), (20, 3), (6, 0)])
def test_values_stay_what_they_are(det, segment, warm):
    """Ids and nullable numbers beyond 2^53 come back unchanged, repairs of segments included."""
    big = F.lit(2**53 + 1)
    rows = det.withColumn("event_id", F.col("event_id") * 2 + big).withColumn(
        "other", F.when(F.col("event_id") % 3 == 0, F.col("event_id") + big)
    )
    settings = track.Settings(min_iou=0.05)
    got = track.track_objects(rows, settings, segment_frames=segment, warm_up=warm)
    assert got.select(rows.columns).exceptAll(rows).isEmpty() and rows.exceptAll(got.select(rows.columns)).isEmpty()
    whole = tracked(track.track_objects(rows, settings))
    assert tracked(got) == whole


def test_frame_that_goes_on():
    """More detections of the last frame join the tracks that have none in it yet."""
    def box(x):
        return [float(x), 0.0, float(x + 10), 10.0]

    t = track.Tracker(track.Settings())
    for f in range(3):
        assert t.update(f, [10 * f, 10 * f + 1], np.array([box(0), box(100)]))[0] == [0, 1]
    assert t.update(3, [30], np.array([box(0)]))[0] == [0]
    again = track.Tracker.load(t.settings, t.dump())
    assert again.update(3, [31, 32], np.array([box(100), box(0)]))[0] == [1, 2]


def test_embedding_gate():
    same, other = [1.0, 0.0], [0.0, 1.0]
    for second, expected in ((same, [0]), (other, [1])):
        t = track.Tracker(track.Settings())
        box = np.array([[0.0, 0.0, 10.0, 10.0]])
        t.update(0, [1], box, [same])
        assert t.update(1, [2], box, [second])[0] == expected


def test_summary(spark):
    row = track.track_summary(
        track.track_objects(moving(spark, range(5)).withColumn("class_name", F.lit("car")))
    ).first()
    assert (row.first_frame, row.last_frame, row.observations, row.confirmed, row.class_name) == (0, 4, 5, True, "car")


@pytest.mark.parametrize("overlap", [0.0, 0.05, 0.3, 0.9, 1.0])
def test_same_boxes_for_any_limit(spark, overlap):
    """NaN scores, text as tie and any overlap give the same boxes in one array and on the grid."""
    draw = np.random.default_rng(5)
    rows = [
        (1, 1, f"t{i:03d}", float("nan") if i % 17 == 0 else round(float(draw.uniform(0.3, 1)), 1),
         int(draw.integers(0, 200)), int(draw.integers(0, 200)), int(draw.integers(0, 60)), int(draw.integers(1, 60)))
        for i in range(150)
    ]
    df = spark.createDataFrame(rows, "camera_id int, frame_id int, tag string, confidence double, x int, y int, w int, h int")
    kept = [
        {r.tag for r in nms.suppress(df, overlap=overlap, tie="tag", dense_limit=limit).collect()} for limit in (None, 10, 2000)
    ]
    assert kept[0] == kept[1] == kept[2] and kept[0]


# Similarity ----------------------------------------------------------------

@pytest.mark.parametrize("probe_bytes", [1 << 20, 2000])
def test_all_pairs_top_k_equals_brute_force(spark, probe_bytes):
    pick = np.random.default_rng(3)
    vectors = np.round(pick.normal(size=(60, 8)), 3)
    vectors[10] = vectors[20]
    vectors[30] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    size = np.linalg.norm(vectors.astype(np.float32).astype(float), axis=1)
    unit = vectors.astype(np.float32).astype(float) / np.where(size > 0, size, 1)[:, None]
    scores = np.round(unit @ unit.T, 9)
    expected = {(p, r + 1): int(v) for p in range(60)
                for r, v in enumerate(sorted(range(60), key=lambda j: (-scores[p, j], j))[:4])}
    got = similarity.top_k(df, df, 4, probe_id="vec_id", probe_bytes=probe_bytes, stored_bytes=17 * 8 * len(df.first()["embedding"]))
    assert {(r.probe_id, r["rank"]): r.vec_id for r in got.collect()} == expected


def test_min_similarity_and_no_probes(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = similarity.top_k(df.limit(1), df, 3, probe_id="vec_id", min_similarity=0.8)
    assert sorted(r.vec_id for r in got.collect()) == [0, 1]
    assert similarity.top_k(df.limit(0), df, 3, probe_id="vec_id").count() == 0
    cosine = df.select(similarity.cosine(F.col("embedding"), F.array(F.lit(1.0), F.lit(1.0)))).first()[0]
    assert cosine == pytest.approx(1 / math.sqrt(2))


# Detection -----------------------------------------------------------------

def scorer():
    loaded = []

    def score(batch):
        loaded.append(1)
        out = []
        for image in batch["image"]:
            if bytes(image) == b"boom":
                raise RuntimeError("no such model")
            out.append([
                {"class_id": 0, "class_name": "person", "confidence": 0.87654, "x1": 1.6, "y1": 2.0, "x2": 4.9, "y2": 9.0},
                {"class_id": 2, "class_name": "car", "confidence": 0.4, "x1": 0, "y1": 0, "x2": 1, "y2": 1},
            ])
        return out

    return score


def test_detect_answers_every_frame(spark):
    df = spark.createDataFrame(
        [(1, 0, "t0", "aGk="), (1, 1, "t1", ""), (1, 2, "t2", None), (1, 3, "t3", "?bad?"), (1, 4, "t4", "Ym9vbQ==")],
        "camera_id int, frame_id int, timestamp string, frame_data string",
    )
    got = {r.frame_id: r for r in detect.detect(df, scorer).collect()}
    assert got[0].total_detections == 1 and got[0].detections[0].confidence == 0.8765
    assert tuple(got[0].detections[0].bbox) == (1, 2, 3, 7, 3, 5) and got[0].detection_timestamp == "t0"
    for quiet in (1, 2):
        assert got[quiet].error is None and got[quiet].detection_timestamp is None
        assert got[quiet].total_detections == 0 and got[quiet].confidence_threshold == 0.4
    assert got[3].error == "Failed to decode image" and got[3].confidence_threshold is None
    assert got[4].error == "no such model" and got[4].detection_timestamp is None
    good, bad = detect.split_errors(detect.detect(df, scorer, keep_frame=True))
    assert (good.count(), bad.count()) == (3, 2) and "frame_data" in good.columns


def test_wrong_number_of_answers_is_an_error(spark):
    df = spark.createDataFrame([(1, 0, "t", "aGk=")], "camera_id int, frame_id int, timestamp string, frame_data string")
    row = detect.detect(df, lambda: lambda batch: []).first()
    assert row.error == "scorer gave 0 answers for 1 rows"
