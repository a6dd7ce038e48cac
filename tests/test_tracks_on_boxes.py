"""The registered tracker queries on all detections and their own boxes, against the plain loop."""

from collections import Counter, defaultdict
from datetime import datetime

import pytest
from test_objects import plain_tracks, tracked

from camlytics import plans
from camlytics.operators import track
from camlytics.plans import views

QUERIES = plans.queries()


@pytest.fixture(scope="module")
def detections(spark, tiny):
    return views.det(spark, tiny).collect()


@pytest.fixture(scope="module")
def expected(detections):
    per_camera = defaultdict(list)
    for r in detections:
        per_camera[r.camera_id].append(r)
    return {(c, i): v for c, rows in per_camera.items() for i, v in plain_tracks(rows, track.Settings()).items()}


def test_all_detections_are_tracked_by_their_own_boxes(spark, tiny, detections, expected):
    assert len(expected) == len(detections)
    assert tracked(QUERIES["track_objects_boxes"](spark, tiny)) == expected
    stream = QUERIES["stream_tracks_boxes"](spark, tiny)
    assert tracked(stream) == expected and stream.where("late").isEmpty()


def test_what_follows_from_the_tracks(spark, tiny, detections, expected):
    sure = {key for key, (_, confirmed) in expected.items() if confirmed}
    assert sure
    assert tracked(QUERIES["confirmed_tracks_boxes"](spark, tiny)).keys() == sure
    seen = defaultdict(list)
    for r in detections:
        seen[r.camera_id, expected[r.camera_id, r.event_id][0]].append(r)
    got = {(r.camera_id, r.track_id): r for r in QUERIES["track_summary_boxes"](spark, tiny).collect()}
    assert got.keys() == seen.keys()
    for key, rows in seen.items():
        r = got[key]
        last = max(rows, key=lambda x: x.frame_id)
        assert (r.first_frame, r.last_frame, r.observations) == (min(x.frame_id for x in rows), last.frame_id, len(rows))
        assert r.class_name == last.class_name and r.confirmed == any((key[0], x.event_id) in sure for x in rows)
        assert (r.first_ts, r.last_ts) == (min(x.ts for x in rows), max(x.ts for x in rows))
    counters = QUERIES["track_counters_boxes"](spark, tiny).first()
    assert counters.total_frames_processed == len({(r.camera_id, r.frame_id) for r in detections})
    counted = [(r.camera_id, r.event_id) in sure for r in detections if r.confidence >= 0.5]
    assert (counters.total_detections, counters.total_tracks_created) == (len(counted), sum(counted))
    distinct = {r.camera_id: r.tracks for r in QUERIES["distinct_tracks_boxes"](spark, tiny).collect()}
    assert distinct == Counter(c for c, _ in {(c, expected[c, i][0]) for c, i in sure})
    for r in QUERIES["track_coverage_boxes"](spark, tiny).collect():
        own = [x for x in detections if x.camera_id == r.camera_id]
        assert (r.tracked, r.frames, r.gapless) == (len(own), len({x.frame_id for x in own}), True)
    found = {r.id: (r.track_id, r.x1, r.y1, r.x2, r.y2) for r in QUERIES["track_lookup_boxes"](spark, tiny).collect()}
    assert found == {
        r.event_id: (expected[3, r.event_id][0], r.x, r.y, r.x + r.w, r.y + r.h) for r in detections
        if (3, r.event_id) in sure and datetime(2024, 1, 10) <= r.ts < datetime(2024, 1, 15)
    }
