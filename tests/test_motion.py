"""Tracking by motion and appearance against a plain loop with textbook matrices and exhaustive assignment."""

import random
from collections import defaultdict

import numpy as np
import pytest
from test_objects import iou, tracked

from camlytics import plans
from camlytics.operators import motion, track
from camlytics.plans import views
from camlytics.session import scratch_path
from camlytics.streaming import state as streaming

QUERIES = plans.queries()
SMALL = motion.Motion(memory=6, max_age=10)


def best(costs, most):
    """Accepted pairs of the least total, where a pair left out costs a little more than ``most``: over all subsets of columns."""
    rows, columns = costs.shape
    table = {0: (0.0, ())}
    for r in range(rows):
        further = dict(table)
        for used, (total, pairs) in table.items():
            for c in range(columns):
                if costs[r, c] <= most and not used >> c & 1:
                    new = (total + costs[r, c] - most - 1e-5, (*pairs, (r, c)))
                    if new[0] < further.get(used | 1 << c, (np.inf,))[0]:
                        further[used | 1 << c] = new
        table = further
    return sorted(min(table.values())[1])


def test_assignment_is_the_cheapest():
    rnd = np.random.default_rng(4)
    for _ in range(300):
        rows, columns = rnd.integers(0, 7, 2)
        costs = rnd.random((rows, columns))
        assert sorted(motion._matched(costs, 0.6)) == best(costs, 0.6)


class Filter:
    """The filter with whole matrices: eight numbers, one step at a time."""

    move = np.eye(8) + np.eye(8, k=4)

    def __init__(self, trail):
        for step, (_, gap, *z) in enumerate(trail):
            z = np.array(z)
            if not step:
                h = z[3]
                self.x = np.concatenate([z, np.zeros(4)])
                self.p = np.diag(np.square([h / 10, h / 10, 1e-2, h / 10, h / 16, h / 16, 1e-5, h / 16]))
                self.h = h
                continue
            self.ahead(gap)
            s = self.measured()
            k = self.p[:, :4] @ np.linalg.inv(s)
            self.x = self.x + k @ (z - self.x[:4])
            self.p = self.p - k @ s @ k.T
            self.h = self.x[3]

    def ahead(self, n):
        h = self.h
        q = np.diag(np.square([h / 20, h / 20, 1e-2, h / 20, h / 160, h / 160, 1e-5, h / 160]))
        for _ in range(n):
            self.x = self.move @ self.x
            self.p = self.move @ self.p @ self.move.T + q
        return self

    def measured(self):
        h = self.x[3]
        return self.p[:4, :4] + np.diag(np.square([h / 20, h / 20, 1e-1, h / 20]))


def test_filter_like_matrices():
    rnd = random.Random(3)
    for _ in range(40):
        trail = [[k, rnd.randint(1, 4), *(rnd.uniform(20, 90) for _ in range(4))] for k in range(rnd.randint(1, 9))]
        plain = Filter(trail)
        settled = motion._settled([trail, trail[-1:]])
        assert np.allclose(settled[0, :, 0], plain.x[:4]) and np.allclose(settled[1, :, 0], plain.x[4:])
        ahead = motion._foretold(settled[:, :, :1], np.array([3]))
        plain.ahead(3)
        assert np.allclose(ahead[0, :, 0], plain.x[:4]) and np.allclose(ahead[2, :, 0], np.diag(plain.p)[:4])
        assert np.allclose(ahead[4, :, 0], np.diag(plain.p, 4)) and np.allclose(ahead[3, :, 0], np.diag(plain.p)[4:])


def plain_tracks(rows, s, looks=None):
    """Track and confirmation of each detection of one camera, frame by frame."""
    frames = defaultdict(list)
    for r in rows:
        frames[r.frame_id].append(r)
    alive, out, count = [], {}, 0

    def pairs(tracks, free, cost, most):
        if not tracks or not free:
            return []
        found = best(np.array([[cost(t, r) for r in free] for t in tracks]), most)
        return [(tracks[i], free[j]) for i, j in found]

    for frame in sorted(frames):
        free = sorted(frames[frame], key=lambda r: r.event_id)
        for t in alive:
            t["missed"] += 1
            t["filter"] = Filter(t["trail"]).ahead(t["missed"])
        alive.sort(key=lambda t: t["trail"][-1][0])
        got = []

        def apart(t, r):
            z = np.array(motion._measured([r.x, r.y, r.x + r.w, r.y + r.h])) - t["filter"].x[:4]
            return float((z * z / np.diag(t["filter"].measured())).sum())

        def unlike(t, r):
            if apart(t, r) > s.gate:
                return np.inf
            mine = looks.get(r.event_id)
            likes = [1.0 if a is None or mine is None else float(np.dot(a, mine) / np.linalg.norm(a) / np.linalg.norm(mine)) for a in t["looks"]]
            return 1 - max(likes)

        def overlap(t, r):
            x, y, a, h = t["filter"].x[:4]
            return 1 - iou((x - a * h / 2, y - h / 2, a * h, h), (r.x, r.y, r.w, r.h))

        def take(found):
            for t, r in found:
                got.append((t, r))
                free.remove(r)

        sure = [t for t in alive if t["hits"] >= s.n_init]
        for age in sorted({t["missed"] for t in sure}):
            cost, most = (apart, s.gate) if looks is None else (unlike, s.max_cosine_distance)
            take(pairs([t for t in sure if t["missed"] == age], free, cost, most))
        taken = [id(t) for t, _ in got]
        rest = [t for t in alive if id(t) not in taken and (t["hits"] < s.n_init or t["missed"] == 1)]
        take(pairs(rest, free, overlap, 1 - s.min_iou))
        for r in list(free):
            count += 1
            got.append(({"id": count, "hits": 0, "missed": 0, "trail": [], "looks": []}, r))
            alive.append(got[-1][0])
        # New tracks are numbered by detection.
        for t, r in got:
            t["trail"] = [*t["trail"], [r.event_id, t["missed"], *motion._measured([r.x, r.y, r.x + r.w, r.y + r.h])]][-s.memory:]
            t["looks"] = [*t["looks"], None if looks is None else looks.get(r.event_id)][-s.memory:]
            t["hits"], t["missed"] = min(t["hits"] + 1, s.n_init), 0
            out[r.event_id] = (t["id"], t["hits"] >= s.n_init)
        alive = [t for t in alive if not t["missed"] or (t["hits"] >= s.n_init and t["missed"] <= s.max_age)]
    return out


def per_camera(rows, s, looks=None):
    cameras = defaultdict(list)
    for r in rows:
        cameras[r.camera_id].append(r)
    return {(c, i): v for c, some in cameras.items() for i, v in plain_tracks(some, s, looks).items()}


@pytest.fixture(scope="module")
def detections(spark, tiny):
    return views.det(spark, tiny).collect()


@pytest.fixture(scope="module")
def looks(spark, tiny):
    by_user = {r.vec_id: r.embedding for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()}
    return {r.event_id: by_user.get(r.user_id) for r in spark.read.parquet(f"{tiny}/events.parquet").collect()}


def test_motion_like_the_loop(spark, tiny, detections):
    assert tracked(QUERIES["track_motion"](spark, tiny)) == per_camera(detections, motion.Motion())


def test_appearance_like_the_loop(spark, tiny, detections, looks):
    got = QUERIES["track_appearance"](spark, tiny)
    assert tracked(got) == per_camera(detections, motion.Motion(), looks)
    assert "embedding" in got.columns


def movers(seed, frames=60, objects=6):
    """Objects on straight ways that cross, seen nine times in ten, with a look of their own."""
    rnd = random.Random(seed)
    out, name = [], 0
    ways = [(rnd.uniform(0, 600), rnd.uniform(0, 400), rnd.uniform(-9, 9), rnd.uniform(-9, 9), rnd.randint(30, 60)) for _ in range(objects)]
    for frame in range(frames):
        for k, (x, y, vx, vy, size) in enumerate(ways):
            if rnd.random() < 0.9:
                look = [1.0 if j == k else rnd.uniform(0, 0.1) for j in range(objects)]
                out.append((name, 1, frame, int(x + vx * frame), int(y + vy * frame), size, size, look, k))
                name += 1
    return out


SCHEMA = "event_id long, camera_id int, frame_id int, x int, y int, w int, h int, embedding array<double>, who int"


@pytest.mark.parametrize("by_look", [False, True])
def test_segments_and_stream_equal_one_run(spark, by_look):
    rows = movers(1)
    df = spark.createDataFrame(rows, SCHEMA)
    columns = track.Columns(embedding="embedding" if by_look else None)
    whole = tracked(track.track_objects(df, SMALL, columns))
    looks = {r[0]: r[7] for r in rows} if by_look else None
    assert whole == per_camera(df.collect(), SMALL, looks)
    assert tracked(track.track_objects(df, SMALL, columns, segment_frames=13, warm_up=4)) == whole
    path = scratch_path(spark, "movers")
    for low in range(0, 60, 25):
        df.where(f"frame_id >= {low} and frame_id < {low + 25}").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    writer = streaming.track_objects(stream, SMALL, columns).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert tracked(spark.read.parquet(out)) == whole


def test_objects_keep_their_track(spark):
    """Straight ways and looks keep crossing objects apart, and found again after a gap in which overlap alone would lose them."""
    rows = [(0 + 2 * f, 1, f, 12 * f, 100, 30, 30, [1.0, 0.0], 0) for f in range(24) if not 7 <= f < 11]
    rows += [(1 + 2 * f, 1, f, 228 - 12 * f, 110, 30, 30, [0.0, 1.0], 1) for f in range(24) if not 12 <= f < 16]
    df = spark.createDataFrame(rows, SCHEMA)

    def names(settings, columns=track.Columns()):
        found = track.track_objects(df, settings, columns).select("who", "track_id").distinct().collect()
        return len(found)

    assert names(motion.Motion(), track.Columns(embedding="embedding")) == 2
    assert names(track.Settings()) > 2


def test_nulls_and_empty_tables(spark):
    rows = [(1, 1, 0, 0, 0, 9, 9, None, 0), (2, 1, 1, 0, 0, 9, 9, [0.0, 0.0], 0), (3, 1, 2, 1, 0, 9, 9, [1.0, 0.0], 0),
            (4, None, 2, 1, 0, 9, 9, None, 0), (5, 1, 3, None, 0, 9, 9, None, 0), (6, 1, 3, 0, 0, 9, 0, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id: r.track_id for r in track.track_objects(df, motion.Motion(), track.Columns(embedding="embedding")).collect()}
    assert got[1] == got[2] == got[3] == 1 and got[4] is None and got[5] is None
    assert track.track_objects(df.limit(0), motion.Motion()).count() == 0


def test_state_is_bounded():
    tracker = motion.MotionTracker(SMALL)
    sizes = []
    for frame in range(200):
        tracker.update(frame, [frame], np.array([[3.0 * frame, 0, 3.0 * frame + 20, 30]]), [[1.0, 0.0]])
        sizes.append(len(tracker.dump()))
    assert tracker.next_ref == 1 and max(sizes[50:]) < 1.2 * sizes[20]
    again = motion.MotionTracker.load(SMALL, tracker.dump())
    assert again.signature() == tracker.signature() and np.allclose(again.tracks[0].state, tracker.tracks[0].state)


def test_segments_query_equals_one_run(spark):
    """Four segments a camera, guessed, repaired and joined, against one run over all frames."""
    sf = "/root/testdata/sf0.01"
    assert tracked(QUERIES["track_segments"](spark, sf)) == tracked(QUERIES["track_objects_boxes"](spark, sf))


def test_guesses_that_never_agree_take_few_rounds(spark, monkeypatch):
    """A track remembered from its first frame on is guessed by no segment; stretches of segments are run through, not one a round."""
    df = spark.createDataFrame([(f, 1, f, 0, 0, 9, 9, None, 0) for f in range(200)], SCHEMA)
    rounds, again = [], track._Segments._again

    def counted(self, *args):
        rounds.append(args)
        return again(self, *args)

    monkeypatch.setattr(track._Segments, "_again", counted)
    settings = motion.Motion(memory=1000)
    got = track.track_objects(df, settings, segment_frames=5, warm_up=2).collect()
    assert len(got) == 200 and {r.track_id for r in got} == {1}
    assert len(rounds) == 2


def test_a_camera_without_agreeing_guesses_is_read_once(spark, monkeypatch):
    """Camera 1 has one track remembered from its first frame on; camera 2 has a new track in each frame, so all its guesses agree."""
    rows = [(2 * f + k, k + 1, f, 40 * f * k, 0, 9, 9, None, 0) for f in range(200) for k in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    found, again = [], track._Segments._again

    def counted(self, *args):
        found.append(args)
        return again(self, *args)

    monkeypatch.setattr(track._Segments, "_again", counted)
    monkeypatch.setattr(track, "LONG", 0, raising=False)
    monkeypatch.setattr(track, "SHORT", 0, raising=False)
    got = track.track_objects(df, motion.Motion(memory=1000), segment_frames=5, warm_up=2)
    assert {(r.camera_id, r.frame_id, r.track_id) for r in got.collect()} == {(k + 1, f, 1 + f * k) for f in range(200) for k in range(2)}
    assert not found


@pytest.mark.parametrize("size", [1, 3, 50])
def test_a_camera_read_in_batches_equals_one_run(spark, size):
    """Frames are whole whatever the batches are, and cameras in one task begin anew."""
    rnd = random.Random(size)
    rows = [(n, 1 + n // 4 % 3, n // 12, rnd.randint(0, 60), rnd.randint(0, 60), rnd.randint(20, 50), rnd.randint(20, 50), None, 0) for n in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    cameras = spark.createDataFrame([(1, 0), (2, 1), (3, 8)], "camera_id int, _turn int")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        in_turn = tracked(track._in_turn(df, cameras, SMALL, track.Columns()))
    finally:
        spark.conf.set(name, before)
    assert in_turn == tracked(track.track_objects(df, SMALL))


def test_few_costs_are_assigned_as_many(monkeypatch):
    rnd = np.random.default_rng(5)
    for _ in range(300):
        costs = rnd.integers(0, 6, rnd.integers(1, 9, 2)) / 7
        few = motion.assign(costs)
        with monkeypatch.context() as m:
            m.setattr(motion, "_FEW", 0)
            assert motion.assign(costs) == few


def test_an_update_moves_each_filter_once(monkeypatch):
    """Filters go on from where they are and are those of whole trails, also when the oldest detections are forgotten."""
    steps, corrected = [], motion._corrected
    monkeypatch.setattr(motion, "_corrected", lambda *args: steps.append(1) or corrected(*args))
    tracker, rnd = motion.MotionTracker(SMALL), random.Random(2)
    for frame in range(40):
        tracker.update(frame, [2 * frame, 2 * frame + 1], np.array([[frame + rnd.random(), 0, frame + 20, 30], [500, 0, 520 + rnd.random(), 30]]))
    assert tracker.next_ref == 2 and len(steps) == 39
    assert np.array_equal(np.stack([t.state for t in tracker.tracks], axis=2), motion._settled([t.trail for t in tracker.tracks]))


def test_equal_looks_are_equally_far():
    rnd = np.random.default_rng(1)
    a, b = motion._Moving(0, 0, 3, 1, []), motion._Moving(1, 1, 3, 1, [])
    look = rnd.normal(size=64)
    a.gallery, b.gallery = [*rnd.normal(size=(7, 64)), look], [look, *rnd.normal(size=(2, 64))]
    for n in range(1, 12):
        far = motion.MotionTracker._unlike([a, b], [look] * n, np.ones((2, n), dtype=bool))
        assert len(set(far.ravel().tolist())) == 1
