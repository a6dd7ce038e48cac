"""Statistics that move while a stream runs, one keyed state per camera.

Two kinds of operators. The first put rows in event-time order: rows wait in
the state until the watermark has passed them, then go on sorted, so the result
is that of the batch operator on all rows up to the watermark, however the
stream is cut into batches. A camera's own newest time already tells how far the next
watermark will be at least: rows up to there go on at once, so that a large
batch never waits in the state. An event-time timer wakes a camera that is silent.
Rows later than the watermark, or than that, are dropped. The second
hold the latest rows and say at once what changed.

State is bounded: rows within ``delay`` of the newest, a ring of N rows, or one
row. A camera is one state, as in every keyed stream; a batch of a camera is
taken in parts, never as a whole, and put in order by sorted runs on disk.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import chain, islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from camlytics.schemas import CAMERA_IDS
from camlytics.streaming import spilled

MICROS = 1_000_000
#: How rows lie in a state: with nulls, and times to the microsecond.
JSON = {
    "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
Step = Callable[[dict, int | None, Iterable], Iterator[tuple]]
#: Rows of a result that are handed on at a time.
ROWS = 10_000


def _micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def _span(delay: str) -> int | None:
    """Microseconds of a delay; None if it is no plain time, as months are not."""
    try:
        return int(pd.Timedelta(delay) / pd.Timedelta(microseconds=1))
    except ValueError:
        return None


def _times(df: DataFrame, *names: str) -> DataFrame:
    """Microsecond numbers as the wall-clock times they were made from."""
    return df.withColumns({n: F.timestamp_micros(n).cast("timestamp_ntz") for n in names})


def _in_order(rows: DataFrame, delay: str, values: list[str], schema: str, begin: dict, step: Step) -> DataFrame:
    """Runs ``step`` over each camera's rows in event-time order, equal times by ``values``.

    ``rows`` has camera_id, ts and ``values``. ``step(memory, upto, rows)`` gets
    the rows (micros, values) that the watermark has passed or is sure to pass
    next, sorted, and that time itself, changes the memory, yields rows of the result and leaves
    in ``memory["wake"]`` the time at which it wants to run again, or None.
    """
    keyed = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).withColumns({
        "_at": _micros(F.col("ts")), "_row": F.to_json(F.struct(*(values or ["ts"])), JSON),
    }).where("_at is not null").select("camera_id", "ts", "_at", "_row")
    behind = _span(delay)
    names = [c.split()[0] for c in f"camera_id int, {schema}".split(", ")]

    def advance(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        memory = json.loads(state.get[0]) if state.exists else {**begin, "waiting": [], "wake": None}
        upto, done = state.getCurrentWatermarkMs() * 1000, memory.get("done")
        times = [upto]

        def arrived() -> Iterator[pd.DataFrame]:
            if memory["waiting"]:
                yield pd.DataFrame(memory["waiting"], columns=["_at", "_row"])
            for part in batches:
                part = part[["_at", "_row"]] if done is None else part.loc[part["_at"] > done, ["_at", "_row"]]
                if len(part):
                    if behind is not None:
                        times[0] = max(times[0], int(part["_at"].max()) // 1000 * 1000 - behind)
                    yield part

        parts = spilled.in_order(arrived(), ["_at"])
        first = next(parts, None)
        until, waiting = max(times[0], done if done is not None else 0), []

        def passed() -> Iterator[tuple]:
            for part in chain([] if first is None else [first], parts):
                rows = [(at, json.loads(row)) for at, row in zip(part["_at"].tolist(), part["_row"])]
                # Nulls last among equal times.
                rows.sort(key=lambda r: (r[0], [(v is None, v if v is not None else 0) for v in r[1].values()]))
                for at, row in rows:
                    if at <= until:
                        yield at, row
                    else:
                        waiting.append((at, json.dumps(row)))

        found, ready = step(memory, until, passed()), True
        while ready:
            ready = list(islice(found, ROWS))
            if ready:
                yield pd.DataFrame([(key[0], *row) for row in ready], columns=names)
        memory.update(waiting=waiting, done=until)
        state.update((json.dumps(memory),))
        due = [at for at in (memory["wake"], waiting[0][0] if waiting else None) if at is not None]
        if due:
            # The timer fires once the watermark is beyond it; times are rounded up to the millisecond.
            state.setTimeoutTimestamp(max(-(-min(due) // 1000), upto // 1000 + 1))

    return keyed.groupBy("camera_id").applyInPandasWithState(
        advance, f"camera_id int, {schema}", "memory string", "append", GroupStateTimeout.EventTimeTimeout
    )


# Liveness -----------------------------------------------------------------------


def _alive(limit: int, memory: dict, upto: int, rows: Iterable) -> Iterator[tuple]:
    for at, _ in rows:
        last = memory["last"]
        if last is not None and at > last + limit and memory["status"] == "active":
            yield "inactive", last + limit
            memory["status"] = "inactive"
        if memory["status"] != "active":
            yield "active", at
        memory.update(last=at, status="active")
    if memory["status"] == "active" and memory["last"] + limit <= upto:
        yield "inactive", memory["last"] + limit
        memory["status"] = "inactive"
    memory["wake"] = memory["last"] + limit if memory["status"] == "active" else None


def liveness(frames: DataFrame, seconds: int = 10, delay: str = "10 seconds") -> DataFrame:
    """camera_id, status, ts: a camera is active from a frame on and inactive after ``seconds`` without one.

    Use 30 seconds for detections. ``frames`` has camera_id and ts. Frames at
    exactly the limit keep a camera active.
    """
    step = partial(_alive, seconds * MICROS)
    out = _in_order(frames.select("camera_id", "ts"), delay, [], "status string, ts bigint", {"last": None, "status": None}, step)
    return _times(out, "ts")


# Alerts --------------------------------------------------------------------------


def _lives(seconds: int, memory: dict, upto: int, rows: Iterable) -> Iterator[tuple]:
    up = [tuple(u) for u in memory["up"]]
    for at, row in rows:
        yield "raised", at, *row.values()
        heapq.heappush(up, (at + seconds * MICROS, json.dumps(row)))
    while up and up[0][0] <= upto:
        ends, row = heapq.heappop(up)
        yield "expired", ends, *json.loads(row).values()
    memory.update(up=up, wake=up[0][0] if up else None)


def alert_events(alerts: DataFrame, seconds: int = 10, delay: str = "10 seconds") -> DataFrame:
    """camera_id, event, at, frame_id, alert, count, message: each alert when it is raised and when it is over.

    ``alerts`` is a stream of ``operators.alerts.alert_feed``.
    """
    values = ["frame_id", "alert", "count", "message"]
    step = partial(_lives, seconds)
    rows = alerts.select("camera_id", "ts", *values)
    schema = "event string, at bigint, frame_id bigint, alert string, count int, message string"
    return _times(_in_order(rows, delay, values, schema, {"up": []}, step), "at")


# Rates with silent cameras ---------------------------------------------------------


def _windows(width: int, memory: dict, upto: int, rows: Iterable) -> Iterator[tuple]:
    size = width * MICROS
    for at, row in rows:
        start = at // size * size
        if memory["start"] is None:
            memory.update(start=start, frames=0, detections=0)
        while memory["start"] < start:
            yield memory["start"], memory["frames"], memory["detections"]
            memory.update(start=memory["start"] + size, frames=0, detections=0)
        memory["frames"] += row["frames"]
        memory["detections"] += row["detections"]
    if memory["start"] is not None:
        while memory["start"] + size <= upto:
            yield memory["start"], memory["frames"], memory["detections"]
            memory.update(start=memory["start"] + size, frames=0, detections=0)
        memory["wake"] = memory["start"] + size


def rates(frames: DataFrame, width: int = 5, delay: str = "10 seconds", cameras=CAMERA_IDS) -> DataFrame:
    """window_start, camera_id, frames, detections, fps, detection_rate of every camera and window, silent ones with zeros.

    ``frames`` has camera_id, ts and total_detections. The first frame of any
    camera opens the first window for all: it reaches the others as a row that
    counts nothing, as do the first and last frame of each Arrow batch, so a
    camera that never sends anything has its zeros too. A window is emitted when
    the watermark has passed its end; from the first window on none is left out.
    """
    known = [int(c) for c in cameras]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.dropna(subset=["ts"])
            if not len(rows):
                continue
            rows["window"] = rows["ts"].dt.floor(f"{width}s")
            sums = rows.groupby(["camera_id", "window"], as_index=False).agg(
                ts=("ts", "max"), frames=("ts", "size"), detections=("total_detections", "sum")
            )
            edges = pd.DataFrame([(c, t, 0, 0) for c in known for t in (rows["ts"].min(), rows["ts"].max())],
                                 columns=["camera_id", "ts", "frames", "detections"])
            yield pd.concat([sums[["camera_id", "ts", "frames", "detections"]], edges]).astype({"camera_id": int, "frames": int, "detections": int})

    sums = frames.where(F.col("camera_id").isin(known)).select(
        "camera_id", F.col("ts").cast("timestamp"), "total_detections"
    ).mapInPandas(counted, "camera_id int, ts timestamp, frames bigint, detections bigint")
    out = _in_order(
        sums, delay, ["frames", "detections"], "window_start bigint, frames bigint, detections bigint",
        {"start": None, "frames": 0, "detections": 0}, partial(_windows, width),
    )
    rate = {"fps": F.col("frames") / float(width), "detection_rate": F.col("detections") / float(width)}
    return _times(out, "window_start").withColumns(rate)


# Snapshots ------------------------------------------------------------------------


def _counted(every: int, memory: dict, upto: int, rows: Iterable) -> Iterator[tuple]:
    for at, row in rows:
        memory["messages"] += 1
        memory["detections"] += row["total_detections"]
        if memory["messages"] % every == 0:
            yield row["frame_id"], at, row["total_detections"], memory["messages"], memory["detections"]


def snapshots(frames: DataFrame, every: int = 10, delay: str = "10 seconds") -> DataFrame:
    """camera_id, frame_id, ts, total_detections, messages, detections_so_far at each ``every``-th message of a camera."""
    schema = "frame_id bigint, ts bigint, total_detections bigint, messages bigint, detections_so_far bigint"
    out = _in_order(
        frames.select("camera_id", "ts", "frame_id", "total_detections"), delay, ["frame_id", "total_detections"], schema,
        {"messages": 0, "detections": 0}, partial(_counted, every),
    )
    return _times(out, "ts")


# Latest rows -------------------------------------------------------------------------


def _held(rows: DataFrame, order: list[str], schema: str, change, show) -> DataFrame:
    """``change(memory, place, row)`` for each row of a camera as it comes; ``show(memory)`` goes out once a batch.

    ``order`` are whole numbers; what a camera shows carries ``version``, the
    number of rows it has had, so the newest wins wherever it is kept.
    """
    keyed = rows.select("camera_id", F.array(*[F.col(c).cast("bigint") for c in order]).alias("_order"), "_row")
    names = [c.split()[0] for c in f"camera_id int, version bigint, {schema}".split(", ")]

    def advance(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        memory = json.loads(state.get[0]) if state.exists else {"version": 0}
        for part in batches:
            memory["version"] += len(part)
            for place, row in zip(part["_order"], part["_row"]):
                change(memory, [int(v) for v in place], row)
        state.update((json.dumps(memory),))
        yield pd.DataFrame([(key[0], memory["version"], *r) for r in show(memory)], columns=names)

    return keyed.groupBy("camera_id").applyInPandasWithState(
        advance, f"camera_id int, version bigint, {schema}", "memory string", "update", GroupStateTimeout.NoTimeout
    )


def _ring(n: int, memory: dict, place: list, row: str) -> None:
    rows = memory.setdefault("rows", [])
    entry = [place, row]
    if len(rows) < n:
        heapq.heappush(rows, entry)
    elif entry > rows[0]:
        heapq.heapreplace(rows, entry)


def _ring_shown(memory: dict) -> list:
    return [[row] for _, row in memory["rows"]]


def last_n(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """camera_id, version, row: the last ``n`` rows of each camera by ``order``, again whenever the camera has new rows.

    ``row`` is JSON of all columns. Per camera the rows of the highest version
    are the ones that hold; ``newest`` picks them.
    """
    packed = rows.withColumn("_row", F.to_json(F.struct("*"), JSON))
    return _held(packed, order, "row string", partial(_ring, n), _ring_shown)


def _latest(memory: dict, place: list, row: str) -> None:
    side = json.loads(row)["side"]
    if side not in memory or place > memory[side][0]:
        memory[side] = [place, row]


def _latest_shown(memory: dict) -> list:
    return [[memory["frame"][1], memory["answer"][1] if "answer" in memory else None]] if "frame" in memory else []


def overlay(frames: DataFrame, answers: DataFrame, order: list[str]) -> DataFrame:
    """camera_id, version, frame, answer: the latest frame of each camera with its latest answer, from two streams.

    Both have camera_id and the ``order`` columns. ``frame`` and ``answer`` are JSON of all
    columns of their sides; a camera is shown from its first frame on.
    """
    def side(rows: DataFrame, name: str) -> DataFrame:
        whole = F.to_json(F.struct(F.lit(name).alias("side"), "*"), JSON)
        return rows.select("camera_id", *order, whole.alias("_row"))

    return _held(side(frames, "frame").unionByName(side(answers, "answer")), order, "frame string, answer string", _latest, _latest_shown)


def unpacked(row: str, schema) -> Column:
    """A JSON column of ``last_n`` or ``overlay`` as the row it was."""
    return F.from_json(row, schema, {k: v for k, v in JSON.items() if k != "ignoreNullFields"})


def newest(rows: DataFrame) -> DataFrame:
    """What each camera shows now, of all that ``last_n`` or ``overlay`` has written."""
    versions = rows.groupBy("camera_id").agg(F.max("version").alias("version"))
    return rows.join(versions, ["camera_id", "version"]).drop("version")
