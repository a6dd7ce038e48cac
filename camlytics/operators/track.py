"""Following objects from frame to frame, camera by camera.

One camera may hold a large share of all rows, and a tracker is sequential. So
a camera's frames are cut into segments of bounded length that run in parallel.
Each segment first replays a few frames before its start to guess the tracks
alive there. The guess is then compared with how the segment before really
ended. From the first wrong guess in a stretch of segments on, one task goes
through the stretch and runs again what does not start as the segment before
it ends; stretches grow sixteenfold until no guess is wrong. So guesses that never
agree cost a few runs over all frames, not one per segment. A camera of many
segments is tried out before: where runs from different starts never end alike
in a few of its segments, no guess will agree, and one task reads the camera's
frames in order, once. The result is exactly that of one tracker reading all
frames in order.

Association is by overlap: pairs of live track and detection are taken by
falling IoU, optionally only when their embeddings are close. A track is
confirmed after ``n_init`` hits; an unconfirmed one ends at its first miss, a
confirmed one after more than ``max_age`` updates without a hit. Frames without
detections do not advance the tracker unless ``advance_on_empty``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camlytics.operators import ordered
from camlytics.session import cut_lineage, scratch_path, spread


@dataclass(frozen=True)
class Settings:
    """n_init, max_age and max_cosine_distance are the usual defaults."""

    n_init: int = 3
    max_age: int = 30
    max_cosine_distance: float = 0.2
    min_iou: float = 0.3
    advance_on_empty: bool = False

    def tracker(self, state: str | None = None) -> Tracker:
        """A tracker that goes on from a saved state, if there is one."""
        return Tracker.load(self, state)


@dataclass
class _Track:
    ref: int
    head: int
    hits: int
    missed: int
    box: list
    embedding: list | None = None
    gap = 0  # updates between the last two detections


@dataclass
class Tracker:
    """The live tracks of one camera, moved on one frame at a time."""

    settings: Settings
    tracks: list[_Track] = field(default_factory=list)
    next_ref: int = 0
    last_frame: int | None = None
    kind = _Track

    def _confirmed(self, track: _Track) -> bool:
        return track.hits >= self.settings.n_init

    def _close(self) -> None:
        """The frame is over: tracks that missed it for good end."""
        self.tracks = [
            t for t in self.tracks
            if t.missed == 0 or (self._confirmed(t) and t.missed <= self.settings.max_age)
        ]
        # Ties are broken by the last detection, so the order never depends on
        # how long ago a track began.
        self.tracks.sort(key=lambda t: t.head)

    def _age(self, frame: int) -> None:
        if frame == self.last_frame:
            return
        self._close()
        gap = 1
        if self.settings.advance_on_empty and self.last_frame is not None:
            gap = frame - self.last_frame
        if gap > 1:
            self.tracks = [
                t for t in self.tracks
                if self._confirmed(t) and t.missed + gap - 1 <= self.settings.max_age
            ]
        for t in self.tracks:
            t.missed += gap
        self.last_frame = frame

    def update(self, frame: int, ids, boxes: np.ndarray, embeddings=None) -> tuple[list, list]:
        """Track of each detection and whether that track is confirmed by now.

        More detections of the last frame go to tracks that have none in it yet.
        """
        self._age(frame)
        owner: list[_Track | None] = [None] * len(ids)
        taken = {at for at, t in enumerate(self.tracks) if t.missed == 0}
        for t, d in self._pairs(boxes, embeddings):
            if t in taken or owner[d] is not None:
                continue
            taken.add(t)
            owner[d] = self.tracks[t]
        places = boxes.tolist()
        for d, track in enumerate(owner):
            embedding = None if embeddings is None else embeddings[d]
            if track is None:
                track = owner[d] = self.kind(self.next_ref, 0, 0, 0, [])
                self.next_ref += 1
                self.tracks.append(track)
            self._observe(track, int(ids[d]), places[d], embedding)
        self._observed(owner)
        return [t.ref for t in owner], [self._confirmed(t) for t in owner]

    def _observe(self, track: _Track, name: int, box, embedding) -> None:
        """The track has this detection now."""
        track.gap, track.head, track.missed = track.missed, name, 0
        track.hits = min(track.hits + 1, self.settings.n_init)
        track.box = [float(v) for v in box]
        track.embedding = None if embedding is None else [float(v) for v in embedding]

    def _observed(self, tracks: list[_Track]) -> None:
        """All detections of an update have their track."""

    def _pairs(self, boxes: np.ndarray, embeddings):
        if not self.tracks or not len(boxes):
            return
        a = np.array([t.box for t in self.tracks])[:, None, :]
        b = boxes[None, :, :]
        shared = np.minimum(a[..., 2:], b[..., 2:]) - np.maximum(a[..., :2], b[..., :2])
        inter = np.prod(np.clip(shared, 0, None), axis=2)
        area = np.prod(a[..., 2:] - a[..., :2], axis=2) + np.prod(b[..., 2:] - b[..., :2], axis=2)
        union = area - inter
        overlap = np.divide(inter, union, out=np.zeros_like(inter), where=union > 0)
        t_at, d_at = np.nonzero(overlap >= self.settings.min_iou)
        order = np.lexsort((d_at, t_at, -overlap[t_at, d_at]))
        for at in order:
            t, d = int(t_at[at]), int(d_at[at])
            if embeddings is None or self._alike(self.tracks[t].embedding, embeddings[d]):
                yield t, d

    def _alike(self, a, b) -> bool:
        if a is None or b is None:
            return True
        a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
        size = np.linalg.norm(a) * np.linalg.norm(b)
        return size == 0 or 1 - float(a @ b) / size <= self.settings.max_cosine_distance

    def signature(self) -> str:
        """Everything the future of the tracker depends on, without names."""
        self._close()
        last = self.last_frame if self.settings.advance_on_empty else None
        return json.dumps([last, [[t.head, t.hits, t.missed] for t in self.tracks]])

    def dump(self) -> str:
        rows = [self._saved(t) for t in self.tracks]
        return json.dumps({"next": self.next_ref, "last": self.last_frame, "tracks": rows})

    def _saved(self, t: _Track) -> list:
        return [t.ref, t.head, t.hits, t.missed, t.box, t.embedding]

    @classmethod
    def load(cls, settings: Settings, state: str | None) -> Tracker:
        if not state:
            return cls(settings)
        saved = json.loads(state)
        return cls(settings, [cls.kind(*row) for row in saved["tracks"]], saved["next"], saved["last"])

    def rename_inherited(self) -> None:
        """Names for a new segment: inherited tracks -1, -2, ..., new ones from 0."""
        self._close()
        for at, track in enumerate(self.tracks):
            track.ref = -1 - at
        self.next_ref = 0


@dataclass(frozen=True)
class Columns:
    """Names of the input columns; boxes are corners unless ``sized``."""

    camera: str = "camera_id"
    frame: str = "frame_id"
    id: str = "event_id"
    box: tuple[str, str, str, str] = ("x", "y", "w", "h")
    sized: bool = True
    embedding: str | None = None


def _in_order(rows: pa.Table, c: Columns) -> pa.Table:
    return rows.sort_by([(c.frame, "ascending"), (c.id, "ascending")])


def _vectors(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """The lists of a column, each as an array."""
    out: list[np.ndarray | None] = []
    for chunk in column.chunks:
        values = chunk.values.to_numpy(zero_copy_only=False)
        at = chunk.offsets.to_numpy().tolist()
        here = chunk.is_valid().to_pylist()
        out += [values[lo:hi] if there else None for lo, hi, there in zip(at, at[1:], here)]
    return out


def run_sorted(tracker: Tracker, rows: pa.Table, c: Columns) -> tuple[np.ndarray, np.ndarray]:
    """Feed sorted rows frame by frame: reference and confirmation of each."""
    boxes = np.stack([rows[name].to_numpy().astype(float) for name in c.box], axis=1)
    if c.sized:
        boxes[:, 2:] += boxes[:, :2]
    ids, frames = rows[c.id].to_numpy(), rows[c.frame].to_numpy()
    embeddings = None if c.embedding is None else _vectors(rows[c.embedding])
    refs = np.empty(len(ids), dtype=np.int64)
    confirmed = np.empty(len(ids), dtype=bool)
    edges = np.flatnonzero(np.diff(frames)) + 1
    for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(ids)]):
        if lo == hi:
            continue
        part = None if embeddings is None else embeddings[lo:hi]
        refs[lo:hi], confirmed[lo:hi] = tracker.update(int(frames[lo]), ids[lo:hi], boxes[lo:hi], part)
    return refs, confirmed


def _table(columns: dict, like: pa.Table, names: list[str], length: int) -> pa.Table:
    """The named columns; one that is not given is NULL of the type it has in ``like``."""
    kinds = {"_ref": pa.int64(), "is_confirmed": pa.bool_(), "_start": pa.string(), "_end": pa.string(),
             "_state": pa.string(), "_born": pa.int64()}
    return pa.table({
        name: columns[name] if name in columns else pa.nulls(length, kinds.get(name) or like.schema.field(name).type)
        for name in names
    })


_STATE = ["_start", "_end", "_state", "_born"]
_STATE_DDL = "_start string, _end string, _state string, _born bigint"
#: Segments that one task goes through when guesses were wrong, at first, and how this grows.
STRETCH = 16
#: So many segments of a camera are tried out, or one of ``TRIED_SHARE`` if those are more. It takes a job of its own, so
#: only tables of more than ``LONG`` frames are; in segments of less than ``SHORT`` frames runs have no time to meet.
TRIED, TRIED_SHARE, LONG, SHORT = 8, 64, 50_000, 1000
#: Frames between two looks at whether two runs of a segment have met.
_LOOK = 100


def _segment(rows: pa.Table, given: str | None, key: tuple, s: Settings, c: Columns, out: list[str]) -> pa.Table:
    """One segment's rows with local names, and one row describing its ends.

    Everything stays in Arrow columns, so a value never changes on the way.
    """
    rows = _in_order(rows, c)
    warm = rows["_warm"]
    own = rows.filter(pc.invert(warm))
    if not own.num_rows:
        return _table({}, rows, out, 0)
    tracker = s.tracker(given)
    if given is None:
        run_sorted(tracker, rows.filter(warm), c)
    start = tracker.signature()
    tracker.rename_inherited()
    refs, confirmed = run_sorted(tracker, own, c)
    held = {name: own[name] for name in own.column_names} | {"_ref": pa.array(refs), "is_confirmed": pa.array(confirmed)}
    ends = {
        c.camera: own[c.camera].slice(0, 1), "_segment": pa.array([key[1].as_py()], own.schema.field("_segment").type),
        "_start": pa.array([start]), "_end": pa.array([tracker.signature()]), "_state": pa.array([tracker.dump()]),
        "_born": pa.array([tracker.next_ref], pa.int64()),
    }
    return pa.concat_tables([_table(held, rows, out, own.num_rows), _table(ends, rows, out, 1)])


def _meets(rows: pa.Table, s: Settings, c: Columns) -> bool | None:
    """Whether a run that is warmed up and one that is not come to the same state in a segment; None without rows of its own."""
    rows = _in_order(rows, c)
    warm = rows["_warm"]
    own = rows.filter(pc.invert(warm))
    if not own.num_rows:
        return None
    warmed, cold = s.tracker(), s.tracker()
    run_sorted(warmed, rows.filter(warm), c)
    edges = np.r_[np.flatnonzero(np.diff(own[c.frame].to_numpy())) + 1, own.num_rows][_LOOK - 1 :: _LOOK].tolist()
    for low, high in zip([0, *edges], [*edges, own.num_rows]):
        if low < high:
            run_sorted(warmed, own.slice(low, high - low), c)
            run_sorted(cold, own.slice(low, high - low), c)
        if warmed.signature() == cold.signature():
            return True
    return False


def _frames(batches: Iterator[pa.RecordBatch], c: Columns) -> Iterator[pa.Table]:
    """Sorted rows in tables of whole frames of one camera."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, at: int) -> tuple:
        return batch.column(c.camera)[at].as_py(), batch.column(c.frame)[at].as_py()

    for batch in batches:
        if not batch.num_rows:
            continue
        cameras, frames = (batch.column(n).to_numpy(zero_copy_only=False) for n in (c.camera, c.frame))
        between = np.flatnonzero((cameras[1:] != cameras[:-1])) + 1
        last = np.flatnonzero((cameras[1:] != cameras[:-1]) | (frames[1:] != frames[:-1]))[-1:] + 1
        cuts = sorted({*between.tolist(), *last.tolist()})
        if held and key(held[-1], held[-1].num_rows - 1) != key(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            held.append(batch.slice(low, high - low))
            if high < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def track_objects(detections: DataFrame, settings: Settings = Settings(), columns: Columns = Columns(), *,
                  segment_frames: int = 5000, warm_up: int | None = None) -> DataFrame:
    """Detections with ``track_id`` (from 1 within each camera) and ``is_confirmed``.

    Settings of ``operators.motion`` track by motion and appearance. Rows without camera, frame or box belong to no track and keep NULLs.
    """
    c = columns
    warm_up = 20 * settings.max_age if warm_up is None else warm_up
    needed = [c.camera, c.frame, c.id, *c.box]
    usable = F.lit(True)
    for name in needed:
        usable = usable & F.col(name).isNotNull()
    rows = detections.where(usable)
    rest = detections.where(~usable).withColumns(
        {"track_id": F.lit(None).cast("bigint"), "is_confirmed": F.lit(None).cast("boolean")}
    )
    first, last = detections.agg(F.min(c.frame), F.max(c.frame)).first()
    if first is None:
        return rest
    if first // segment_frames == last // segment_frames:
        tracked = _whole(rows, settings, c)
    else:
        tracked = _tracked(rows, settings, c, segment_frames, warm_up, last - first + 1)
    return tracked.select(rest.columns).unionByName(rest)


def _with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in schema], *T.StructType.fromDDL(ddl)])


def _whole(rows: DataFrame, s: Settings, c: Columns) -> DataFrame:
    """All frames fit one segment: one run per camera."""
    schema = _with_fields(rows.schema, "track_id bigint, is_confirmed boolean")

    def run(group: pa.Table) -> pa.Table:
        group = _in_order(group, c)
        refs, confirmed = run_sorted(s.tracker(), group, c)
        return group.append_column("track_id", pa.array(refs + 1)).append_column("is_confirmed", pa.array(confirmed))

    return spread(rows, c.camera).groupBy(c.camera).applyInArrow(run, schema)


def _tracked(rows: DataFrame, s: Settings, c: Columns, length: int, warm_up: int, frames: int) -> DataFrame:
    """Segments in parallel, and in order the cameras whose guesses would never agree."""
    segments = _Segments(rows, s, c, length, warm_up)
    number = frames // length
    if frames <= LONG or length < SHORT or number <= 2 * TRIED:
        return segments.solve()
    apart = segments.apart(-(-number // max(TRIED, number // TRIED_SHARE)))
    if apart.isEmpty():
        return segments.solve()
    ordered_rows = _in_turn(rows, apart, s, c)
    others = rows.join(F.broadcast(apart.select(c.camera)), c.camera, "left_anti")
    if others.isEmpty():
        return ordered_rows
    tracked = _Segments(others, s, c, length, warm_up).solve()
    return tracked.select(ordered_rows.columns).unionByName(ordered_rows)


def _in_turn(rows: DataFrame, cameras: DataFrame, s: Settings, c: Columns) -> DataFrame:
    """Each of the cameras in one task, which reads its rows in order, a batch at a time."""
    spark = rows.sparkSession
    schema = _with_fields(rows.schema, "track_id bigint, is_confirmed boolean")
    order = [c.camera, c.frame, c.id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        camera, tracker = None, None
        for own in _frames(batches, c):
            here = own[c.camera][0].as_py()
            if tracker is None or here != camera:
                camera, tracker = here, s.tracker()
            refs, confirmed = run_sorted(tracker, own, c)
            found = own.append_column("track_id", pa.array(refs + 1)).append_column("is_confirmed", pa.array(confirmed))
            yield from found.to_batches()

    dealt = _dealt(rows.join(F.broadcast(cameras), c.camera), "_turn").drop("_turn").select(rows.columns)
    where = scratch_path(spark, "tracked")
    dealt.sortWithinPartitions(*order).mapInArrow(run, schema).write.parquet(where)
    return spark.read.schema(schema).parquet(where)


def _turns(few: DataFrame, name: str, *order) -> DataFrame:
    """Numbers for a few groups of much work, by which ``_dealt`` lays them apart."""
    line = Window.orderBy(*order)
    return few.withColumn(name, (F.row_number().over(line) - 1).cast("int"))


def _dealt(rows: DataFrame, name: str) -> DataFrame:
    """Groups dealt to tasks by their number in turn, since hashes of a few groups would often share a task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionById(parts, F.col(name) % F.lit(parts))


def _by_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Table]]:
    """The description and the rows of each segment; a description opens the rows up to the next one."""
    about, held = None, []
    for batch in batches:
        opens = np.flatnonzero(batch.column("_end").is_valid().to_numpy(zero_copy_only=False)).tolist()
        at = 0
        for o in opens:
            held.append(batch.slice(at, o - at))
            if about is not None:
                yield about, pa.Table.from_batches(held)
            about, held, at = batch.slice(o, 1).to_pylist()[0], [], o + 1
        held.append(batch.slice(at))
    if about is not None:
        yield about, pa.Table.from_batches(held)


class _Segments:
    """Runs segments in parallel, repairs wrong guesses and joins the names."""

    def __init__(self, rows: DataFrame, s: Settings, c: Columns, length: int, warm_up: int):
        self.s, self.c = s, c
        at = F.floor(F.col(c.frame) / F.lit(length)).cast("bigint")
        self.rows = rows.withColumn("_segment", at)
        # The last frames of a segment also warm up the next one.
        ahead = F.floor((F.col(c.frame) + F.lit(warm_up)) / F.lit(length)).cast("bigint")
        uses = F.when(
            ahead > at,
            F.array(
                F.struct(at.alias("s"), F.lit(False).alias("w")),
                F.struct((at + 1).alias("s"), F.lit(True).alias("w")),
            ),
        ).otherwise(F.array(F.struct(at.alias("s"), F.lit(False).alias("w"))))
        self.warm = (
            rows.withColumn("_u", F.explode(uses))
            .withColumns({"_segment": F.col("_u.s"), "_warm": F.col("_u.w")})
            .drop("_u")
        )
        self.out = _with_fields(
            self.rows.schema, f"_ref bigint, is_confirmed boolean, {_STATE_DDL}"
        )
        self.path = scratch_path(rows.sparkSession, "segments")
        self.spark = rows.sparkSession

    def apart(self, step: int) -> DataFrame:
        """Cameras whose tried segments, one of every ``step``, all end otherwise from another start; those with most rows first."""
        c, s = self.c, self.s
        keys = [c.camera, "_segment"]
        schema = _with_fields(self.warm.select(*keys).schema, "_met boolean, _size bigint")

        def run(rows: pa.Table) -> pa.Table:
            found = rows.select(keys).slice(0, 1).append_column("_met", pa.array([_meets(rows, s, c)], pa.bool_()))
            return found.append_column("_size", pa.array([rows.num_rows], pa.int64()))

        tried = self.warm.where(F.pmod(F.col("_segment"), F.lit(step)) == step - 1)
        found = spread(tried, *keys).groupBy(*keys).applyInArrow(run, schema).where(F.col("_met").isNotNull())
        sizes = found.groupBy(c.camera).agg(F.bool_or("_met").alias("_met"), F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_size"))
        alone = sizes.where(~F.col("_met") & (F.col("_n") >= TRIED // 2))
        return cut_lineage(_turns(alone, "_turn", F.col("_size").desc(), c.camera).select(c.camera, "_turn"))

    def solve(self) -> DataFrame:
        states = self._first_round()
        number, length = 0, STRETCH
        while True:
            wrong = self._wrong(states, length)
            if wrong.isEmpty():
                break
            number += 1
            states = self._again(states, wrong, number, length)
            length *= STRETCH
        return self._named(states)

    def _write(self, runs: DataFrame, number: int) -> DataFrame:
        where = f"{self.path}/round={number}"
        runs.write.parquet(where)
        return (
            self.spark.read.parquet(where)
            .where(F.col("_end").isNotNull())
            .select(self.c.camera, "_segment", *_STATE)
            .withColumn("round", F.lit(number))
        )

    def _first_round(self) -> DataFrame:
        c, s, names = self.c, self.s, self.out.names

        def run(key: tuple, rows: pa.Table) -> pa.Table:
            return _segment(rows, None, key, s, c, names)

        keys = [c.camera, "_segment"]
        runs = spread(self.warm, *keys).groupBy(*keys).applyInArrow(run, self.out)
        found = self._write(runs, 0)
        line = Window.partitionBy(c.camera).orderBy("_segment")
        before = self.spark.read.parquet(f"{self.path}/round=0").where(
            F.col("_end").isNotNull()
        ).select(
            c.camera, "_segment", F.lag("_segment").over(line).alias("_before"),
            (F.row_number().over(line) - 1).cast("bigint").alias("_number"),
        )
        return cut_lineage(found.join(before, [c.camera, "_segment"]))

    def _wrong(self, states: DataFrame, length: int) -> DataFrame:
        """The first segment of each stretch whose start differs from the end of the segment before, with that end."""
        c = self.c
        ends = states.select(
            c.camera, F.col("_segment").alias("_before"), F.col("_end").alias("_real"),
            F.col("_state").alias("_given"),
        )
        wrong = (
            states.where(F.col("_before").isNotNull())
            .join(ends, [c.camera, "_before"])
            .where(F.col("_start") != F.col("_real"))
        )
        stretch = F.floor(F.col("_number") / F.lit(length)).cast("bigint")
        firsts = cut_lineage(
            wrong.groupBy(c.camera, stretch.alias("_stretch"))
            .agg(F.min_by(F.struct("_segment", "_real", "_given"), "_segment").alias("_w"))
            .select(c.camera, "_stretch", F.col("_w._segment").alias("_from"), "_w._real", "_w._given")
        )
        keys = [c.camera, "_stretch"]
        return firsts.join(_turns(firsts.select(*keys), "_turn", *keys), keys)

    def _again(self, states: DataFrame, wrong: DataFrame, number: int, length: int) -> DataFrame:
        """Goes through the stretches from their first wrong segment on, a batch of rows at a time."""
        c, s, names = self.c, self.s, self.out.names
        keys, within = [c.camera, "_segment"], [c.camera, "_stretch"]
        placed = states.withColumn("_stretch", F.floor(F.col("_number") / F.lit(length)).cast("bigint"))
        states_of = placed.join(wrong, within).where(F.col("_segment") >= F.col("_from"))
        first = F.col("_segment") == F.col("_from")
        known = states_of.select(
            *within, "_turn", "_segment", "_start", "_end", "_state", "_born",
            *[F.when(first, F.col(n)).alias(n) for n in ("_real", "_given")],
        )
        rows = self.spark.read.schema(self.out).parquet(f"{self.path}/round=0").where(F.col("_end").isNull())
        rows = rows.select(*self.rows.columns).join(F.broadcast(states_of.select(*keys, "_stretch", "_turn")), keys)
        # A segment's description comes before its rows.
        order = [*within, "_segment", F.col("_end").isNull(), c.frame, c.id]
        dealt = _dealt(known.unionByName(rows, allowMissingColumns=True), "_turn").sortWithinPartitions(*order)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            real, given, stretch = None, None, None
            for about, own in _by_segment(batches):
                here = (about[c.camera], about["_stretch"])
                if here != stretch:
                    stretch, real, given = here, about["_real"], about["_given"]
                if about["_start"] == real:
                    real, given = about["_end"], about["_state"]
                    continue
                found = _segment(
                    own.append_column("_warm", pa.array(np.zeros(own.num_rows, dtype=bool))), given,
                    (None, pa.scalar(about["_segment"])), s, c, names,
                )
                real, given = (found[n][found.num_rows - 1].as_py() for n in ("_end", "_state"))
                yield from found.to_batches()

        runs = dealt.mapInArrow(run, self.out)
        repaired = self._write(runs, number).join(states.select(*keys, "_before", "_number"), keys)
        kept = states.join(repaired.select(*keys), keys, "left_anti")
        return cut_lineage(kept.unionByName(repaired))

    def _named(self, states: DataFrame) -> DataFrame:
        c = self.c
        offsets = ordered.running_sums(
            states.select(c.camera, "_segment", "_born"), [c.camera], ["_segment"], {"_upto": F.col("_born")}
        ).select(c.camera, F.col("_segment").alias("_root"), (F.col("_upto") - F.col("_born")).alias("_offset"))
        inherited = (
            self._roots(states)
            .join(offsets, [c.camera, "_root"])
            .select(
                c.camera, "_segment", F.col("_ref"), (F.col("_offset") + F.col("_root_ref") + 1).alias("_known")
            )
        )
        valid = states.select(c.camera, "_segment", "round").join(
            offsets.withColumnRenamed("_root", "_segment"), [c.camera, "_segment"]
        )
        rows = self.spark.read.schema(_with_fields(self.out, "round int")).parquet(self.path).where(
            F.col("_end").isNull()
        )
        return (
            rows.join(valid, [c.camera, "_segment", "round"])
            .join(inherited, [c.camera, "_segment", "_ref"], "left")
            .withColumn("track_id", F.coalesce("_known", F.col("_offset") + F.col("_ref") + 1))
        )

    def _roots(self, states: DataFrame) -> DataFrame:
        """For each inherited track the segment and name under which it was born.

        A track that lives through many segments is a chain of links; following
        two links at a time halves what is left in every round.
        """
        c = self.c
        alive = F.from_json("_state", "tracks array<array<string>>")["tracks"]
        ends = states.select(
            c.camera, F.col("_segment").alias("_before"), F.posexplode(alive).alias("_at", "_t")
        ).select(
            c.camera, "_before", (F.lit(-1) - F.col("_at")).cast("bigint").alias("_ref"),
            F.col("_t")[0].cast("bigint").alias("_root_ref"),
        )
        links = states.where(F.col("_before").isNotNull()).select(c.camera, "_segment", "_before").join(
            ends, [c.camera, "_before"]
        ).select(c.camera, "_segment", "_ref", F.col("_before").alias("_root"), "_root_ref")
        links = cut_lineage(links)
        while not links.where(F.col("_root_ref") < 0).isEmpty():
            further = links.select(
                c.camera, F.col("_segment").alias("_root"), F.col("_ref").alias("_root_ref"),
                F.col("_root").alias("_next"), F.col("_root_ref").alias("_next_ref"),
            )
            links = cut_lineage(
                links.join(further, [c.camera, "_root", "_root_ref"], "left").select(
                    c.camera, "_segment", "_ref",
                    F.coalesce("_next", "_root").alias("_root"),
                    F.coalesce("_next_ref", "_root_ref").alias("_root_ref"),
                )
            )
        return links


def confirmed_only(tracked: DataFrame) -> DataFrame:
    return tracked.where("is_confirmed")


def track_summary(tracked: DataFrame, *, camera: str = "camera_id", frame: str = "frame_id",
                  class_name: str = "class_name", ts: str | None = None) -> DataFrame:
    """First and last frame, length and last seen class of each track; of several in its last frame the last by name."""
    times = [F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")] if ts else []
    rows = tracked.where(F.col("track_id").isNotNull())
    totals = rows.groupBy(camera, "track_id").agg(
        F.min(frame).alias("first_frame"),
        F.max(frame).alias("last_frame"),
        F.count(F.lit(1)).alias("observations"),
        F.bool_or("is_confirmed").alias("confirmed"),
        *times,
    )
    # Names are text, which no hash aggregate carries: only the last frames' rows go through one that does.
    last = rows.select(camera, "track_id", F.col(frame).alias("last_frame"), class_name).join(
        totals.select(camera, "track_id", "last_frame"), [camera, "track_id", "last_frame"], "left_semi"
    ).groupBy(camera, "track_id").agg(F.max(class_name).alias("class_name"))
    return totals.join(last, [camera, "track_id"])


def as_tracks_table(tracked: DataFrame, c: Columns = Columns(), ts: str = "ts") -> DataFrame:
    """Confirmed rows in the layout of the tracks table (``schemas.TRACKS``)."""
    x, y, w, h = (F.col(n).cast("float") for n in c.box)
    right, bottom = (x + w, y + h) if c.sized else (w, h)
    embedding = F.col(c.embedding) if c.embedding else F.lit(None)
    return confirmed_only(tracked).select(
        F.col(c.id).cast("bigint").alias("id"),
        F.col(c.camera).alias("camera_id"),
        F.col(c.frame).alias("frame_id"),
        "track_id",
        "class_id",
        "class_name",
        F.col("confidence").cast("float").alias("confidence"),
        x.alias("x1"),
        y.alias("y1"),
        right.alias("x2"),
        bottom.alias("y2"),
        embedding.cast("array<float>").alias("embedding"),
        F.col(ts).cast("timestamp").alias("timestamp"),
        F.current_timestamp().alias("created_at"),
    )
