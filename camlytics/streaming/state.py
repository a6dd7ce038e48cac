"""Streaming versions of the stateful operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from camlytics.operators import windows
from camlytics.operators.parse import class_or_unknown
from camlytics.operators.track import Columns, Settings, _with_fields, run_sorted
from camlytics.streaming import spilled


def rates(frames: DataFrame, width: int = 5, *, ts: str = "ts", delay: str = "10 seconds") -> DataFrame:
    """Frames and detections per second by event-time window.

    ``frames`` has camera_id, ``ts`` (TIMESTAMP) and total_detections. A window
    is emitted in append mode once ``delay`` has passed its end; rows later than
    that are not counted. Silent cameras are filled in when the result is read.
    """
    counts = windows.window_counts(frames.withWatermark(ts, delay), width, ts)
    return counts.withColumns(
        {"fps": F.col("frames") / float(width), "detection_rate": F.col("detections") / float(width)}
    )


def class_totals(detections: DataFrame) -> DataFrame:
    """Detections so far by camera and class, for complete or update mode."""
    return detections.groupBy("camera_id", class_or_unknown().alias("class_name")).agg(
        F.count(F.lit(1)).alias("detections")
    )


def frame_totals(frames: DataFrame) -> DataFrame:
    """Frames and detections so far by camera, for complete or update mode."""
    return frames.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("frames"), F.sum("total_detections").alias("detections")
    )


def track_objects(detections: DataFrame, settings: Settings = Settings(), columns: Columns = Columns()) -> DataFrame:
    """The tracker as a stream, with the ids of the batch operator.

    State is the live tracks of each camera. A batch's rows are put in frame
    order, by sorted runs on disk if there are many. A frame may go on in the next batch, as when a file ends inside it:
    its further detections join tracks that have none in it yet. Rows of
    earlier frames come too late to be tracked and are emitted without a track,
    marked ``late``. Rows without camera, frame, id or box never reach the
    state, so they are not gathered anywhere. Bound the batch with the source's
    rate option.
    """
    c = columns
    needed = [c.camera, c.frame, c.id, *c.box]
    out = _with_fields(detections.schema, "track_id bigint, is_confirmed boolean, late boolean")
    # Whole numbers that may be NULL would come back as doubles; as text they stay what they are.
    texts = [f.name for f in detections.schema if isinstance(f.dataType, T.IntegralType) and f.name not in needed]
    kinds = {f.name: f.dataType for f in detections.schema}
    passed = T.StructType([T.StructField(f.name, T.StringType() if f.name in texts else f.dataType) for f in out])
    usable = reduce(and_, [F.col(n).isNotNull() for n in needed])
    names = out.names

    def advance(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracker = settings.tracker(state.get[0] if state.exists else None)
        last = tracker.last_frame
        for rows in spilled.in_order(batches, [c.frame, c.id]):
            late = pd.Series(False, index=rows.index) if last is None else rows[c.frame] < last
            fresh = rows[~late]
            if len(fresh):
                used = [c.frame, c.id, *c.box, *([c.embedding] if c.embedding else [])]
                refs, confirmed = run_sorted(tracker, pa.Table.from_pandas(fresh[used], preserve_index=False), c)
                yield fresh.assign(track_id=refs + 1, is_confirmed=confirmed, late=False)[names]
            if late.any():
                yield rows[late].assign(track_id=None, is_confirmed=None, late=True)[names]
        state.update((tracker.dump(),))

    as_text = detections.withColumns({n: F.col(n).cast("string") for n in texts}) if texts else detections
    tracked = as_text.where(usable).groupBy(c.camera).applyInPandasWithState(
        advance, passed, "tracker string", "append", GroupStateTimeout.NoTimeout
    )
    tracked = tracked.withColumns({n: F.col(n).cast(kinds[n]) for n in texts}) if texts else tracked
    rest = detections.where(~usable).withColumns({
        "track_id": F.lit(None).cast("bigint"), "is_confirmed": F.lit(None).cast("boolean"), "late": F.lit(False),
    })
    return tracked.select(names).unionByName(rest)
