"""Pieces shared by the registered queries: table views and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics import fixtures
from camlytics.functions import boxes, text

THRESHOLD = 0.4

# DuckDB's reading of ``events`` as detections.
DET = """
det as (
  select event_id, ts,
    cast(floor(event_id / 8.0) as int) % 7 + 1 as camera_id,
    cast(floor(event_id / 56.0) as int) as frame_id,
    case event_type when 'signup' then 0 when 'purchase' then 2 when 'click' then 3
      when 'view' then 5 else 7 end as class_id,
    case event_type when 'signup' then 'person' when 'purchase' then 'car'
      when 'click' then 'motorcycle' when 'view' then 'bus' else 'truck' end as class_name,
    cast(cast(json_extract_string(props, '$.k') as int) as double) / 100 as confidence,
    cast(floor(value) as int) as x,
    cast(json_extract_string(props, '$.k') as int) as y,
    cast(20 + user_id % 50 as int) as w,
    cast(20 + user_id % 90 as int) as h,
    value
  from events
)"""

# One row per frame: first time and number of detections.
FRAMES = """
frames as (
  select camera_id, frame_id, min(ts) as ts, count(*) as total_detections
  from det group by camera_id, frame_id
)"""

# One row per frame: detections above the threshold, zero included.
SEEN = f"""
seen as (
  select camera_id, frame_id, min(ts) as ts,
    count(*) filter (where confidence > {THRESHOLD}) as total_detections
  from det group by camera_id, frame_id
)"""


# Lanes that never meet: a track is a run of one lane's detections. The walk goes over a camera's frames
# and says for each lane how often its track was hit, how long it was missed, and which of the lane's tracks it is.
LANES = """
lane_det as (
  select event_id, ts, camera_id, frame_id, class_id, class_name, confidence,
    cast(event_id % 8 * 1000 + y % 5 as int) as x, cast(event_id % 8 as int) as y, cast(100 as int) as w, cast(100 as int) as h
  from det where confidence >= 0.5 and (event_id % 8 <> 7 or (frame_id // 40) % 2 = 0)
),
steps as (
  select f.camera_id, f.n, l.lane, d.event_id
  from (select camera_id, frame_id, row_number() over (partition by camera_id order by frame_id) as n
        from (select distinct camera_id, frame_id from lane_det)) f
  cross join (select unnest(range(8)) as lane) l
  left join lane_det d on d.camera_id = f.camera_id and d.frame_id = f.frame_id and d.y = l.lane
),
walk as (
  select camera_id, lane, cast(0 as bigint) as n, 0 as hits, 0 as missed, 0 as run, cast(null as bigint) as event_id
  from (select distinct camera_id, lane from steps)
  union all
  select w.camera_id, w.lane, s.n,
    case when s.event_id is not null then least(w.hits + 1, 3)
      when w.hits = 3 and w.missed < 30 then 3 else 0 end,
    case when s.event_id is not null then 0 else w.missed + 1 end,
    case when s.event_id is not null and w.hits = 0 then w.run + 1 else w.run end,
    s.event_id
  from walk w join steps s on s.camera_id = w.camera_id and s.lane = w.lane and s.n = w.n + 1
),
born as (
  select camera_id, lane, run, row_number() over (partition by camera_id order by min(n), min(event_id)) as track_id
  from walk where event_id is not null group by camera_id, lane, run
),
tracked as (
  select d.*, b.track_id, w.hits = 3 as is_confirmed
  from walk w join born b using (camera_id, lane, run) join lane_det d on d.event_id = w.event_id
)"""


def sql(*views: str, body: str) -> str:
    return "with " + ",".join(views) + "\n" + body


def first_seen_classes(source: str, name: str = "classes_by_frame") -> str:
    """Per frame the distinct classes and their counts in first-seen order."""
    return f"""
{name} as (
  select camera_id, frame_id,
    string_agg(class_name, ',' order by first_id) as classes,
    '{{' || string_agg('"' || class_name || '":' || n, ',' order by first_id) || '}}' as class_counts,
    cast(count(*) as int) as n_classes
  from (select camera_id, frame_id, class_name, min(event_id) as first_id, count(*) as n
        from {source} group by all)
  group by camera_id, frame_id
)"""


def det(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.det(spark, sf)


def frm(spark: SparkSession, sf: str) -> DataFrame:
    """Frames with all detections, time also as ISO text."""
    return fixtures.frm(spark, sf).withColumn("timestamp", text.iso_text("ts"))


def visible(spark: SparkSession, sf: str, threshold: float = THRESHOLD) -> DataFrame:
    """Frames with the detections above the threshold."""
    return frm(spark, sf).withColumn("detections", boxes.filter_nested("detections", threshold))


def frame_counts(spark: SparkSession, sf: str) -> DataFrame:
    from camlytics.operators import stats

    return stats.frame_counts(det(spark, sf))


def seen_counts(spark: SparkSession, sf: str, threshold: float = THRESHOLD) -> DataFrame:
    """Frames with the number of detections above the threshold."""
    return det(spark, sf).groupBy("camera_id", "frame_id").agg(
        F.min("ts").alias("ts"),
        F.count_if(boxes.above("confidence", threshold)).alias("total_detections"),
    )
