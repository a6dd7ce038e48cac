"""Queries on boxes and objects: suppression, tracking, similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics import fixtures
from camlytics.fixtures import table
from camlytics.operators import nms as suppression
from camlytics.operators import motion, reshape, similarity, stats, track
from camlytics.plans import views
from camlytics.plans.views import DET, sql
from camlytics.session import scratch_path
from camlytics.sinks import tables

TOP = 5


def nms(spark: SparkSession, sf: str) -> DataFrame:
    return suppression.suppress(views.det(spark, sf).drop("value"))


def decode_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of raw network rows to suppressed detections, in one projection per frame."""
    side = F.lit(1024.0)
    scores = F.transform(
        F.sequence(F.lit(0), F.lit(8)),
        lambda i: F.when(i == F.col("class_id"), F.col("confidence")).otherwise(F.col("confidence") / 2),
    )
    box = [(F.col("x") + F.col("w") / 2) / side, (F.col("y") + F.col("h") / 2) / side, F.col("w") / side, F.col("h") / side]
    row = F.concat(F.array(*box, F.lit(1.0)), scores)
    frames = reshape.regroup_to_frames(views.det(spark, sf), order=["event_id"], record=row)
    found = frames.select("camera_id", "frame_id", suppression.decode(F.col("detections"), F.lit(1024), F.lit(1024)).alias("detections"))
    return reshape.explode_detections(found).select(
        "camera_id", "frame_id", "class_id", "class_name", "confidence", "bbox_x", "bbox_y", "bbox_width", "bbox_height",
    )


def track_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Objects in lanes that never meet, whose tracks SQL can tell too."""
    return track.track_objects(fixtures.as_lanes(views.det(spark, sf)))


def confirmed_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return track.confirmed_only(track_objects(spark, sf))


def track_summary(spark: SparkSession, sf: str) -> DataFrame:
    return track.track_summary(track_objects(spark, sf), ts="ts")


def track_counters(spark: SparkSession, sf: str) -> DataFrame:
    return stats.service_counters(stats.frame_service_counts(track_objects(spark, sf)))


def distinct_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_tracks(track_objects(spark, sf))


def track_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Per camera: detections that have a track, frames, and whether track ids have no gap."""
    return _coverage(track_objects(spark, sf))


def _coverage(rows: DataFrame) -> DataFrame:
    return rows.groupBy("camera_id").agg(
        F.count("track_id").alias("tracked"),
        F.countDistinct("frame_id").alias("frames"),
        (F.countDistinct("track_id") == F.max("track_id")).alias("gapless"),
    )


def track_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Tracks written by date and camera, then those of one camera within five days."""
    return _lookup(spark, track_objects(spark, sf))


def _lookup(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = scratch_path(spark, "tracks")
    tables.write_tracks(track.as_tracks_table(rows), path)
    found = tables.find_tracks(spark, path, camera=3, start="2024-01-10", end="2024-01-15")
    return found.select(
        "id", F.col("camera_id").cast("int").alias("camera_id"), "frame_id", "track_id", "class_id", "class_name",
        *[F.col(n).cast("int").alias(n) for n in ("x1", "y1", "x2", "y2")],
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.col("day").cast("int").alias("day"),
    )


# The same on all detections with their own boxes, which compete for tracks; a plain loop in the tests tells the tracks.


def track_objects_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return track.track_objects(views.det(spark, sf))


def confirmed_tracks_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return track.confirmed_only(track_objects_boxes(spark, sf))


def track_summary_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return track.track_summary(track_objects_boxes(spark, sf), ts="ts")


def track_counters_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return stats.service_counters(stats.frame_service_counts(track_objects_boxes(spark, sf)))


def distinct_tracks_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_tracks(track_objects_boxes(spark, sf))


def track_coverage_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return _coverage(track_objects_boxes(spark, sf))


def track_lookup_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return _lookup(spark, track_objects_boxes(spark, sf))


# By motion and appearance; the loop in the tests tells these tracks too.


def track_motion(spark: SparkSession, sf: str) -> DataFrame:
    """All detections, tracked by where each object should be next."""
    return track.track_objects(views.det(spark, sf), motion.Motion())


def track_appearance(spark: SparkSession, sf: str) -> DataFrame:
    """All detections with the embedding of their user, tracked by motion and look."""
    looks = table(spark, sf, "events").select("event_id", "user_id").join(
        table(spark, sf, "embeddings").select(F.col("vec_id").alias("user_id"), "embedding"), "user_id"
    ).drop("user_id")
    rows = views.det(spark, sf).join(looks, "event_id", "left")
    return track.track_objects(rows, motion.Motion(), track.Columns(embedding="embedding"))


def track_segments(spark: SparkSession, sf: str) -> DataFrame:
    """``track_objects_boxes`` in short segments: guessed starts, repairs and joined names, with the same ids."""
    return track.track_objects(views.det(spark, sf), segment_frames=50, warm_up=30)


def similar_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The stored vectors closest to each label's mean vector."""
    stored = table(spark, sf, "embeddings")
    probes = similarity.centroids(stored).withColumnRenamed("label", "probe_id")
    return similarity.top_k(probes, stored, TOP)


def label_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of each vector with the mean vector of its own label."""
    stored = table(spark, sf, "embeddings")
    means = similarity.centroids(stored).withColumnRenamed("embedding", "mean")
    joined = stored.join(means, "label")
    return joined.select("vec_id", F.round(similarity.cosine(F.col("embedding"), F.col("mean")), 6).alias("similarity"))


QUERIES = {
    f.__name__: f
    for f in (
        nms, decode_outputs, track_objects, confirmed_tracks, track_summary, track_counters, distinct_tracks, track_coverage,
        track_lookup,
        track_objects_boxes, confirmed_tracks_boxes, track_summary_boxes, track_counters_boxes, distinct_tracks_boxes,
        track_coverage_boxes, track_lookup_boxes, track_motion, track_appearance, track_segments,
        similar_topk, label_similarity,
    )
}

_MEANS = """
means as (
  select label, list(m order by i) as mean
  from (select label, i, avg(cast(v as double)) as m
        from (select label, unnest(embedding) as v, unnest(range(1, len(embedding) + 1)) as i from embeddings)
        group by label, i)
  group by label
)"""

# Boxes of each frame, best first, taken one at a time.
_NMS = """
boxes as (
  select *, row_number() over (partition by camera_id, frame_id order by confidence desc, event_id) as rn
  from shaped where confidence > 0.4
),
walk as (
  select camera_id, frame_id, cast(0 as bigint) as rn,
    cast([] as struct(event_id bigint, x int, y int, w int, h int)[]) as kept
  from boxes where rn = 1
  union all
  select k.camera_id, k.frame_id, b.rn,
    case when len(list_filter(k.kept, lambda o:
        greatest(least(o.x + o.w, b.x + b.w) - greatest(o.x, b.x), 0)
          * greatest(least(o.y + o.h, b.y + b.h) - greatest(o.y, b.y), 0)
        > 0.4::double * (o.w * o.h + b.w * b.h
          - greatest(least(o.x + o.w, b.x + b.w) - greatest(o.x, b.x), 0)
            * greatest(least(o.y + o.h, b.y + b.h) - greatest(o.y, b.y), 0)))) > 0
      then k.kept
      else list_append(k.kept, {'event_id': b.event_id, 'x': b.x, 'y': b.y, 'w': b.w, 'h': b.h}) end
  from walk k join boxes b on b.camera_id = k.camera_id and b.frame_id = k.frame_id and b.rn = k.rn + 1
),
ended as (
  select kept from walk qualify row_number() over (partition by camera_id, frame_id order by rn desc) = 1
)
from shaped where event_id in (select o.event_id from (select unnest(kept) as o from ended))"""


def tracks_sql(body: str) -> str:
    return "with recursive " + DET + "," + views.LANES + "\n" + body


def nms_sql(columns: str, shaped: str = "select * from det") -> str:
    walk, end = _NMS.rsplit("from shaped where event_id in", 1)
    return f"with recursive {DET}, shaped as ({shaped}),{walk}select {columns} from shaped where event_id in{end}"


# What whole pixels make of half ones: a center and a corner are both cut towards zero.
_CUT = """select * replace (cast(trunc(trunc(x + w / 2.0) - w / 2.0) as int) as x, cast(trunc(trunc(y + h / 2.0) - h / 2.0) as int) as y)
  from det"""

ORACLE = {
    "nms": nms_sql("event_id, ts, camera_id, frame_id, class_id, class_name, confidence, x, y, w, h"),
    "decode_outputs": nms_sql(
        "camera_id, frame_id, class_id, class_name, confidence, x as bbox_x, y as bbox_y, w as bbox_width, h as bbox_height", _CUT
    ),
    "track_objects": tracks_sql("select * from tracked"),
    "confirmed_tracks": tracks_sql("select * from tracked where is_confirmed"),
    "track_summary": tracks_sql("""
select camera_id, track_id, min(frame_id) as first_frame, max(frame_id) as last_frame, count(*) as observations,
  bool_or(is_confirmed) as confirmed, arg_max(class_name, frame_id) as class_name, min(ts) as first_ts, max(ts) as last_ts
from tracked group by camera_id, track_id"""),
    "track_counters": tracks_sql("""
select count(distinct (camera_id, frame_id)) as total_frames_processed, count(*) as total_detections,
  count(*) filter (where is_confirmed) as total_tracks_created from tracked"""),
    "distinct_tracks": tracks_sql("""
select camera_id, count(distinct track_id) as tracks from tracked where is_confirmed group by camera_id"""),
    "track_coverage": tracks_sql("""
select camera_id, count(*) as tracked, count(distinct frame_id) as frames, count(distinct track_id) = max(track_id) as gapless
from tracked group by camera_id"""),
    "track_lookup": tracks_sql("""
select event_id as id, camera_id, frame_id, track_id, class_id, class_name, x as x1, y as y1, x + w as x2, y + h as y2,
  ts as timestamp, cast(day(ts) as int) as day
from tracked where is_confirmed and camera_id = 3 and ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-15'"""),
    "similar_topk": sql(_MEANS, body=f"""
select cast(label as bigint) as probe_id, vec_id, similarity, cast(rank as int) as rank
from (select *, row_number() over (partition by label order by similarity desc, vec_id) as rank
      from (select m.label, e.vec_id, round(list_cosine_similarity(m.mean, cast(e.embedding as double[])), 9) as similarity
            from means m cross join embeddings e))
where rank <= {TOP}"""),
    "label_similarity": sql(_MEANS, body="""
select vec_id, round(list_cosine_similarity(mean, cast(embedding as double[])), 6) as similarity
from embeddings join means using (label)"""),
}
