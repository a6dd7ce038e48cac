"""Queries on totals, windows, running state, top rows, joins and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics.fixtures import table
from camlytics.functions import text
from camlytics.operators import alerts, joins, messages, ordered, stats, windows
from camlytics.plans import views
from camlytics.plans.views import DET, FRAMES, SEEN, sql
from camlytics.schemas import camera_dimension

AS_OF = "2024-01-31 00:00:00"
HOUR = 3600


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# Totals --------------------------------------------------------------------

def global_totals(spark: SparkSession, sf: str) -> DataFrame:
    return stats.global_totals(views.seen_counts(spark, sf), F.col("total_detections") > 0)


def avg_detections(spark: SparkSession, sf: str) -> DataFrame:
    return stats.average_detections(views.seen_counts(spark, sf))


def throughput(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.throughput(views.frame_counts(spark, sf))
    return out.withColumn("frames_per_second", F.round("frames_per_second", 9))


def detections_by_camera(spark: SparkSession, sf: str) -> DataFrame:
    return stats.detections_by_camera(views.seen_counts(spark, sf, 0.98), ordered=True)


def zero_filled_cameras(spark: SparkSession, sf: str) -> DataFrame:
    """Detections above 0.985 of every known camera, silent ones included."""
    per_camera = stats.detections_by_camera(detected_messages(spark, sf, 0.985))
    return stats.zero_filled(per_camera, range(1, 10))


def frame_updates(spark: SparkSession, sf: str) -> DataFrame:
    frames = views.frame_counts(spark, sf).withColumn("timestamp", text.iso_text("ts"))
    return messages.frame_updates(frames)


def detections_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return stats.detections_by_class(views.det(spark, sf), ordered=True)


def camera_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.camera_class_counts(views.det(spark, sf))


def camera_class_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return stats.camera_class_counts(views.det(spark, sf), pivot=["person", "car", "bus", "motorcycle", "truck"])


def frame_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.class_counts_per_frame(views.det(spark, sf))


def detected_messages(spark: SparkSession, sf: str, threshold: float = 0.9) -> DataFrame:
    """Detection messages of frames where something scored above the threshold."""
    return views.seen_counts(spark, sf, threshold).where("total_detections > 0")


def last_seen(spark: SparkSession, sf: str) -> DataFrame:
    return stats.last_seen(views.seen_counts(spark, sf, 0.9), has_message=F.col("total_detections") > 0)


def cameras_seen(spark: SparkSession, sf: str) -> DataFrame:
    return stats.cameras_seen(views.det(spark, sf))


def camera_list(spark: SparkSession, sf: str) -> DataFrame:
    return stats.camera_list(views.det(spark, sf), range(1, 10))


def camera_status(spark: SparkSession, sf: str) -> DataFrame:
    return stats.camera_status(
        views.seen_counts(spark, sf), None, _as_of(), cameras=range(1, 9),
        frame_seconds=HOUR, detection_seconds=2 * HOUR,
    )


def any_detecting(spark: SparkSession, sf: str) -> DataFrame:
    return stats.any_camera_detecting(camera_status(spark, sf))


def running_mean_latency(spark: SparkSession, sf: str) -> DataFrame:
    frames = views.det(spark, sf).groupBy("camera_id", "frame_id").agg(F.sum("value").alias("processing_time_ms"))
    out = stats.mean_processing_time(frames, keys=("camera_id",))
    return out.withColumn("avg_processing_time_ms", F.round("avg_processing_time_ms", 6))


def service_counters(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.det(spark, sf).withColumn("is_confirmed", F.col("w") > 40)
    return stats.service_counters(stats.frame_service_counts(rows))


def frame_service_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.det(spark, sf).withColumn("is_confirmed", F.col("w") > 40)
    return stats.frame_service_counts(rows)


# Windows and running state -------------------------------------------------

def tumbling_rates(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumbling_rates(views.seen_counts(spark, sf), HOUR)


def global_rate(spark: SparkSession, sf: str) -> DataFrame:
    rates = windows.global_rate(windows.tumbling_rates(views.frame_counts(spark, sf), HOUR, zero_fill=False))
    return rates.select("window_start", F.round("detection_rate", 9).alias("detection_rate"))


def rate_limited_frames(spark: SparkSession, sf: str) -> DataFrame:
    return windows.rate_limited(views.frame_counts(spark, sf), "1 day")


def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.det(spark, sf).select("event_id", "camera_id", "class_name")
    return windows.running_totals(rows, ["event_id"])


def snapshot_every_n(spark: SparkSession, sf: str) -> DataFrame:
    frames = views.seen_counts(spark, sf).select("camera_id", "frame_id", "ts", "total_detections")
    return windows.snapshots(frames, ["ts"], 10)


def frame_sequence(spark: SparkSession, sf: str) -> DataFrame:
    frames = views.frame_counts(spark, sf).select("camera_id", "frame_id", "ts")
    return windows.frame_sequence(frames, ["ts"], "sequence")


def uptime(spark: SparkSession, sf: str) -> DataFrame:
    return windows.uptime(views.det(spark, sf), keys=("camera_id",))


# Top rows ------------------------------------------------------------------

def last_n_per_camera(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.last_n(views.det(spark, sf).drop("value"), ["camera_id"], ["event_id"], 50)


def latest_per_camera(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.latest(views.det(spark, sf).drop("value"), ["camera_id"], ["ts", "event_id"])


def first_n_per_camera(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.frame_counts(spark, sf).select("camera_id", "frame_id", "ts")
    return ordered.first_n(rows, ["camera_id"], ["ts"], 100)


def message_cap(spark: SparkSession, sf: str) -> DataFrame:
    return views.det(spark, sf).drop("value").orderBy("event_id").limit(1000)


def sorted_report(spark: SparkSession, sf: str) -> DataFrame:
    return stats.camera_class_counts(views.det(spark, sf)).orderBy("camera_id", "class_name")


# Joins ---------------------------------------------------------------------

def overlay_join(spark: SparkSession, sf: str) -> DataFrame:
    answers = views.visible(spark, sf, 0.95).where(F.size("detections") > 0).select(
        "camera_id", "frame_id", "ts", F.size("detections").alias("detections"),
        F.array_join(messages.classes_in_order(), ",").alias("classes"),
    )
    return joins.overlay(
        views.frame_counts(spark, sf), answers,
        frame_columns=["frame_id", "ts"], detection_columns=["frame_id", "detections", "classes"],
        frame_order=["ts"], detection_order=["ts"],
    )


def missing_objects(spark: SparkSession, sf: str) -> DataFrame:
    return joins.missing(camera_dimension(spark, range(1, 10)), views.det(spark, sf), ["camera_id"])


def objects_complete(spark: SparkSession, sf: str) -> DataFrame:
    return joins.is_complete(camera_dimension(spark, range(1, 10)), views.det(spark, sf), ["camera_id"])


def load_missing(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.to_load(orders, lines, ["o_orderkey"])


# Alerts --------------------------------------------------------------------

def crowd_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.crowd_alerts(views.visible(spark, sf))


def crowd_alerts_strict(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.crowd_alerts(views.frm(spark, sf), strict=True)


def traffic_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.traffic_alerts(views.visible(spark, sf))


def traffic_alerts_strict(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.traffic_alerts(views.visible(spark, sf), strict=True)


def alert_feed(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_feed(views.visible(spark, sf))


def camera_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_feed(views.visible(spark, sf), camera=3)


def active_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of the day before, shown for a day, that are still up at the given time."""
    feed = alerts.alert_feed(views.visible(spark, sf), lifetime=24 * HOUR)
    return alerts.active_alerts(feed, F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))


def alert_messages(spark: SparkSession, sf: str) -> DataFrame:
    sent = alerts.alert_messages(alerts.alert_feed(views.visible(spark, sf)))
    return sent.select("topic", "key", F.get_json_object("value", "$.message").alias("message"))


QUERIES = {
    f.__name__: f
    for f in (
        global_totals, avg_detections, throughput, detections_by_camera, detections_by_class, camera_class_counts,
        camera_class_pivot, frame_class_counts, last_seen, cameras_seen, camera_list, camera_status, any_detecting,
        running_mean_latency, service_counters, frame_service_counts, tumbling_rates, global_rate,
        rate_limited_frames, running_totals, snapshot_every_n, frame_sequence, uptime, last_n_per_camera,
        latest_per_camera, first_n_per_camera, message_cap, sorted_report, overlay_join, missing_objects,
        objects_complete, load_missing, crowd_alerts, crowd_alerts_strict, traffic_alerts, traffic_alerts_strict,
        alert_feed, camera_alerts, active_alerts, alert_messages, zero_filled_cameras, frame_updates,
    )
}

_COLUMNS = "event_id, ts, camera_id, frame_id, class_id, class_name, confidence, x, y, w, h"
_SEEN_09 = """
seen09 as (
  select camera_id, frame_id, min(ts) as ts, count(*) filter (where confidence > 0.9) as n
  from det group by camera_id, frame_id
)"""
_STATUS = f"""
status as (
  select c.camera_id, coalesce(n, 0) as total_frames, cast(coalesce(d, 0) as bigint) as total_detections,
    last_ts as last_frame_time, last_ts as last_detection_time,
    case when last_ts > timestamp '{AS_OF}' - interval 1 hour then 'active' else 'inactive' end as status,
    case when last_ts > timestamp '{AS_OF}' - interval 2 hour then 'active' else 'inactive' end as detection_status
  from (select cast(unnest(range(1, 9)) as int) as camera_id) c
  left join (select camera_id, count(*) as n, sum(total_detections) as d, max(ts) as last_ts from seen group by camera_id) s
    on s.camera_id = c.camera_id
)"""
_SERVICE = """
served as (
  select camera_id, frame_id, count(*) filter (where confidence >= 0.5) as detections_count,
    count(*) filter (where confidence >= 0.5 and w > 40) as tracks_count
  from det group by camera_id, frame_id
)"""


def _alerts(strict: bool = False, source: str = "confidence > 0.4") -> str:
    vehicles = "('car', 'truck', 'bus', 'motorcycle')"
    crowd = "persons" if strict else "n"
    traffic = "vehicles" if strict else "vehicle_classes"
    return f"""
counted as (
  select camera_id, frame_id, ts, n, persons, vehicles, vehicle_classes
  from (select camera_id, frame_id, count(*) as n,
      count(*) filter (where class_name = 'person') as persons,
      count(*) filter (where class_name in {vehicles}) as vehicles,
      count(distinct class_name) filter (where class_name in {vehicles}) as vehicle_classes
    from det where {source} group by camera_id, frame_id)
  join (select camera_id, frame_id, min(ts) as ts from det group by camera_id, frame_id) using (camera_id, frame_id)
),
feed as (
  select camera_id, frame_id, ts, 'crowd' as alert, cast({crowd} as int) as count,
    'Crowd detected in Camera ' || camera_id || ': ' || {crowd} || ' people' as message,
    ts + interval 10 second as expires_at
  from counted where persons > 0 and {crowd} > 5
  union all
  select camera_id, frame_id, ts, 'traffic', cast({traffic} as int),
    'High traffic in Camera ' || camera_id || ': ' || {traffic} || ' vehicles', ts + interval 10 second
  from counted where {traffic} > 3
)"""


ORACLE = {
    "global_totals": sql(DET, SEEN, body="""
select count(*) as total_frames, cast(sum(total_detections) as bigint) as total_detections,
  count(*) filter (where total_detections > 0) as total_published from seen"""),
    "avg_detections": sql(DET, SEEN, body="""
select cast(sum(total_detections) as double) / count(*) as avg_detections from seen"""),
    "throughput": sql(DET, FRAMES, body="""
select count(*) as total_frames, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::double as elapsed_seconds,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::double), 9) as frames_per_second
from frames"""),
    "detections_by_camera": sql(DET, body="""
select camera_id, count(*) filter (where confidence > 0.98) as detections from det group by camera_id order by camera_id"""),
    "zero_filled_cameras": sql(DET, body="""
select c.camera_id, coalesce(n, 0) as detections
from (select cast(unnest(range(1, 10)) as int) as camera_id) c
left join (select camera_id, count(*) as n from det where confidence > 0.985 group by camera_id) s
  on s.camera_id = c.camera_id"""),
    "frame_updates": sql(DET, FRAMES, body="""
select camera_id, frame_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp from frames"""),
    "active_alerts": sql(DET, _alerts(), body="""
select * replace (ts + interval 1 day as expires_at) from feed
where ts <= timestamp '2024-01-15 12:00:00' and ts > timestamp '2024-01-14 12:00:00'"""),
    "detections_by_class": sql(DET, body="""
select class_name, count(*) as detections from det group by class_name order by class_name"""),
    "camera_class_counts": sql(DET, body="""
select camera_id, class_name, count(*) as detections from det group by camera_id, class_name"""),
    "camera_class_pivot": sql(DET, body="""
select camera_id, count(*) filter (where class_name = 'person') as person,
  count(*) filter (where class_name = 'car') as car, count(*) filter (where class_name = 'bus') as bus,
  count(*) filter (where class_name = 'motorcycle') as motorcycle, count(*) filter (where class_name = 'truck') as truck
from det group by camera_id"""),
    "frame_class_counts": sql(DET, body="""
select camera_id, frame_id, class_name, count(*) as n from det group by all"""),
    "last_seen": sql(DET, _SEEN_09, body="""
select camera_id, max(ts) as last_frame_time, max(ts) filter (where n > 0) as last_detection_time
from seen09 group by camera_id"""),
    "cameras_seen": sql(DET, body="select count(distinct camera_id) as active_cameras from det"),
    "camera_list": sql(DET, body="""
select c.camera_id, s.camera_id is not null as seen
from (select cast(unnest(range(1, 10)) as int) as camera_id) c
left join (select distinct camera_id from det) s on s.camera_id = c.camera_id"""),
    "camera_status": sql(DET, SEEN, _STATUS, body="select * from status"),
    "any_detecting": sql(DET, SEEN, _STATUS, body="""
select bool_or(detection_status = 'active') as detecting from status"""),
    "running_mean_latency": sql(DET, body="""
select camera_id, count(*) as frames, round(avg(ms), 6) as avg_processing_time_ms
from (select camera_id, frame_id, sum(value) as ms from det group by camera_id, frame_id) group by camera_id"""),
    "service_counters": sql(DET, _SERVICE, body="""
select count(*) as total_frames_processed, cast(sum(detections_count) as bigint) as total_detections,
  cast(sum(tracks_count) as bigint) as total_tracks_created from served"""),
    "frame_service_counts": sql(DET, _SERVICE, body="select * from served"),
    "tumbling_rates": sql(DET, SEEN, body="""
select window_start, camera_id, coalesce(n, 0) / 3600.0::double as fps, coalesce(d, 0) / 3600.0::double as detection_rate
from (select unnest(range(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)) + interval 1 hour, interval 1 hour))
        as window_start from seen)
cross join (select cast(unnest(range(1, 8)) as int) as camera_id)
left join (select date_trunc('hour', ts) as window_start, camera_id, count(*) as n, sum(total_detections)::bigint as d
           from seen group by all) using (window_start, camera_id)"""),
    "global_rate": sql(DET, FRAMES, body="""
select date_trunc('hour', ts) as window_start, round(sum(total_detections)::bigint / 3600.0::double, 9) as detection_rate
from frames group by 1"""),
    "rate_limited_frames": sql(DET, FRAMES, body="""
select camera_id, date_trunc('day', ts) as poll, arg_max(frame_id, ts) as frame_id, max(ts) as ts,
  arg_max(total_detections, ts) as total_detections from frames group by camera_id, poll"""),
    "running_totals": sql(DET, body="""
select event_id, camera_id, class_name,
  count(*) over (partition by camera_id order by event_id) as camera_total,
  count(*) over (partition by camera_id, class_name order by event_id) as class_total from det"""),
    "snapshot_every_n": sql(DET, SEEN, body="""
select * from (
  select camera_id, frame_id, ts, total_detections, count(*) over (order by ts) as messages,
    cast(sum(total_detections) over (order by ts) as bigint) as detections_so_far from seen)
where messages % 10 = 0"""),
    "frame_sequence": sql(DET, FRAMES, body="""
select camera_id, frame_id, ts, row_number() over (partition by camera_id order by ts) - 1 as sequence from frames"""),
    "uptime": sql(DET, body="""
select camera_id, us / 1e6::double as uptime_seconds,
  printf('%02d:%02d:%02d', us // 3600000000, us // 60000000 % 60, us // 1000000 % 60) as uptime
from (select camera_id, epoch_us(max(ts)) - epoch_us(min(ts)) as us from det group by camera_id)"""),
    "last_n_per_camera": sql(DET, body=f"""
select {_COLUMNS} from det qualify row_number() over (partition by camera_id order by event_id desc) <= 50"""),
    "latest_per_camera": sql(DET, body=f"""
select {_COLUMNS} from det qualify row_number() over (partition by camera_id order by ts desc, event_id desc) = 1"""),
    "first_n_per_camera": sql(DET, FRAMES, body="""
select camera_id, frame_id, ts from frames qualify row_number() over (partition by camera_id order by ts) <= 100"""),
    "message_cap": sql(DET, body=f"select {_COLUMNS} from det order by event_id limit 1000"),
    "sorted_report": sql(DET, body="""
select camera_id, class_name, count(*) as detections from det group by all order by all"""),
    "overlay_join": sql(DET, FRAMES, views.first_seen_classes("(select * from det where confidence > 0.95)"), body="""
select f.camera_id, f.frame_id, f.ts, d.frame_id as detection_frame_id, d.detections, d.classes
from (select * from frames qualify row_number() over (partition by camera_id order by ts desc) = 1) f
left join (
  select camera_id, frame_id, cast(n as int) as detections, classes from classes_by_frame
  join (select camera_id, frame_id, count(*) as n from det where confidence > 0.95 group by all) using (camera_id, frame_id)
  join frames using (camera_id, frame_id)
  qualify row_number() over (partition by camera_id order by ts desc) = 1) d on d.camera_id = f.camera_id"""),
    "missing_objects": sql(DET, body="""
select camera_id from (select cast(unnest(range(1, 10)) as int) as camera_id)
where camera_id not in (select camera_id from det)"""),
    "objects_complete": sql(DET, body="""
select count(*) filter (where s.camera_id is not null) as found, count(*) as expected,
  count(*) filter (where s.camera_id is null) = 0 as complete
from (select cast(unnest(range(1, 10)) as int) as camera_id) c
left join (select distinct camera_id from det) s on s.camera_id = c.camera_id"""),
    "load_missing": """
select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey not in (select l_orderkey from lineitem)""",
    "crowd_alerts": sql(DET, _alerts(), body="select * from feed where alert = 'crowd'"),
    "crowd_alerts_strict": sql(DET, _alerts(True, "true"), body="select * from feed where alert = 'crowd'"),
    "traffic_alerts": sql(DET, _alerts(), body="select * from feed where alert = 'traffic'"),
    "traffic_alerts_strict": sql(DET, _alerts(True), body="select * from feed where alert = 'traffic'"),
    "alert_feed": sql(DET, _alerts(), body="select * from feed"),
    "camera_alerts": sql(DET, _alerts(), body="select * from feed where camera_id = 3"),
    "alert_messages": sql(DET, _alerts(), body="""
select 'system-alerts' as topic, 'cam_' || camera_id || '_' || frame_id || '_' || alert as key, message from feed"""),
}
