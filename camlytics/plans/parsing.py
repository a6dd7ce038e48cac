"""Queries on messages: parsing, reshaping, projections, geometry, detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics import schemas
from camlytics.fixtures import table
from camlytics.functions import boxes, text
from camlytics.operators import detect, messages, parse, reshape, stats, windows
from camlytics.plans import views
from camlytics.plans.views import DET, sql
from camlytics.session import scratch_path
from camlytics.sources import files

ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
NOW = "2024-02-01T00:00:00.000000"


# Frame messages ------------------------------------------------------------

def _frame_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Kafka-shaped frame messages; the image of a frame is its list of event ids."""
    ids = reshape.regroup_to_frames(
        views.det(spark, sf), order=["event_id"], record=F.col("event_id").cast("string"), ts=F.min("ts")
    )
    frames = ids.select(
        "camera_id",
        "frame_id",
        text.iso_text("ts").alias("timestamp"),
        F.array(F.lit(1080), F.lit(1920), F.lit(3)).alias("frame_shape"),
        F.concat_ws(",", "detections").cast("binary").alias("image"),
    )
    return messages.frame_messages(frames).withColumn("value", F.col("value").cast("binary"))


FRAME_TEXT = f"""
frame_text as (
  select camera_id, frame_id, strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') as timestamp,
    string_agg(cast(event_id as varchar), ',' order by event_id) as ids
  from det group by camera_id, frame_id
)"""


def parse_frame_envelope(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse.parse_frames(_frame_messages(spark, sf))
    return parsed.select(
        "camera_id", "topic_camera_id", "payload_camera_id", "camera_mismatch", "frame_id", "timestamp",
        F.col("frame_shape")[0].alias("height"), F.col("frame_shape")[1].alias("width"),
        F.col("frame_shape")[2].alias("channels"), "encoding", "malformed", "topic", "frame_data",
    )


def frame_publish(spark: SparkSession, sf: str) -> DataFrame:
    return _frame_messages(spark, sf).select("topic", "key", F.md5("value").alias("value_md5"))


def frame_log(spark: SparkSession, sf: str) -> DataFrame:
    return parse.frame_log(_frame_messages(spark, sf))


# Detection answers ---------------------------------------------------------

def _answers(frames: DataFrame) -> DataFrame:
    """Detection messages written as JSON and read back."""
    written = frames.select(messages.detection_answer(frames).alias("detection_results"))
    return reshape.flatten_answers(parse.parse_answers(written))


def parse_detection_answer(spark: SparkSession, sf: str) -> DataFrame:
    return _answers(views.frm(spark, sf)).select(
        "camera_id", "frame_id", "timestamp", "detection_timestamp", "total_detections",
        F.array_join("detection_classes", ",").alias("classes"), "class_counts",
        parse.class_count_map()["person"].alias("persons"),
        "confidence_threshold", "nms_threshold", "processing_engine",
        F.size("detections").alias("parsed_detections"),
    )


FLAT = ("class_id", "class_name", "confidence", "bbox_x", "bbox_y", "bbox_width", "bbox_height",
        "bbox_center_x", "bbox_center_y")
FLAT_SQL = """class_id, class_name, confidence, x as bbox_x, y as bbox_y, w as bbox_width, h as bbox_height,
  cast(x + floor(w / 2.0) as int) as bbox_center_x, cast(y + floor(h / 2.0) as int) as bbox_center_y"""


def explode_detections(spark: SparkSession, sf: str) -> DataFrame:
    rows = reshape.flattened_rows(_answers(views.frm(spark, sf)))
    return rows.select(
        "camera_id", "frame_id", "timestamp", "total_detections_in_frame", "confidence_threshold",
        "processing_engine", *FLAT, "year", "month", "day", "hour",
    )


def explode_detections_keep_empty(spark: SparkSession, sf: str) -> DataFrame:
    frames = views.visible(spark, sf, 0.9).select("camera_id", "frame_id", "detections")
    return reshape.explode_detections(frames, keep_empty=True)


def regroup_frames(spark: SparkSession, sf: str) -> DataFrame:
    return views.frm(spark, sf).select(
        "camera_id", "frame_id", "ts",
        F.array_join(F.transform("detections", lambda d: d["bbox"]["x"].cast("string")), ",").alias("xs"),
    )


def json_props_parse(spark: SparkSession, sf: str) -> DataFrame:
    props = F.from_json("props", "k int")
    return table(spark, sf, "events").select("event_id", props["k"].alias("k"))


def _document(frames: DataFrame) -> DataFrame:
    return frames.select(
        F.struct("camera_id", "frame_id", "timestamp", F.size("detections").alias("total_detections")).alias("metadata"),
        F.struct(F.lit(views.THRESHOLD).alias("confidence_threshold"), F.struct(F.lit("base64_jpeg").alias("encoding")).alias("image")).alias("settings"),
        "detections",
    )


def normalize_nested(spark: SparkSession, sf: str) -> DataFrame:
    flat = reshape.normalize_nested(_document(views.frm(spark, sf)), "_")
    return flat.withColumn("detections", F.size("detections"))


DOCUMENT = (
    "metadata struct<camera_id int, frame_id int, timestamp string, total_detections int>, "
    "settings struct<confidence_threshold double, image struct<encoding string>>, "
    f"detections array<{schemas.DETECTION}>"
)


def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Frames written as multi-line JSON files, each an array of at most 4096 records."""
    documents = _document(views.frm(spark, sf)).select(
        F.to_json(F.struct("*")).alias("d"),
        "metadata.camera_id",
        F.floor(F.col("metadata.frame_id") / 4096).alias("part"),
    )
    grouped = documents.groupBy("camera_id", "part").agg(
        F.concat(F.lit("[\n"), F.concat_ws(",\n", F.collect_list("d")), F.lit("\n]")).alias("value")
    )
    path = scratch_path(spark, "documents")
    grouped.write.partitionBy("camera_id", "part").text(path)
    flat = reshape.normalize_nested(files.json_documents(spark, path, DOCUMENT, recursive=True), "_")
    return flat.withColumn("detections", F.size("detections"))


DOCUMENT_SQL = sql(DET, body=f"""
select camera_id as metadata_camera_id, frame_id as metadata_frame_id,
  strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') as metadata_timestamp,
  cast(count(*) as int) as metadata_total_detections,
  cast({views.THRESHOLD} as double) as settings_confidence_threshold,
  'base64_jpeg' as settings_image_encoding, cast(count(*) as int) as detections
from det group by camera_id, frame_id""")


# Projections ---------------------------------------------------------------

def confidence_round(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", boxes.round_confidence(F.col("value") / 777).alias("confidence")
    )


def update_events(spark: SparkSession, sf: str) -> DataFrame:
    updates = messages.detection_updates(views.visible(spark, sf), "frame_id", "timestamp")
    return updates.withColumn("classes", F.array_join("classes", ","))


def confidence_filter_strict(spark: SparkSession, sf: str) -> DataFrame:
    return boxes.confidence_filter(views.det(spark, sf)).drop("value")


def confidence_filter_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    return boxes.confidence_filter(views.det(spark, sf), inclusive=True).drop("value")


def _box_columns(df: DataFrame, box, fields=("x", "y", "width", "height", "center_x", "center_y")) -> DataFrame:
    return df.withColumn("_b", box).select("event_id", *[F.col("_b")[f].alias(f) for f in fields])


def bbox_corner_to_center(spark: SparkSession, sf: str) -> DataFrame:
    x1, y1 = F.col("value") - 50, F.col("y") / 3
    box = boxes.corner_box(x1, y1, x1 + F.col("w") / 2, y1 + F.col("h") / 4)
    return _box_columns(views.det(spark, sf), box)


def bbox_floor_center(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("x") - F.lit(100)
    return _box_columns(views.det(spark, sf), boxes.size_box(x, "y", F.col("w") - F.lit(40), "h"))


def bbox_normalized_to_pixel(spark: SparkSession, sf: str) -> DataFrame:
    box = boxes.normalized_box(
        F.col("value") / 1024, F.col("confidence"), F.col("w") / 256, F.col("h") / 256, F.lit(1920), F.lit(1080)
    )
    return _box_columns(views.det(spark, sf), box, ("x", "y", "width", "height"))


def best_class(spark: SparkSession, sf: str) -> DataFrame:
    scores = F.array(F.col("x"), F.col("y"), F.col("w"), F.col("h"))
    return views.det(spark, sf).select("event_id", boxes.best_class(scores).alias("class_id"))


def class_lookup(spark: SparkSession, sf: str) -> DataFrame:
    numbered = views.det(spark, sf).select("event_id", F.col("y").alias("class_id"))
    return boxes.with_class_name(numbered)


def message_keys(spark: SparkSession, sf: str) -> DataFrame:
    camera = (F.col("user_id") % 9).cast("int")
    rows = table(spark, sf, "events").select(
        "event_id", camera.alias("camera_id"), F.expr("cast(event_id div 56 as int)").alias("frame_id")
    )
    ok = text.camera_in_range()
    return rows.select(
        "event_id",
        text.frame_topic("camera_id").alias("frame_topic"),
        text.frame_key("camera_id", "frame_id").alias("frame_key"),
        text.detection_topic("camera_id").alias("detection_topic"),
        text.detection_key("camera_id", "frame_id").alias("detection_key"),
        text.detection_key("camera_id", "frame_id", False).alias("plain_key"),
        text.camera_from_topic(text.frame_topic("camera_id")).alias("topic_camera_id"),
        ok.alias("known_camera"),
    )


def camera_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", (F.col("user_id") % 9).cast("int").alias("camera_id"))
    good, bad = parse.valid_cameras(rows)
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


def date_partitions(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.lit("nope")).otherwise(text.iso_text("ts")).alias("t")
    )
    return text.with_date_parts(rows, "t").drop("t")


def base64_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    encoded = text.encode_base64(F.col("text").cast("binary"))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.length(encoded).cast("bigint").alias("encoded_length"),
        F.md5(text.decode_base64(encoded)).alias("decoded_md5"),
        text.decode_base64(F.concat(F.lit("!"), encoded)).isNull().alias("garbage_is_null"),
    )


def file_name_fields(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(
        F.col("url"), F.lit("/camera_"), (F.col("page_id") % 7 + 1).cast("string"), F.lit("_frame_"),
        F.col("page_id").cast("string"), F.lit(".json"),
    )
    day = F.concat(F.lit("2024-0"), (F.col("page_id") % 9 + 1).cast("string"), F.lit("-15"))
    return table(spark, sf, "pages").select(
        "page_id", text.camera_from_file(name).alias("camera_id"), text.camera_from_file("url").alias("no_camera"),
        *text.date_fields(day),
    )


def frame_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.with_summary(views.frm(spark, sf))
    return rows.select(
        "camera_id", "frame_id", "total_detections",
        F.array_join("detection_classes", ",").alias("classes"),
        F.to_json("class_counts").alias("class_counts"),
    )


def detection_publish(spark: SparkSession, sf: str) -> DataFrame:
    frames = views.frm(spark, sf)
    sent = messages.detection_messages(frames)
    return sent.select(
        "topic", "key", F.get_json_object("value", "$.metadata.class_counts").alias("class_counts"),
        F.get_json_object("value", "$.detections[0].bbox.center_x").cast("int").alias("first_center_x"),
    )


# Defaults, errors, detection ----------------------------------------------

def _raw_messages(spark: SparkSession, sf: str, image=None) -> DataFrame:
    """Messages with holes: camera, frame id, time and image missing here and there."""
    def hole(n, value):
        return F.when(F.col("event_id") % n != 0, value)

    if image is None:
        image = F.concat_ws(
            " ", F.when(F.col("event_id") % 29 == 0, "fail").otherwise("ok"),
            "event_id", "class_id", "class_name", "confidence", "x", "y", "w", "h",
        )
    encoded = text.encode_base64(image.cast("binary"))
    return views.det(spark, sf).select(
        "event_id",
        hole(11, F.col("camera_id")).alias("camera_id"),
        hole(13, F.col("frame_id")).alias("frame_id"),
        hole(17, text.iso_text("ts")).alias("timestamp"),
        F.when(F.col("event_id") % 19 == 0, F.lit(""))
        .when(F.col("event_id") % 23 == 0, F.lit("*not base64*"))
        .otherwise(encoded).alias("frame_data"),
    )


def defaults_and_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Skips frameless and undecodable messages, then fills in what is missing."""
    usable = parse.with_pixels_only(_raw_messages(spark, sf, F.col("class_name"))).where(
        text.decode_base64("frame_data").isNotNull()
    )
    return windows.with_defaults(usable.drop("frame_data"), ["event_id"], F.lit(NOW))


def stub_detector():
    """Reads the detections back from images made of text."""
    def score(batch):
        answers = []
        for image in batch["image"]:
            found = []
            for line in bytes(image).decode().split("\n"):
                status, _, class_id, name, confidence, x, y, w, h = line.split(" ")
                if status == "fail":
                    raise ValueError("detector failed")
                x, y, w, h = float(x), float(y), float(w), float(h)
                found.append({
                    "class_id": int(class_id), "class_name": name, "confidence": float(confidence),
                    "x1": x, "y1": y, "x2": x + w, "y2": y + h,
                })
            answers.append(found)
        return answers

    return score


def error_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every message has an answer: found, empty or failed."""
    answers = detect.detect(_raw_messages(spark, sf), stub_detector)
    return answers.select(
        "event_id", "total_detections", "error", "detection_timestamp", "confidence_threshold",
        F.array_join("detection_classes", ",").alias("classes"), "class_counts",
    )


def batch_outcome(spark: SparkSession, sf: str) -> DataFrame:
    answers = detect.detect(_raw_messages(spark, sf), stub_detector)
    return stats.batch_outcome(answers, keys=("camera_id",))


def detect_stub(spark: SparkSession, sf: str) -> DataFrame:
    """Frames published, read back and run through the detector."""
    line = F.concat_ws(" ", F.lit("ok"), "event_id", "class_id", "class_name", "confidence", "x", "y", "w", "h")
    grouped = reshape.regroup_to_frames(views.det(spark, sf), order=["event_id"], record=line, ts=F.min("ts"))
    frames = grouped.select(
        "camera_id", "frame_id", text.iso_text("ts").alias("timestamp"),
        F.array(F.lit(1080), F.lit(1920), F.lit(3)).alias("frame_shape"),
        F.concat_ws("\n", "detections").cast("binary").alias("image"),
    )
    arrived = parse.parse_frames(messages.frame_messages(frames))
    found = detect.detect(arrived.select("camera_id", "frame_id", "timestamp", "frame_data"), stub_detector)
    return reshape.explode_detections(
        found.select("camera_id", "frame_id", "timestamp", "total_detections", "detections")
    )


def stub_scorer():
    """Answers each request with the number of characters it got."""
    def score(batch):
        return [
            {
                "camera_id": camera, "frame_id": frame, "timestamp": ts, "processing_time_ms": float(len(data)),
                "detections_count": len(data), "tracks_count": 0, "tracks": [],
            }
            for data, camera, frame, ts in zip(
                batch["frame_data"], batch["camera_id"], batch["frame_id"], batch["timestamp"]
            )
        ]

    return score


def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    frames = views.det(spark, sf).select(
        "camera_id", F.col("event_id").cast("int").alias("frame_id"), text.iso_text("ts").alias("timestamp"),
        F.when(F.col("event_id") % 19 != 0, F.col("class_name")).alias("frame_data"),
    )
    scored = detect.score(frames, stub_scorer)
    return scored.select("camera_id", "frame_id", "processing_time_ms", "detections_count", "error").withColumn(
        "processing_time_ms", F.coalesce("processing_time_ms", F.lit(0.0))
    )


QUERIES = {
    f.__name__: f
    for f in (
        parse_frame_envelope, frame_publish, frame_log, parse_detection_answer, explode_detections,
        explode_detections_keep_empty, regroup_frames, json_props_parse, normalize_nested, json_documents,
        confidence_round, update_events, confidence_filter_strict, confidence_filter_inclusive,
        bbox_corner_to_center, bbox_floor_center, bbox_normalized_to_pixel, best_class, class_lookup,
        message_keys, camera_range, date_partitions, base64_roundtrip, file_name_fields, frame_summary,
        detection_publish, defaults_and_errors, error_rows, batch_outcome, detect_stub, score_batch,
    )
}

_CLASS_LIST = "[" + ", ".join(f"'{n}'" for n in schemas.CLASS_NAMES) + "]"
_PARTS = """
  cast(year(t) as int) as year, cast(month(t) as int) as month, cast(day(t) as int) as day, cast(hour(t) as int) as hour"""
_KEPT_COLUMNS = "event_id, ts, camera_id, frame_id, class_id, class_name, confidence, x, y, w, h"
_RAW = f"""
raw as (
  select event_id, class_name, confidence,
    case when event_id % 11 <> 0 then camera_id end as camera_id,
    case when event_id % 13 <> 0 then frame_id end as frame_id,
    case when event_id % 17 <> 0 then {ISO} end as timestamp,
    case when event_id % 19 = 0 then 'empty' when event_id % 23 = 0 then 'garbage'
      when event_id % 29 = 0 then 'fail' else 'ok' end as kind
  from det
)"""

ORACLE = {
    "parse_frame_envelope": sql(DET, FRAME_TEXT, body="""
select camera_id, camera_id as topic_camera_id, camera_id as payload_camera_id, false as camera_mismatch,
  frame_id, timestamp, cast(1080 as int) as height, cast(1920 as int) as width, cast(3 as int) as channels,
  'base64_jpeg' as encoding, false as malformed, 'camera-' || camera_id || '-frames' as topic,
  to_base64(encode(ids)) as frame_data
from frame_text"""),
    "frame_publish": sql(DET, FRAME_TEXT, body="""
select 'camera-' || camera_id || '-frames' as topic, 'cam' || camera_id || '_frame' || frame_id as key,
  md5('{"metadata":{"camId":' || camera_id || ',"frameId":' || frame_id || ',"timestamp":"' || timestamp
    || '","frame_shape":[1080,1920,3],"encoding":"base64_jpeg"},"frame_data":"' || to_base64(encode(ids)) || '"}')
    as value_md5
from frame_text"""),
    "frame_log": sql(DET, FRAME_TEXT, body="""
select 'camera-' || camera_id || '-frames' as topic, camera_id, frame_id, timestamp from frame_text"""),
    "parse_detection_answer": sql(DET, FRAME_TEXT, views.first_seen_classes("det"), body="""
select camera_id, frame_id, timestamp, timestamp as detection_timestamp,
  cast(n as int) as total_detections, classes, class_counts, persons,
  cast(0.4 as double) as confidence_threshold, cast(0.4 as double) as nms_threshold,
  'spark-yolo' as processing_engine, cast(n as int) as parsed_detections
from frame_text join classes_by_frame using (camera_id, frame_id)
  join (select camera_id, frame_id, count(*) as n,
          cast(nullif(count(*) filter (where class_name = 'person'), 0) as int) as persons
        from det group by all) using (camera_id, frame_id)"""),
    "explode_detections": sql(DET, body=f"""
select camera_id, frame_id, strftime(t, '%Y-%m-%dT%H:%M:%S.%f') as timestamp,
  cast(n as int) as total_detections_in_frame, cast(0.4 as double) as confidence_threshold,
  'spark-yolo' as processing_engine, {FLAT_SQL},{_PARTS}
from (select *, min(ts) over (partition by camera_id, frame_id) as t,
        count(*) over (partition by camera_id, frame_id) as n from det)"""),
    "explode_detections_keep_empty": sql(DET, body=f"""
select camera_id, frame_id, {FLAT_SQL} from det where confidence > 0.9
union all
select camera_id, frame_id, null, null, null, null, null, null, null, null, null
from det group by camera_id, frame_id having max(confidence) <= 0.9"""),
    "regroup_frames": sql(DET, body="""
select camera_id, frame_id, min(ts) as ts, string_agg(cast(x as varchar), ',' order by event_id) as xs
from det group by camera_id, frame_id"""),
    "json_props_parse": "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events",
    "normalize_nested": DOCUMENT_SQL,
    "json_documents": DOCUMENT_SQL,
    "confidence_round": "select event_id, round(value / 777, 4) as confidence from events",
    "update_events": sql(DET, FRAME_TEXT, views.first_seen_classes("(select * from det where confidence > 0.4)"), body="""
select camera_id, frame_id, timestamp, cast(n as int) as detection_count, coalesce(classes, '') as classes
from frame_text left join classes_by_frame using (camera_id, frame_id)
  join (select camera_id, frame_id, count(*) filter (where confidence > 0.4) as n from det group by all)
    using (camera_id, frame_id)"""),
    "confidence_filter_strict": sql(DET, body=f"select {_KEPT_COLUMNS} from det where confidence > 0.4"),
    "confidence_filter_inclusive": sql(DET, body=f"select {_KEPT_COLUMNS} from det where confidence >= 0.4"),
    "bbox_corner_to_center": sql(DET, body="""
select event_id, cast(trunc(x1) as int) as x, cast(trunc(y1) as int) as y,
  cast(trunc(x2 - x1) as int) as width, cast(trunc(y2 - y1) as int) as height,
  cast(trunc((x1 + x2) / 2) as int) as center_x, cast(trunc((y1 + y2) / 2) as int) as center_y
from (select event_id, value - 50 as x1, y / 3.0::double as y1, value - 50 + w / 2.0::double as x2,
        y / 3.0::double + h / 4.0::double as y2 from det)"""),
    "bbox_floor_center": sql(DET, body="""
select event_id, x - 100 as x, y, w - 40 as width, h as height,
  cast(x - 100 + floor((w - 40) / 2.0) as int) as center_x, cast(y + floor(h / 2.0) as int) as center_y
from det"""),
    "bbox_normalized_to_pixel": sql(DET, body="""
select event_id, cast(trunc(cx - pw / 2.0::double) as int) as x, cast(trunc(cy - ph / 2.0::double) as int) as y,
  pw as width, ph as height
from (select event_id, cast(trunc(value / 1024 * 1920) as int) as cx, cast(trunc(confidence * 1080) as int) as cy,
        cast(trunc(w / 256.0::double * 1920) as int) as pw, cast(trunc(h / 256.0::double * 1080) as int) as ph
      from det)"""),
    "best_class": sql(DET, body="""
select event_id, cast(case greatest(x, y, w, h) when x then 0 when y then 1 when w then 2 else 3 end as int) as class_id
from det"""),
    "class_lookup": sql(DET, body=f"""
select event_id, y as class_id, coalesce({_CLASS_LIST}[y + 1], 'unknown') as class_name from det"""),
    "message_keys": """
select event_id, 'camera-' || c || '-frames' as frame_topic, 'cam' || c || '_frame' || f as frame_key,
  'camera-' || c || '-detections' as detection_topic,
  'cam' || c || '_frame' || f || '_detections_spark' as detection_key,
  'cam' || c || '_frame' || f || '_detections' as plain_key, c as topic_camera_id, c between 1 and 7 as known_camera
from (select event_id, cast(user_id % 9 as int) as c, cast(floor(event_id / 56.0) as int) as f from events)""",
    "camera_range": """
select event_id, c as camera_id,
  case when c not between 1 and 7 then 'camera out of range: ' || c end as error
from (select event_id, cast(user_id % 9 as int) as c from events)""",
    "date_partitions": f"""
select event_id,{_PARTS} from (select event_id, case when event_id % 10 <> 0 then ts end as t from events)""",
    "base64_roundtrip": """
select doc_id, length(to_base64(encode(text))) as encoded_length, md5(text) as decoded_md5,
  true as garbage_is_null from documents""",
    "file_name_fields": """
select page_id, cast(page_id % 7 + 1 as int) as camera_id, cast(null as int) as no_camera,
  cast(2024 as int) as year, cast(page_id % 9 + 1 as int) as month, cast(15 as int) as day from pages""",
    "frame_summary": sql(DET, views.first_seen_classes("det"), body="""
select camera_id, frame_id, cast(n as int) as total_detections, classes, class_counts
from classes_by_frame join (select camera_id, frame_id, count(*) as n from det group by all)
  using (camera_id, frame_id)"""),
    "detection_publish": sql(DET, views.first_seen_classes("det"), body="""
select 'camera-' || camera_id || '-detections' as topic,
  'cam' || camera_id || '_frame' || frame_id || '_detections_spark' as key, class_counts,
  cast(x + floor(w / 2.0) as int) as first_center_x
from classes_by_frame join
  (select camera_id, frame_id, arg_min(x, event_id) as x, arg_min(w, event_id) as w from det group by all)
  using (camera_id, frame_id)"""),
    "defaults_and_errors": sql(DET, _RAW, body=f"""
select event_id, coalesce(cast(camera_id as varchar), 'unknown') as camera_id,
  coalesce(cast(frame_id as bigint), row_number() over (order by event_id) - 1) as frame_id,
  coalesce(timestamp, '{NOW}') as timestamp
from raw where kind not in ('empty', 'garbage')"""),
    "error_rows": sql(DET, _RAW, body="""
select event_id, cast(case when kind = 'ok' and confidence > 0.4 then 1 else 0 end as int) as total_detections,
  case kind when 'garbage' then 'Failed to decode image' when 'fail' then 'detector failed' end as error,
  case when kind = 'ok' then timestamp end as detection_timestamp,
  case when kind in ('ok', 'empty') then cast(0.4 as double) end as confidence_threshold,
  case when kind = 'ok' and confidence > 0.4 then class_name else '' end as classes,
  case when kind = 'ok' and confidence > 0.4 then '{"' || class_name || '":1}' else '{}' end as class_counts
from raw"""),
    "batch_outcome": sql(DET, _RAW, body="""
select camera_id, count(*) as total_frames, count(*) filter (where kind in ('ok', 'empty')) as successful_frames
from raw group by camera_id"""),
    "detect_stub": sql(DET, body="""
select camera_id, frame_id, strftime(t, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, cast(n as int) as total_detections,
  class_id, class_name, confidence, x as bbox_x, y as bbox_y, w as bbox_width, h as bbox_height,
  cast(trunc((x + x + w) / 2.0) as int) as bbox_center_x, cast(trunc((y + y + h) / 2.0) as int) as bbox_center_y
from (select *, min(ts) over (partition by camera_id, frame_id) as t,
        count(*) filter (where confidence > 0.4) over (partition by camera_id, frame_id) as n from det)
where confidence > 0.4"""),
    "score_batch": sql(DET, body="""
select camera_id, cast(event_id as int) as frame_id,
  case when event_id % 19 <> 0 then cast(length(class_name) as double) else 0.0::double end as processing_time_ms,
  case when event_id % 19 <> 0 then cast(length(class_name) as int) end as detections_count,
  case when event_id % 19 = 0 then 'no frame data' end as error
from det"""),
}
