"""Message and table schemas, and the two small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Camera ids.
CAMERA_IDS = (1, 2, 3, 4, 5, 6, 7)

# The 80 class names in id order (COCO).
CLASS_NAMES = (
    "person", "bicycle", "car", "motorcycle", "airplane", "bus", "train", "truck",
    "boat", "traffic light", "fire hydrant", "stop sign", "parking meter", "bench",
    "bird", "cat", "dog", "horse", "sheep", "cow", "elephant", "bear", "zebra",
    "giraffe", "backpack", "umbrella", "handbag", "tie", "suitcase", "frisbee",
    "skis", "snowboard", "sports ball", "kite", "baseball bat", "baseball glove",
    "skateboard", "surfboard", "tennis racket", "bottle", "wine glass", "cup",
    "fork", "knife", "spoon", "bowl", "banana", "apple", "sandwich", "orange",
    "broccoli", "carrot", "hot dog", "pizza", "donut", "cake", "chair", "couch",
    "potted plant", "bed", "dining table", "toilet", "tv", "laptop", "mouse",
    "remote", "keyboard", "cell phone", "microwave", "oven", "toaster", "sink",
    "refrigerator", "book", "clock", "vase", "scissors", "teddy bear", "hair drier",
    "toothbrush",
)

# Fixed value: the engine name in answers.
ENGINE = "spark-yolo"

# Classes counted as vehicles by the traffic rule.
VEHICLE_CLASSES = ("car", "truck", "bus", "motorcycle")

# The box of a detection record, all whole pixels.
BBOX = "struct<x int, y int, width int, height int, center_x int, center_y int>"

DETECTION = f"struct<class_id int, class_name string, confidence double, bbox {BBOX}>"

# Fields of the frame messages, the detection messages and the tracks table.
FRAME_METADATA = (
    "struct<camId int, frameId int, timestamp string, frame_shape array<int>, encoding string>"
)

# The envelope with and without pixels; the second never reads the image text.
FRAME_ENVELOPE = f"metadata {FRAME_METADATA}, frame_data string"
FRAME_ENVELOPE_LOG = f"metadata {FRAME_METADATA}"

ANSWER_METADATA = (
    "struct<camera_id int, frame_id int, timestamp string, detection_timestamp string, "
    "total_detections int, detection_classes array<string>, class_counts string, "
    "confidence_threshold double, nms_threshold double, processing_engine string, error string, "
    f"original_frame_metadata {FRAME_METADATA}>"
)

DETECTION_ANSWER = f"metadata {ANSWER_METADATA}, detections array<{DETECTION}>"

TRACKS = (
    "id bigint, camera_id int, frame_id int, track_id bigint, class_id int, class_name string, "
    "confidence float, x1 float, y1 float, x2 float, y2 float, embedding array<float>, "
    "timestamp timestamp, created_at timestamp"
)

# The answer of the scoring service.
SCORING_RESULT = (
    "camera_id int, frame_id int, timestamp string, processing_time_ms double, "
    "detections_count int, tracks_count int, tracks array<struct<track_id int, "
    "detection struct<x1 double, y1 double, x2 double, y2 double, confidence double, "
    "class_id int, class_name string>, embedding array<double>, is_confirmed boolean>>"
)


def struct_of(ddl: str) -> T.StructType:
    """The StructType of one of the texts above."""
    return T.StructType.fromDDL(ddl)


def camera_dimension(spark: SparkSession, cameras=CAMERA_IDS) -> DataFrame:
    """One row per known camera."""
    ids = F.array(*[F.lit(int(c)) for c in cameras])
    return spark.range(1).select(F.explode(ids).alias("camera_id"))


def class_dimension(spark: SparkSession, names=CLASS_NAMES) -> DataFrame:
    """One row per known class."""
    listed = F.array(*[F.lit(n) for n in names])
    return spark.range(1).select(F.posexplode(listed).alias("class_id", "class_name"))
