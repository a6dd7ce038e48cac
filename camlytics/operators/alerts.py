"""Alert rules on detection messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics.operators import messages
from camlytics.schemas import VEHICLE_CLASSES

# Rule limits and lifetime.
CROWD_LIMIT = 5
VEHICLE_LIMIT = 3
LIFETIME_SECONDS = 10


def _persons(detections: Column) -> Column:
    return F.size(F.filter(detections, lambda d: d["class_name"] == "person"))


def _vehicles(detections: Column) -> Column:
    return F.size(F.filter(detections, lambda d: d["class_name"].isin(*VEHICLE_CLASSES)))


def candidates(frames: DataFrame, camera: int | None = None, ts: str = "ts") -> DataFrame:
    """Messages with at least one detection, of the chosen camera if any."""
    d = F.col("detections")
    out = frames.where(F.size(d) > 0)
    if camera is not None:
        out = out.where(F.col("camera_id") == camera)
    classes = messages.classes_in_order(d)
    return out.select(
        "camera_id",
        "frame_id",
        F.col(ts).alias("ts"),
        F.size(d).alias("detection_count"),
        classes.alias("classes"),
        _persons(d).alias("persons"),
        _vehicles(d).alias("vehicles"),
    )


def _rule(kind: str, test: Column, count: Column, wording: str) -> Column:
    """What a rule reports when it fires, else NULL."""
    return F.when(
        test,
        F.struct(
            F.lit(kind).alias("alert"),
            count.cast("int").alias("count"),
            F.format_string(wording, F.col("camera_id"), count).alias("message"),
        ),
    )


def _rules(strict: bool) -> dict[str, Column]:
    wanted = F.array(*[F.lit(v) for v in VEHICLE_CLASSES])
    crowd = F.col("persons") if strict else F.col("detection_count")
    traffic = F.col("vehicles") if strict else F.size(F.array_intersect("classes", wanted))
    return {
        "crowd": _rule(
            "crowd",
            F.array_contains("classes", "person") & (crowd > CROWD_LIMIT),
            crowd,
            "Crowd detected in Camera %d: %d people",
        ),
        "traffic": _rule(
            "traffic", traffic > VEHICLE_LIMIT, traffic, "High traffic in Camera %d: %d vehicles"
        ),
    }


def alert_feed(frames: DataFrame, *, strict: bool = False, camera: int | None = None,
               rules: tuple[str, ...] = ("crowd", "traffic"), lifetime: int = LIFETIME_SECONDS) -> DataFrame:
    """One row per alert raised, all rules in one pass over the frames.

    An alert is shown for ``lifetime`` seconds.
    """
    raised = F.array_compact(F.array(*[_rules(strict)[r] for r in rules]))
    rows = candidates(frames, camera).select(
        "camera_id", "frame_id", "ts", F.explode(raised).alias("a")
    )
    return rows.select(
        "camera_id",
        "frame_id",
        "ts",
        "a.alert",
        "a.count",
        "a.message",
        (F.col("ts") + F.expr(f"interval {int(lifetime)} seconds")).alias("expires_at"),
    )


def crowd_alerts(frames: DataFrame, *, strict: bool = False, camera: int | None = None) -> DataFrame:
    """A person in view and more than five detections of any class.

    ``strict`` counts persons only, which is what the wording says.
    """
    return alert_feed(frames, strict=strict, camera=camera, rules=("crowd",))


def traffic_alerts(frames: DataFrame, *, strict: bool = False, camera: int | None = None) -> DataFrame:
    """More than three distinct vehicle classes, that is all four.

    ``strict`` counts vehicles instead of classes.
    """
    return alert_feed(frames, strict=strict, camera=camera, rules=("traffic",))


def active_alerts(alerts: DataFrame, as_of: Column) -> DataFrame:
    """Alerts still shown at ``as_of``."""
    return alerts.where((F.col("ts") <= as_of) & (as_of < F.col("expires_at")))


def alert_messages(alerts: DataFrame, topic: str = "system-alerts") -> DataFrame:
    """Topic, key and value of each alert."""
    return alerts.select(
        F.lit(topic).alias("topic"),
        F.concat_ws("_", F.lit("cam"), "camera_id", "frame_id", "alert").alias("key"),
        F.to_json(F.struct("camera_id", "frame_id", "ts", "alert", "count", "message", "expires_at")).alias("value"),
    )
