"""Box geometry and class columns, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics.schemas import class_dimension


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def corner_box(x1, y1, x2, y2) -> Column:
    """Corner box to record; every value is truncated after the arithmetic."""
    x1, y1, x2, y2 = (_c(c).cast("double") for c in (x1, y1, x2, y2))
    return F.struct(
        x1.cast("int").alias("x"),
        y1.cast("int").alias("y"),
        (x2 - x1).cast("int").alias("width"),
        (y2 - y1).cast("int").alias("height"),
        ((x1 + x2) / 2).cast("int").alias("center_x"),
        ((y1 + y2) / 2).cast("int").alias("center_y"),
    )


def size_box(x, y, width, height) -> Column:
    """Corner and size to record; centers use floor division."""
    x, y, width, height = (_c(c) for c in (x, y, width, height))
    return F.struct(
        x.alias("x"),
        y.alias("y"),
        width.alias("width"),
        height.alias("height"),
        (x + F.floor(width / F.lit(2))).cast("int").alias("center_x"),
        (y + F.floor(height / F.lit(2))).cast("int").alias("center_y"),
    )


def normalized_box(cx, cy, w, h, image_width, image_height) -> Column:
    """Box in shares of the image to whole-pixel corner and size."""
    px, py = (_c(cx) * image_width).cast("int"), (_c(cy) * image_height).cast("int")
    pw, ph = (_c(w) * image_width).cast("int"), (_c(h) * image_height).cast("int")
    return F.struct(
        (px - pw / F.lit(2)).cast("int").alias("x"),
        (py - ph / F.lit(2)).cast("int").alias("y"),
        pw.alias("width"),
        ph.alias("height"),
    )


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two structs with x, y, w, h; 0 when one is incomplete."""
    ax, ay, aw, ah = (a[f].cast("double") for f in ("x", "y", "w", "h"))
    bx, by, bw, bh = (b[f].cast("double") for f in ("x", "y", "w", "h"))
    zero = F.lit(0.0)
    dx = F.greatest(F.least(ax + aw, bx + bw) - F.greatest(ax, bx), zero)
    dy = F.greatest(F.least(ay + ah, by + bh) - F.greatest(ay, by), zero)
    union = aw * ah + bw * bh - dx * dy
    # least and greatest skip NULLs, so places are checked on their own.
    placed = (ax + ay + bx + by).isNotNull()
    return F.when((union > 0) & placed, dx * dy / union).otherwise(zero)


def above(confidence, threshold: float = 0.4, inclusive: bool = False) -> Column:
    """The confidence test: strict by default, inclusive on request."""
    c = _c(confidence)
    return c >= F.lit(float(threshold)) if inclusive else c > F.lit(float(threshold))


def confidence_filter(df: DataFrame, threshold: float = 0.4, inclusive: bool = False,
                      column: str = "confidence") -> DataFrame:
    return df.where(above(column, threshold, inclusive))


def filter_nested(detections, threshold: float = 0.4, inclusive: bool = False) -> Column:
    """The same test on an array of detection records, without exploding it."""
    return F.filter(_c(detections), lambda d: above(d["confidence"], threshold, inclusive))


def round_confidence(confidence) -> Column:
    return F.round(_c(confidence), 4)


def best_class(scores) -> Column:
    """Position of the highest score, the first one on ties."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def with_class_name(df: DataFrame, class_id: str = "class_id", name: str = "class_name") -> DataFrame:
    """Class name by id; ids outside the dimension read ``unknown``.

    The dimension has a fixed 80 rows, which is what makes broadcasting it safe.
    """
    dim = class_dimension(df.sparkSession).select(
        F.col("class_id").alias("_dim_id"), F.col("class_name").alias("_dim_name")
    )
    return (
        df.join(F.broadcast(dim), F.col(class_id) == F.col("_dim_id"), "left")
        .withColumn(name, F.coalesce("_dim_name", F.lit("unknown")))
        .drop("_dim_id", "_dim_name")
    )
