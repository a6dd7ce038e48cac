"""Non-maximum suppression, frame by frame, without Python.

An ordinary frame has at most a few hundred boxes and is handled as one array.
A frame with more than ``dense_limit`` boxes is not gathered in one place: round
by round its best boxes go through the array, and the boxes they cover are
found on a grid and dropped, until what is left of the frame is small. Both ways
keep exactly the boxes that the greedy rule keeps.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camlytics import schemas
from camlytics.functions.boxes import above, best_class, iou, round_confidence, size_box
from camlytics.session import cut_lineage, scratch_path

DENSE_LIMIT = 2000
# Boxes of a dense frame decided per round.
ROUND = 1000
# Below this overlap boxes of very different sizes compete and a grid would reach too many cells.
LOW_OVERLAP = 0.1


def keep_best(boxes: Column, overlap: float = 0.4) -> Column:
    """Greedy suppression on an array of structs sorted best first.

    A box goes when it overlaps a kept one by more than ``overlap``. The structs
    need x, y, w, h.
    """
    nothing = F.slice(boxes, 1, 0)
    return F.aggregate(
        boxes,
        nothing,
        lambda kept, box: F.when(
            F.exists(kept, lambda k: iou(k, box) > F.lit(float(overlap))), kept
        ).otherwise(F.concat(kept, F.array(box))),
    )


def decode(outputs: Column, width: Column, height: Column, *, threshold: float = 0.4, overlap: float = 0.4,
           inclusive: bool = False) -> Column:
    """Raw rows of a network's output to the detection records of one frame.

    ``outputs`` is an array of arrays: center, width and height as shares of
    the image, objectness, then one score per class. A row's class is its first
    highest score; rows past the threshold become whole-pixel boxes, which are
    suppressed by score, ties in the order of the rows. Works inside any
    projection, so on streams too. A NULL array gives no detections.
    """
    names = F.array(*[F.lit(n) for n in schemas.CLASS_NAMES])

    def pixels(share: Column, size: Column) -> Column:
        return (share * size).cast("int")

    def record(row: Column, at: Column) -> Column:
        scores = F.slice(row, 6, F.greatest(F.size(row) - 5, F.lit(0)))
        kind = best_class(scores)
        w, h = pixels(row[2], width), pixels(row[3], height)
        score = F.array_max(scores)
        key = F.when(score.isNull() | F.isnan(score), F.lit(float("inf"))).otherwise(-score)
        return F.struct(
            key.alias("_s"), at.alias("_t"), kind.alias("class_id"),
            F.coalesce(F.get(names, kind), F.lit("unknown")).alias("class_name"), score.alias("confidence"),
            (pixels(row[0], width) - w / 2).cast("int").alias("x"), (pixels(row[1], height) - h / 2).cast("int").alias("y"),
            w.alias("w"), h.alias("h"),
        )

    found = F.transform(F.coalesce(outputs, F.array().cast("array<array<double>>")), record)
    passed = F.filter(found, lambda r: above(r["confidence"], threshold, inclusive))
    kept = keep_best(F.array_sort(passed), overlap)
    return F.transform(kept, lambda r: F.struct(
        r["class_id"].alias("class_id"), r["class_name"].alias("class_name"),
        round_confidence(r["confidence"]).alias("confidence"), size_box(r["x"], r["y"], r["w"], r["h"]).alias("bbox"),
    ))


def suppress(detections: DataFrame, *, threshold: float = 0.4, overlap: float = 0.4,
             keys: tuple[str, ...] = ("camera_id", "frame_id"), tie: str = "event_id",
             box: tuple[str, str, str, str] = ("x", "y", "w", "h"), score: str = "confidence",
             inclusive: bool = False, dense_limit: int | None = DENSE_LIMIT) -> DataFrame:
    """Best boxes of each frame, regardless of class.

    Boxes are taken by score, NaN and NULL scores last, ties to the lower
    ``tie``, which may be of any type that can be ordered. Below an ``overlap``
    of LOW_OVERLAP kept boxes hardly touch, so a frame keeps few and needs no
    grid. Columns other than the
    keys travel inside the frame's array, so there is one shuffle on the frame
    key. ``dense_limit=None`` skips the search for dense frames, for inputs whose
    detector bounds the boxes of a frame.
    """
    passed = detections.where(above(score, threshold, inclusive))
    named = reduce(and_, [F.col(k).isNotNull() for k in keys])
    # Rows that name no frame have nothing to be compared with.
    kept = _suppress(passed.where(named), overlap, keys, tie, box, score, dense_limit)
    return kept.unionByName(passed.where(~named))


def _suppress(rows: DataFrame, overlap, keys, tie, box, score, dense_limit) -> DataFrame:
    if dense_limit is None or overlap < LOW_OVERLAP:
        return _by_array(rows, overlap, keys, tie, box, score)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    dense = sizes.where(F.col("_n") > dense_limit).select(*keys)
    if dense.isEmpty():
        return _by_array(rows, overlap, keys, tie, box, score)
    dense = cut_lineage(dense)
    ordinary = _by_array(rows.join(dense, list(keys), "left_anti"), overlap, keys, tie, box, score)
    crowded = _by_grid(
        rows.join(dense, list(keys), "left_semi"), overlap, keys, tie, box, score, dense_limit
    )
    return ordinary.unionByName(crowded)


def _worst_last(score: str) -> Column:
    """The score as a key that sorts the best first; what is no number comes last."""
    s = F.col(score).cast("double")
    return F.when(s.isNull() | F.isnan(s), F.lit(float("inf"))).otherwise(-s)


def _by_array(rows: DataFrame, overlap: float, keys, tie, box, score) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    x, y, w, h = box
    entry = F.struct(
        _worst_last(score).alias("_s"),
        F.col(tie).alias("_t"),
        F.col(x).alias("x"),
        F.col(y).alias("y"),
        F.col(w).alias("w"),
        F.col(h).alias("h"),
        F.struct(*rest).alias("_row"),
    )
    frames = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_boxes"))
    kept = frames.select(*keys, F.explode(keep_best(F.col("_boxes"), overlap)).alias("_b"))
    return kept.select(*keys, *[F.col("_b._row")[c].alias(c) for c in rest]).select(*rows.columns)


# Two boxes that overlap by more than t differ in width and in height by less
# than a factor 1/t, and their centers are less than half the sum of their
# widths (heights) apart. So with size classes that grow by 1/t only the next
# smaller and larger class matter, and of those only a few cells.

def _level(size: Column, base: float) -> Column:
    return F.floor(F.ln(size.cast("double")) / F.lit(math.log(base)) + F.lit(1e-9)).cast("int")


def _cell_size(level: Column, base: float) -> Column:
    return F.pow(F.lit(base), level + 1)


def _home(center: Column, level: Column, base: float) -> Column:
    return F.floor(center / _cell_size(level, base)).cast("bigint")


def _reach(center: Column, size: Column, level: Column, base: float) -> Column:
    """Levels and cells in one direction where overlapping boxes may live."""
    def cells(near: Column) -> Column:
        cell = _cell_size(near, base)
        # A little wider than needed, so rounding of the logarithm is harmless.
        far = (size + cell * base) / 2
        return F.transform(
            F.sequence(
                F.floor((center - far) / cell).cast("bigint"), F.floor((center + far) / cell).cast("bigint")
            ),
            lambda i: F.struct(near.alias("l"), i.alias("i")),
        )

    return F.flatten(F.transform(F.sequence(level - 1, level + 1), cells))


def _by_grid(rows: DataFrame, overlap: float, keys, tie, box, score, limit: int) -> DataFrame:
    if overlap >= 1:
        return rows
    base = 1 / overlap
    x, y, w, h = box
    # A box without area overlaps nothing.
    area = F.coalesce((F.col(w) > 0) & (F.col(h) > 0) & F.col(x).isNotNull() & F.col(y).isNotNull(), F.lit(False))
    flat, solid = rows.where(~area), rows.where(area)
    cells = [*keys, "_lx", "_ix", "_ly", "_iy"]
    rank = F.struct(_worst_last(score).alias("s"), F.col(tie).alias("t"))
    # Of equal boxes only the best can stay; this step is combined before its shuffle.
    best = solid.groupBy(*keys, *box).agg(F.min(rank).alias("_rank"))
    left = best.select(
        *keys,
        *box,
        "_rank",
        _level(F.col(w), base).alias("_lx"),
        _level(F.col(h), base).alias("_ly"),
        (F.col(x) + F.col(w) / F.lit(2)).alias("_cx"),
        (F.col(y) + F.col(h) / F.lit(2)).alias("_cy"),
    ).withColumns(
        {"_ix": _home(F.col("_cx"), F.col("_lx"), base), "_iy": _home(F.col("_cy"), F.col("_ly"), base)}
    )
    left = cut_lineage(left)
    if left.isEmpty():
        return flat
    path = scratch_path(rows.sparkSession, "kept")
    number = 0
    while True:
        sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
        last = sizes.isEmpty()
        # The best boxes depend on no box after them, so the greedy rule can
        # finish them now. Spark keeps this many per task before the shuffle.
        ranked = Window.partitionBy(*keys).orderBy("_rank")
        top = left if last else left.withColumn("_n", F.row_number().over(ranked)).where(
            F.col("_n") <= min(ROUND, limit)
        )
        named = top.select(*left.columns, (-F.col("_rank.s")).alias("_score"), F.col("_rank.t").alias(tie))
        chosen = _by_array(named, overlap, keys, tie, box, "_score")
        where = f"{path}/round={number}"
        chosen.write.parquet(where)
        if last:
            break
        kept = rows.sparkSession.read.schema(chosen.schema).parquet(where)
        remaining = left.join(top.select(*keys, "_rank"), [*keys, "_rank"], "left_anti")
        left = cut_lineage(_uncovered(remaining, kept, cells, keys, base, overlap, box))
        number += 1
    winners = rows.sparkSession.read.parquet(path).select(*keys, tie)
    return solid.join(winners, [*keys, tie], "left_semi").unionByName(flat.select(solid.columns))


def _spread(boxes: DataFrame, base: float, w: str, h: str) -> DataFrame:
    """Each box once for every cell where a box overlapping it may have its home."""
    across = F.explode(_reach(F.col("_cx"), F.col(w), F.col("_lx"), base))
    down = F.explode(_reach(F.col("_cy"), F.col(h), F.col("_ly"), base))
    spread = boxes.withColumn("_a", across).withColumn("_d", down)
    return spread.withColumns(
        {"_lx": F.col("_a.l"), "_ix": F.col("_a.i"), "_ly": F.col("_d.l"), "_iy": F.col("_d.i")}
    ).drop("_a", "_d")


def _uncovered(left: DataFrame, chosen: DataFrame, cells, keys, base, overlap, box) -> DataFrame:
    """Boxes that no box just kept covers."""
    x, y, w, h = box
    reach = _spread(chosen, base, w, h).select(
        *[F.col(c).alias(f"_{c}") for c in cells], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(box)]
    )
    mine = F.struct(*[F.col(c).alias(n) for c, n in zip(box, "xywh")])
    other = F.struct(*[F.col(f"_o{i}").alias(n) for i, n in enumerate("xywh")])
    test = iou(other, mine) > F.lit(float(overlap))
    for c in cells:
        test = test & (F.col(c) == F.col(f"_{c}"))
    return left.join(reach, test, "left_anti")
