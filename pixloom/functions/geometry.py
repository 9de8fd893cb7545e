"""Boxes, intervals, points and sequences, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A box is an array of x1, y1, x2, y2; an interval is a struct of s and e.


def box_iou(a: Column, b: Column, guarded: bool = True) -> Column:
    """Intersection over union; 0 for an empty union (``guarded``) or null for it."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    inter = w * h
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0) if guarded else F.lit(None).cast("double"))


def centre(box: Column) -> Column:
    return F.struct(((box[0] + box[2]) / 2).alias("x"), ((box[1] + box[3]) / 2).alias("y"))


def in_box(x: Column, y: Column, box: Column) -> Column:
    return (x >= box[0]) & (x <= box[2]) & (y >= box[1]) & (y <= box[3])


def best_iou(preds: Column, truths: Column) -> Column:
    """For each predicted box its greatest IoU with any true box; 0 when there is none."""
    return F.transform(preds, lambda p: F.coalesce(F.array_max(F.transform(truths, lambda t: box_iou(p, t))), F.lit(0.0)))


def merge_intervals(intervals: Column) -> Column:
    """Disjoint intervals in order; touching ones become one."""
    pair = "array<struct<s:double,e:double>>"
    empty = F.array().cast(pair)

    def add(acc, x):
        last = F.try_element_at(acc, F.lit(-1))
        wider = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(acc) > 0) & (x["s"] <= last["e"]), wider).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(intervals.cast(pair)), empty, add)


def total_length(intervals: Column) -> Column:
    return F.aggregate(intervals, F.lit(0.0), lambda acc, x: acc + x["e"] - x["s"])


def overlap(a: Column, b: Column) -> Column:
    """Summed overlap of every interval of ``a`` with every one of ``b``."""
    one = lambda x: F.aggregate(b, F.lit(0.0), lambda acc, y: acc + F.greatest(F.lit(0.0), F.least(x["e"], y["e"]) - F.greatest(x["s"], y["s"])))
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + one(x))


def interval_iou(a: Column, b: Column) -> Column:
    """Of two interval sets, each disjoint; 0 for an empty union."""
    inter = overlap(a, b)
    union = total_length(a) + total_length(b) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, F.lit(2.0)) + F.pow(y1 - y2, F.lit(2.0)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return 2 * 6371.0 * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def relative_score(pred: Column, truth: Column) -> Column:
    """1 less the relative difference, at least 0; equality where the truth is 0."""
    return F.when(truth == 0, (pred == 0).cast("double")).otherwise(F.greatest(F.lit(0.0), 1 - F.abs(pred - truth) / F.abs(truth)))


def prefix_ratio(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays over the longer length; 1 for two empty ones."""
    n = F.greatest(F.size(a), F.size(b))
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int"))
    first = F.array_position(same, 0)
    held = F.when(first > 0, first - 1).otherwise(F.size(same))
    return F.when(n == 0, 1.0).otherwise(held / n)


def set_scores(pred: Column, truth: Column) -> Column:
    """Precision, recall and Jaccard of two arrays as sets; empty against empty is 1, empty against other 0."""
    p, t = F.array_distinct(pred), F.array_distinct(truth)
    both = F.size(F.array_intersect(p, t))
    union = F.size(F.array_union(p, t))
    nothing = (F.size(p) == 0) & (F.size(t) == 0)

    def over(n):
        return F.when(nothing, 1.0).when(n > 0, both / n).otherwise(0.0)

    return F.struct(over(F.size(p)).alias("p"), over(F.size(t)).alias("r"), over(union).alias("jaccard"))


def tile_grid(w: Column, h: Column, size: int = 448, least: int = 1, most: int = 12) -> Column:
    """Grid (cols, rows) of closest aspect ratio; at equal difference a larger grid needs half its area in pixels."""
    grids = sorted({(i, j) for i in range(1, most + 1) for j in range(1, most + 1) if least <= i * j <= most}, key=lambda g: (g[0] * g[1], g))
    options = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(j).alias("r")) for i, j in grids])
    aspect, area = w / h, w.cast("double") * h

    def better(acc, g):
        far = F.abs(aspect - g["c"] / g["r"])
        take = (far < acc["far"]) | ((far == acc["far"]) & (area > 0.5 * size * size * g["c"] * g["r"]))
        new = F.struct(g["c"].alias("c"), g["r"].alias("r"), far.alias("far"))
        return F.when(take, new).otherwise(acc)

    start = F.struct(F.lit(1).alias("c"), F.lit(1).alias("r"), F.lit(float("inf")).alias("far"))
    return F.aggregate(options, start, better)


def tile_boxes(cols: Column, rows: Column, size: int = 448) -> Column:
    """Boxes of the tiles, row by row."""
    n = F.sequence(F.lit(0), (cols * rows - 1).cast("int"))
    return F.transform(n, lambda i: F.array((i % cols) * size, F.floor(i / cols).cast("int") * size, (i % cols + 1) * size, (F.floor(i / cols).cast("int") + 1) * size))
