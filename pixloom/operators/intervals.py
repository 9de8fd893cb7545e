"""Interval sets of any size by key: merging in two passes, lengths, and overlap without pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _islands(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = (F.coalesce(F.col(start) > reach, F.lit(True))).cast("int")
    numbered = df.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def merge(df: DataFrame, keys: Sequence[str], start: str, end: str, width: float) -> DataFrame:
    """(keys, start, end): disjoint intervals; touching ones become one, null bounds are left out.

    Intervals are merged first by key and by the stretch of ``width`` they begin in, so that a key with a large share of all
    rows is spread over its stretches, then by key. Both passes sort and may spill; neither collects a group."""
    rows = df.select(*keys, start, end).filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    first = _islands(rows.withColumn("_at", F.floor(F.col(start) / width)), [*keys, "_at"], start, end).drop("_at")
    return _islands(first, keys, start, end)


def set_iou(df: DataFrame, keys: Sequence[str], kind: str, a: str, b: str, start: str, end: str, width: float) -> DataFrame:
    """(keys, iou) of the interval sets of two kinds: what both cover is the sum of both lengths less that of their union."""
    rows = df.filter(F.col(kind).isin(a, b)).withColumn("_set", F.explode(F.array(F.col(kind), F.lit("\0both"))))
    merged = merge(rows, [*keys, "_set"], start, end, width)
    length = F.col(end) - F.col(start)
    sums = merged.groupBy(*keys).agg(
        F.sum(F.when(F.col("_set") != "\0both", length)).alias("single"), F.sum(F.when(F.col("_set") == "\0both", length)).alias("union"))
    return sums.select(*keys, F.when(F.col("union") > 0, (F.col("single") - F.col("union")) / F.col("union")).otherwise(0.0).alias("iou"))
