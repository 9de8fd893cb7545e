"""Shared readings of the delivered tables: bare folders, valid members, sample keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bare_folder(col: Column | str) -> Column:
    """Last non-empty path component; null for null or a path without one."""
    parts = F.filter(F.split(F.col(col) if isinstance(col, str) else col, "/"), lambda p: F.trim(p) != "")
    return F.when(F.size(parts) > 0, F.element_at(parts, -1))


def sample_key(fname: Column | str) -> Column:
    """Text before the first ``_`` or ``.`` of a member name."""
    return F.regexp_extract(F.col(fname) if isinstance(fname, str) else fname, r"^([^_.]*)", 1)


def sample_suffix(fname: Column | str) -> Column:
    """Lower-cased text after the last dot, empty when there is none."""
    return F.lower(F.regexp_extract(F.col(fname) if isinstance(fname, str) else fname, r"\.([^.]*)$", 1))


def micros(col: Column | str) -> Column:
    """Microseconds from 1970 of a time as it reads, whatever the zone of the session."""
    t = (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")
    whole = (F.unix_date(F.to_date(t)).cast("bigint") * 86_400 + F.hour(t) * 3_600 + F.minute(t) * 60) * 1_000_000
    return whole + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def valid_members(members: DataFrame, *keep: str) -> DataFrame:
    """One row per record (bare folder, shard, fname): the delivery with the latest ``arrived_at``.

    ``keep`` names further columns to carry beside ``arrived_at``. A fixed-width ``keep`` stays inside a hash
    aggregate with map-side combine; repeated deliveries never reach the shuffle twice
    from one task.
    """
    picked = members.select(
        bare_folder("wds_shards_folder").alias("folder"),
        "shard",
        "fname",
        "arrived_at",
        *[F.col(c) for c in keep],
    )
    return picked.groupBy("folder", "shard", "fname").agg(
        F.max("arrived_at").alias("arrived_at"), *[F.max_by(c, "arrived_at").alias(c) for c in keep]
    )
