"""Queries over the delivered corpus itself: the compaction of its files."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.operators import compaction
from pixloom.session import ensure_checkpoint_dir, table
from pixloom.sources.archives import read_archives


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """The tier-0 inputs of the compaction plan."""
    small = compaction.small_files(compaction.plan(table(spark, sf, "shard_members")))
    return small.select(F.col("folder").alias("wds_shards_folder"), F.col("file").alias("shard"))


def p1_compacted(spark: SparkSession, sf: str) -> DataFrame:
    p = compaction.plan(table(spark, sf, "shard_members"))
    return compaction.compacted_files(p).select(
        F.col("folder").alias("wds_shards_folder"), F.col("final").alias("shard"), "n_files", "n_records", "bytes"
    )


def p1_journal(spark: SparkSession, sf: str) -> DataFrame:
    return compaction.plan(table(spark, sf, "shard_members")).journal.withColumnRenamed("folder", "wds_shards_folder")


def p1_conserved(spark: SparkSession, sf: str) -> DataFrame:
    """Files, records and bytes of each folder after the planned compaction; none of them above the target."""
    c = compaction.compacted_files(compaction.plan(table(spark, sf, "shard_members")))
    return c.groupBy(F.col("folder").alias("wds_shards_folder")).agg(
        F.sum("n_files").alias("files_before"), F.sum("n_records").alias("n_records"), F.sum("bytes").alias("bytes"),
        F.bool_and((F.col("bytes") <= compaction.TierPolicy().target_bytes) | (F.col("n_files") == 1)).alias("within_target"),
    )


def p1_written(spark: SparkSession, sf: str) -> DataFrame:
    """The compaction carried out, its archives read back: (folder, records, bytes, a digest of the record names)."""
    at = os.path.join(ensure_checkpoint_dir(spark), f"compacted-{uuid.uuid4().hex}")
    compaction.compact(spark, table(spark, sf, "shard_members"), at)
    back = read_archives(spark, at).filter("shard LIKE '%.tar'")
    merged = F.contains("fname", F.lit("/"))
    name = F.concat_ws("/", F.when(merged, F.substring_index("fname", "/", 1)).otherwise(F.col("shard")), F.substring_index("fname", "/", -1))
    return back.groupBy(F.col("folder").alias("wds_shards_folder")).agg(
        F.count("*").alias("n_records"), F.sum(F.length("data")).cast("bigint").alias("bytes"),
        F.sum(F.conv(F.substring(F.md5(F.concat_ws("|", name, F.hex("data"))), 1, 8), 16, 10).cast("bigint")).alias("digest"),
    )


_VALID = """
WITH m AS (
  SELECT list_filter(string_split(wds_shards_folder, '/'), lambda x: trim(x) <> '')[-1] AS folder, *
  FROM shard_members),
v AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY folder, shard, fname ORDER BY arrived_at DESC) AS rn FROM m)
  WHERE rn = 1)
"""

QUERIES = {"p1_found": p1_found, "p1_compacted": p1_compacted, "p1_journal": p1_journal, "p1_conserved": p1_conserved, "p1_written": p1_written}

ORACLES = {
    "p1_found": _VALID
    + """SELECT folder AS wds_shards_folder, shard FROM v GROUP BY folder, shard
         HAVING sum(coalesce(octet_length(data), 0)) < 2000""",
    "p1_conserved": _VALID
    + """SELECT folder AS wds_shards_folder, count(DISTINCT shard) AS files_before, count(*) AS n_records,
           CAST(sum(coalesce(octet_length(data), 0)) AS BIGINT) AS bytes, true AS within_target FROM v GROUP BY folder""",
    "p1_written": _VALID
    + """SELECT folder AS wds_shards_folder, count(*) AS n_records, CAST(sum(coalesce(octet_length(data), 0)) AS BIGINT) AS bytes,
           CAST(sum(('0x' || left(md5(shard || '/' || fname || '|' || coalesce(hex(data), '')), 8))::BIGINT) AS BIGINT) AS digest FROM v GROUP BY folder""",
}
