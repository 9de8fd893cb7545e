"""Global order without a single-partition window: ordinals, running totals, splits, shuffles.

A frame is range-partitioned by its order, each partition numbers its own rows, and the offsets
of the partitions (one number each, so their count is bounded by the number of partitions)
are added. The order should be total; equal rows get neighbouring ordinals in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixloom.session import cut


def running_total(df: DataFrame, order: Sequence[str], value: Column | None = None, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` (default 1: the ordinal) over all rows before this one in ``order``."""
    spark = df.sparkSession
    at = "_part"
    ranged = df.withColumn("_v", F.lit(1).cast("bigint") if value is None else F.coalesce(value, F.lit(0)).cast("bigint"))
    ranged = cut(ranged.repartitionByRange(*order).withColumn(at, F.spark_partition_id()))
    sums = ranged.groupBy(at).agg(F.sum("_v").alias("s")).collect()  # one row a partition
    offset, offsets = 0, {}
    for r in sorted(sums, key=lambda r: r[at]):
        offsets[r[at]] = offset
        offset += r["s"]
    table = spark.createDataFrame(list(offsets.items()) or [(0, 0)], f"{at} int, _offset bigint")
    w = Window.partitionBy(at).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn(name, F.coalesce(F.sum("_v").over(w), F.lit(0)))
    joined = own.join(F.broadcast(table), at)
    return joined.withColumn(name, F.col(name) + F.col("_offset")).drop(at, "_v", "_offset")


def ordinal(df: DataFrame, order: Sequence[str], name: str = "ord") -> DataFrame:
    """Rows numbered from 0 in ``order``."""
    return running_total(df, order, None, name)


def even_split(n: Column, ord_: Column, parts: int) -> Column:
    """Number of the part of row ``ord_`` when ``n`` rows are split evenly, the remainder to the first parts."""
    q, r = F.floor(n / parts), n % parts
    head = r * (q + 1)
    return F.when(ord_ < head, F.floor(ord_ / (q + 1))).otherwise(r + F.floor((ord_ - head) / F.greatest(q, F.lit(1)))).cast("int")


def shuffle_key(*cols: Column | str, seed: int) -> Column:
    """A key whose order is a reproducible shuffle: the digest of the row's key and the seed."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))


def draw(key: Column, n: int) -> Column:
    """A reproducible number from 0 to ``n - 1`` from a shuffle key."""
    return (F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % n).cast("int")


def sample_clusters(sizes: DataFrame, key: Sequence[str], size: str, wanted: int, seed: int) -> DataFrame:
    """Whole clusters in shuffled order until their sizes reach ``wanted`` (the last one may overshoot)."""
    shuffled = sizes.withColumn("_k", shuffle_key(*key, seed=seed))
    total = running_total(shuffled, ["_k", *key], F.col(size), "before")
    return total.filter(F.col("before") < wanted).drop("_k")


def islands(df: DataFrame, within: Sequence[str], order: Sequence[str], key: str, name: str = "run") -> DataFrame:
    """Number of the run of equal consecutive ``key`` values, from 1, inside each group; ``within`` bounds a group."""
    w = Window.partitionBy(*within).orderBy(*order)
    new = F.coalesce(~F.col(key).eqNullSafe(F.lag(key).over(w)) | F.lag(F.lit(1)).over(w).isNull(), F.lit(True)).cast("int")
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w)).drop("_new")


def length_groups(df: DataFrame, length: str, key: str, batch: int, world: int, seed: int) -> DataFrame:
    """(megabatch, slot): rows in shuffled megabatches of ``batch x world``, each sorted by falling length."""
    mega = batch * world
    shuffled = ordinal(df.withColumn("_k", shuffle_key(key, seed=seed)), ["_k", key], "_o").drop("_k")
    grouped = shuffled.withColumn("megabatch", F.floor(F.col("_o") / mega))
    w = Window.partitionBy("megabatch").orderBy(F.desc(length), key)
    return grouped.withColumn("slot", (F.row_number().over(w) - 1).cast("int")).drop("_o")


def even_chunks(grouped: DataFrame, length: str, key: str, world: int) -> DataFrame:
    """(megabatch, key, chunk): each megabatch dealt to ``world`` chunks of equal count, the shortest first."""

    def deal(pdf):
        import pandas as pd

        pdf = pdf.sort_values("slot")
        n = len(pdf)
        if n % world:
            chunk = [i % world for i in range(n)]
        else:
            chunk, total, count = [], [0.0] * world, [0] * world
            for x in pdf[length]:
                c = min(range(world), key=lambda k: (total[k], k))
                chunk.append(c)
                total[c] += x
                count[c] += 1
                if count[c] == n // world:
                    total[c] = float("inf")
        return pd.DataFrame({"megabatch": pdf.megabatch, key: pdf[key], "chunk": chunk})

    schema = f"megabatch bigint, {key} {dict(grouped.dtypes)[key]}, chunk int"
    return grouped.select("megabatch", "slot", key, length).groupBy("megabatch").applyInPandas(deal, schema)
