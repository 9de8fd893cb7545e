"""Streams over tables that arrive as files: bounded runs that end when all files are read, results as tables.

Every runner drains its source with ``availableNow`` and keeps its checkpoint and its result in the folder
``spark.checkpoint.dir`` names (see ``ensure_checkpoint_dir``), so a run that lost executors goes on. Aggregates are
written in complete mode by ``foreachBatch`` (the last batch holds the whole, small result); row streams append.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pixloom.session import ensure_checkpoint_dir, table
from pixloom.tables import micros


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = 100) -> DataFrame:
    """A table as a stream of its files (one file or a folder of them); times without zone as times of the session."""
    schema = table(spark, sf_dir, name).schema
    path = os.path.join(sf_dir, f"{name}.parque[t]")  # a pattern, so that a single file may stand for the folder
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


def _folder(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")


def drain(df: DataFrame) -> DataFrame:
    """All rows an append stream yields, as a table."""
    spark, at = df.sparkSession, _folder(df.sparkSession)
    q = df.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{at}/out")


def drain_complete(df: DataFrame) -> DataFrame:
    """The final result of an aggregating stream, as a table."""
    spark, at = df.sparkSession, _folder(df.sparkSession)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out")

    df.writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/state").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{at}/out")


def drain_batches(df: DataFrame, fn: Callable[[DataFrame, int], DataFrame], schema: str) -> DataFrame:
    """Results of ``fn`` on every micro-batch, each batch's result replaced when the batch is run again."""
    spark, at = df.sparkSession, _folder(df.sparkSession)

    done: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        fn(batch, number).write.mode("overwrite").parquet(f"{at}/out/batch={number}")
        done.append(number)

    df.writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    if not done:  # a stream without any file
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{at}/out").drop("batch").select(*[x.split()[0] for x in schema.split(", ")])


def tumbling(events: DataFrame, ts: str, width: str, *keys: str, slide: str | None = None, late: str = "7 days") -> DataFrame:
    """Counts by time window (sliding with ``slide``) and keys; the watermark bounds the state."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.withWatermark(ts, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, ts: str, gap: str, *keys: str, late: str = "7 days") -> DataFrame:
    """Counts by session: events of a key less than ``gap`` apart."""
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n"))


def first_seen(rows: DataFrame, keys: list[str], ts: str, late: str = "30 days") -> DataFrame:
    """Keys once each within the watermark."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def spaced(events: DataFrame, key: str, ts: str, name: str, gap_seconds: float) -> DataFrame:
    """(key, name) of the events kept greedily: the first of a key, then each at least ``gap_seconds`` after the last kept.

    The state is one time for each key. Events of a micro-batch are taken in time order; an event older than the state is
    late and not kept."""
    kinds = dict(events.dtypes)

    def keep(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["us", "name"])
        out = []
        for us, name_ in zip(rows["us"], rows["name"]):
            if last is None or us - last >= gap_seconds * 1_000_000:
                last = int(us)
                out.append(name_)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({"key": [k[0]] * len(out), "name": out})

    rows = events.select(F.col(key).alias("key"), micros(ts).alias("us"), F.col(name).alias("name"))
    out = f"key {kinds[key]}, name {kinds[name]}"
    kept = rows.groupBy("key").applyInPandasWithState(keep, out, "last long", "append", GroupStateTimeout.NoTimeout)
    return kept.withColumnsRenamed({"key": key, "name": name})
