"""Models and judges over the rows that have no good result yet, with results kept as they come."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixloom.operators.corpus import remaining


def run_rest(items: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], key: str, out: str, failed: str, tasks: int = 8) -> DataFrame:
    """Run ``fn`` on the items without a good result below ``out``, append (key, result), return the last result of each.

    A model that can't be called for a row gives the text ``failed``; such rows are tried again by the next run. ``fn``
    takes an Arrow batch as a frame; each run appends one table, so a run that died leaves what was committed before."""
    spark = items.sparkSession
    kind = dict(items.dtypes)[key]
    schema = f"{key} {kind}, result string, run bigint"
    try:
        had = spark.read.schema(schema).parquet(out)
        run = (had.agg(F.max("run")).first()[0] or 0) + 1
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        had, run = spark.createDataFrame([], schema), 1
    todo = remaining(items, had, key, "result", failed)

    def work(batches):
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "result": fn(pdf), "run": run})

    todo.repartition(tasks, key).mapInPandas(work, schema).write.mode("append").parquet(out)
    rows = spark.read.schema(schema).parquet(out)
    return rows.groupBy(key).agg(F.max_by("result", F.struct(F.col("result").isNotNull() & ~F.contains("result", F.lit(failed)), "run")).alias("result"))
