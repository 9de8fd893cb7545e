"""The relation most reports read: the last export of each prediction beside its benchmark item, with a plain hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.operators.reports import latest
from pixloom.session import table

YES = ("yes", "ja", "sí", "si", "是")


def bare(col: str) -> Column:
    """Lower case without blanks, round brackets and full stops."""
    return F.lower(F.translate(col, " ().", ""))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "predictions").select("pred_id", "model", "run_no", "item_index", "prediction", "received_at")
    b = table(spark, sf, "bench_items").filter("answer IS NOT NULL").select(
        "item_index", "g_index", "task", "lang", "image_path", "answer", "category", "l2_category", "split"
    )
    return (
        latest(p, ["pred_id"], "received_at").drop("received_at").join(b, "item_index")
        .withColumn("hit", F.coalesce((bare("prediction") == bare("answer")).cast("int"), F.lit(0)))
        .withColumn("rotation", ((F.col("item_index") - F.col("g_index")) / 1_000_000).cast("int"))
        .withColumn("yes_truth", bare("answer").isin(*YES))
        .withColumn("yes_guess", F.coalesce(bare("prediction").isin(*YES), F.lit(False)))
    )


SCORED = """WITH scored AS (
  SELECT p.pred_id, p.model, p.run_no, p.item_index, p.prediction, b.g_index, b.task, b.lang, b.image_path, b.answer,
    b.category, b.l2_category, b.split,
    CAST(coalesce(lower(translate(p.prediction, ' ().', '')) = lower(translate(b.answer, ' ().', '')), false) AS INTEGER) AS hit,
    CAST((p.item_index - b.g_index) // 1000000 AS INTEGER) AS rotation,
    lower(translate(b.answer, ' ().', '')) IN ('yes', 'ja', 'sí', 'si', '是') AS yes_truth,
    coalesce(lower(translate(p.prediction, ' ().', '')) IN ('yes', 'ja', 'sí', 'si', '是'), false) AS yes_guess
  FROM (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY pred_id ORDER BY received_at DESC) = 1) p
  JOIN bench_items b ON p.item_index = b.item_index
  WHERE b.answer IS NOT NULL)"""
