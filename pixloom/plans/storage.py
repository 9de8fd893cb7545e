"""Round trips through files and archives, the scorer dispatch and structural scores."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixloom.functions import answers as A
from pixloom.functions import scorers, structures
from pixloom.plans.pipeline import PRELUDE as MEMBERS
from pixloom.plans.pipeline import members
from pixloom.plans.registry import Registry
from pixloom.plans.scoring import _DENSE, _strip_sql, _words_sql, predictions
from pixloom.session import cut, ensure_checkpoint_dir, table
from pixloom.sources import archives, files

reg = Registry()


def _scratch(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@reg.query("K1 S1 S9", MEMBERS + """
SELECT folder, shard, count(*) AS n, CAST(sum(coalesce(octet_length(data), 0)) AS BIGINT) AS bytes, md5(string_agg(fname, ',' ORDER BY pos, fname)) AS names FROM v GROUP BY folder, shard""")
def archive_roundtrip(spark, sf):
    """All valid members written to archives and read back through the archive source."""
    at = _scratch(spark, "archives")
    cut(archives.write_archives(members(spark, sf, "pos", "data"), at))
    back = archives.read_archives(spark, at)
    return back.groupBy("folder", "shard").agg(
        F.count("*").alias("n"), F.sum(F.length("data")).cast("bigint").alias("bytes"),
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "fname"))), lambda x: x["fname"]), ",")).alias("names"))


@reg.query("K4 J4", """
SELECT 'docs' AS folder, printf('%05d.tar', doc_id // 500) AS shard, count(*) AS n, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM documents WHERE text IS NOT NULL GROUP BY ALL""")
def text_shards(spark, sf):
    """Texts by key as one archive of text members a shard."""
    at = _scratch(spark, "texts")
    d = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", F.col("doc_id").cast("string").alias("key"), "text")
    keys = d.select(F.lit("docs").alias("folder"), F.format_string("%05d.tar", F.floor(F.col("doc_id") / 500)).alias("shard"), F.col("doc_id").cast("int").alias("pos"), "key")
    cut(archives.write_text_shards(d.select("key", "text"), keys, at))
    return archives.read_archives(spark, at).groupBy("folder", "shard").agg(F.count("*").alias("n"), F.sum(F.length("data")).cast("bigint").alias("bytes"))


@reg.query("K8 S6 S7", "SELECT item_index, md5(question) AS question, md5(coalesce(hint, '-')) AS hint, task FROM bench_items")
def tsv_roundtrip(spark, sf):
    """A table through quoted, tab-separated text and back, line ends and quotes kept."""
    at = _scratch(spark, "table") + ".tsv"
    files.dump(table(spark, sf, "bench_items").select("item_index", "question", "hint", "task"), at)
    back = files.load(spark, at, "item_index bigint, question string, hint string, task string")
    return back.select("item_index", F.md5("question").alias("question"), F.md5(F.coalesce("hint", F.lit("-"))).alias("hint"), "task")


@reg.query("K8 S6 K7", "SELECT doc_id, md5(coalesce(text, '-')) AS text, site_id FROM documents")
def jsonl_roundtrip(spark, sf):
    at = _scratch(spark, "table") + ".jsonl"
    files.dump(table(spark, sf, "documents").select("doc_id", "text", "site_id"), at)
    back = files.load(spark, at, "doc_id bigint, text string, site_id string")
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit("-"))).alias("text"), "site_id")


@reg.query("S11 M13", MEMBERS + "SELECT folder, shard, fname, md5(data) AS digest FROM k WHERE suffix IN ('jpg', 'jpeg', 'png') AND data IS NOT NULL")
def base64_pictures(spark, sf):
    """Pictures carried as base64 text and decoded again."""
    from pixloom.operators.corpus import IMAGE
    from pixloom.tables import sample_suffix

    m = members(spark, sf, "data").filter(sample_suffix("fname").isin(*IMAGE)).filter("data IS NOT NULL")
    return m.withColumn("b64", F.base64("data")).select("folder", "shard", "fname", F.md5(F.unbase64("b64")).alias("digest"))


@reg.query("S13 K9", "SELECT 'arguments.json' AS name, true AS ok UNION ALL SELECT 'absent.json', false")
def verified_files(spark, sf):
    """The arguments of the runs as a sidecar, checked by digest; a missing file fails the check."""
    import hashlib
    import json

    rows = {str(r["run_id"]): r["wds_shards_folder"] for r in table(spark, sf, "run_args").orderBy("run_id").collect()}  # fixed, 30 rows
    at = _scratch(spark, "sidecar")
    system, path = archives.file_system(at)
    system.create_dir(path, recursive=True)
    files.write_sidecar(rows, f"{at}/arguments.json")
    want = hashlib.md5(json.dumps(rows, sort_keys=True, indent=2, default=str).encode()).hexdigest()
    return files.verified(spark, at, spark.createDataFrame([("arguments.json", want), ("absent.json", want)], "name string, md5 string"))


@reg.query("T2", f"SELECT doc_id, coalesce(len({_words_sql('text')}), 0) AS words FROM documents")
def word_counts(spark, sf):
    """Blank-separated tokens, the fallback of the token count."""
    return table(spark, sf, "documents").select("doc_id", F.coalesce(F.size(A.words("text")), F.lit(0)).cast("bigint").alias("words"))


_P = "WITH p AS (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY pred_id ORDER BY received_at DESC) = 1)"
_COLLAPSED = f"""c AS (SELECT p.pred_id, i.task, p.prediction, p.answer, array_to_string({_words_sql("lower(p.answer)")}, ' ') AS a, array_to_string({_words_sql("lower(p.prediction)")}, ' ') AS b
  FROM p JOIN bench_items i USING (item_index) WHERE p.answer IS NOT NULL)"""


@reg.query("E3 E8 T29 J7", f"""{_P}, {_COLLAPSED}, {_DENSE},
s AS (SELECT task, CASE task WHEN 'vqa' THEN CASE WHEN prediction IS NULL OR 1 - dist / nullif(greatest(length(prediction), length(answer)), 0) < 0.5 THEN 0 ELSE 1 - dist / greatest(length(prediction), length(answer)) END
  WHEN 'open' THEN coalesce(contains(lower(prediction), lower(answer)), false)::INT WHEN 'mcq' THEN coalesce(lower({_strip_sql("prediction")}) = lower({_strip_sql("answer")}), false)::INT END AS score FROM l WHERE task <> 'yorn')
SELECT task, round(avg(score), 6) AS mean, round(min(score), 6) AS min, min((score >= 1)::INT)::DOUBLE AS "all" FROM s GROUP BY task""")
def scorer_dispatch(spark, sf):
    """Scores by the task's named scorer, aggregated by named aggregations."""
    p = predictions(spark, sf, "item_index", "prediction", "answer").filter("answer IS NOT NULL")
    t = p.join(table(spark, sf, "bench_items").select("item_index", "task"), "item_index").filter("task <> 'yorn'")
    s = scorers.score(t, "prediction", "answer", "task", tasks={"mcq": "exact", "vqa": "anls", "open": "contains"})
    return scorers.aggregate(s, ["task"], "score", "mean", "min", "all").withColumn("all", F.col("all").cast("double"))


@reg.query("M7", f"""{_P}, {_COLLAPSED}, {_DENSE},
n AS (SELECT pred_id, CASE WHEN a = b THEN 1.0::DOUBLE WHEN a = '' OR b = '' THEN 0 ELSE 1 - damerau_levenshtein(da, db) / greatest(length(a), length(b)) END AS s FROM l WHERE prediction IS NOT NULL)
SELECT pred_id, round(CASE WHEN s >= 0.9 THEN s ELSE 0 END, 6) AS similarity FROM n""")
def near_texts(spark, sf):
    """Similarity with transpositions, 0 below nine tenths."""
    p = predictions(spark, sf, "item_index", "prediction", "answer").filter("answer IS NOT NULL AND prediction IS NOT NULL")
    s = structures.udf(structures.near_text, T.DoubleType())(A.collapsed("answer"), A.collapsed("prediction"))
    return p.select("pred_id", F.round(s, 6).alias("similarity"))


_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"


@reg.query("T36", f"""{_P}, t AS (SELECT pred_id, {_strip_sql("prediction")} AS a, {_strip_sql("answer")} AS b FROM p WHERE prediction IS NOT NULL AND answer IS NOT NULL)
SELECT pred_id, a = b OR coalesce(regexp_matches(a, '{_NUMBER}') AND regexp_matches(b, '{_NUMBER}') AND abs(TRY_CAST(a AS DOUBLE) - TRY_CAST(b AS DOUBLE)) <= 1e-6, false) AS equal FROM t""")
def formula_equal(spark, sf):
    """Equal texts or formulas of equal value (these tables hold plain numbers only)."""
    from pixloom.functions import denotation

    p = predictions(spark, sf, "prediction", "answer").filter("prediction IS NOT NULL AND answer IS NOT NULL")
    return p.select("pred_id", structures.udf(denotation.math_equal, T.BooleanType())(A.strip("prediction"), A.strip("answer")).alias("equal"))


@reg.query("E6", f"""{_P} SELECT pred_id, '{{"index":' || item_index || ',"model":"' || model || '","digest":"' || md5(coalesce(prediction, '')) || '"}}' AS line FROM p""")
def submission_lines(spark, sf):
    """Results as the lines of a submission file."""
    p = predictions(spark, sf, "item_index", "model", "prediction")
    return p.select("pred_id", F.to_json(F.struct(F.col("item_index").alias("index"), "model", F.md5(F.coalesce("prediction", F.lit(""))).alias("digest"))).alias("line"))


@reg.query("E5 E4", "SELECT item_index, upper(left(question, 5)) AS result FROM bench_items")
def judged_rest(spark, sf):
    """A model stand-in run twice over what is left; every item ends with one good result."""
    from pixloom.operators.inference import run_rest

    at = _scratch(spark, "results")
    b = table(spark, sf, "bench_items").select("item_index", "question")
    run_rest(b, lambda pdf: pdf.question.str[:5].str.upper().where(pdf.item_index % 3 != 0, "failed"), "item_index", at, "failed")
    return run_rest(b, lambda pdf: pdf.question.str[:5].str.upper(), "item_index", at, "failed")


@reg.query("M14", """
WITH v AS (SELECT DISTINCT image_id, h, w, image FROM image_grids WHERE image IS NOT NULL AND h > 0 AND w > 0 AND h % 8 = 0 AND w % 8 = 0 AND len(image) = h * w)
SELECT image_id, CAST(8 AS INTEGER) AS h, CAST(16 AS INTEGER) AS w, list_sum(list_transform(range(0, 64), lambda k: image[(k // 8 * h // 8) * w + (k % 8 * w // 8) + 1]))::BIGINT * 2 AS total FROM v""")
def pictures_side_by_side(spark, sf):
    """A picture rescaled to 8 x 8 by sampling, twice side by side."""
    from pixloom.operators.neardup import beside, resample, valid_pictures

    small = resample(F.col("image"), F.col("h"), F.col("w"), 8, 8)
    p = valid_pictures(table(spark, sf, "image_grids")).select("image_id", beside(small, small, F.lit(8)).alias("x"))
    return p.select("image_id", F.lit(8).alias("h"), (F.size("x") / 8).cast("int").alias("w"), F.aggregate("x", F.lit(0), lambda a, b: a + b).cast("bigint").alias("total"))


QUERIES, ORACLES = reg.queries, reg.oracles
