"""Visually identical text with different characters (problem 3).

``canonicalize`` folds character forms, then repairs tokens by script: the dominant script of
a token names the letters it should have, look-alikes of other scripts are substituted, and
only when the result is a word of the corpus. A letter without look-alikes leaves a token one
reading; a token wholly of look-alikes (``Νо``) has several, of which the one most frequent in
the corpus holds, the dominant script deciding ties. A token of one other script, all of it look-alikes, is
read in Latin letters where the corpus holds that word at least as often (an extension of the method).

Plan. Texts without a Greek or Cyrillic letter (nearly all) are folded in one Arrow pass and
never shuffled. The others are deduplicated; their distinct suspicious tokens are joined with
the vocabulary, a map-side combined count over all texts, restricted to the candidates.

Defined results: null stays null; empty stays empty; texts of any length are handled whole;
repeated rows and null keys are kept as they come; columns of any other name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixloom.llm import textforms
from pixloom.session import cut, table

#: Letters of scripts with look-alikes of Latin, as stored (before folding).
SUSPECT = r"[µͰ-ϿЀ-ԯἀ-῿\x{1D6A8}-\x{1D7CB}]"
_WORD = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]+"


@F.pandas_udf(T.StringType())
def fold_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda t: None if t is None else textforms.fold(t))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _suspicious(s: pd.Series) -> pd.Series:
    return s.map(textforms.suspicious_tokens)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _repairs(s: pd.Series) -> pd.Series:
    return s.map(textforms.repairs)


@F.pandas_udf(T.StringType())
def _replace(text: pd.Series, bad: pd.Series, good: pd.Series) -> pd.Series:
    return pd.Series([textforms.replace_tokens(t, dict(zip(b, g))) for t, b, g in zip(text, bad, good)], dtype=object)


def suspect(col: Column | str) -> Column:
    return F.coalesce((F.col(col) if isinstance(col, str) else col).rlike(SUSPECT), F.lit(False))


def vocabulary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(word, n): lower-cased words of all folded texts."""
    texts = F.explode(F.array(*[F.col(c) for c in cols]))
    return (
        df.select(texts.alias("t"))
        .select(F.explode(F.regexp_extract_all(F.lower("t"), F.lit(_WORD), F.lit(0))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def token_repairs(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(token, repaired) of the suspicious tokens of ``texts(text, bad)`` whose repair is a word of the corpus."""
    cand = (
        texts.select(F.explode("bad").alias("token")).distinct()
        .select("token", F.posexplode(_repairs("token")).alias("pos", "repaired"))
    )
    own = words.select(F.col("word").alias("own_word"), F.col("n").alias("own_n"))
    found = cand.join(words, F.lower("repaired") == F.col("word")).drop("word")
    found = found.join(own, F.lower("token") == F.col("own_word"), "left").drop("own_word")
    # a mixed token never stands against its repair; a token of one script does, by frequency
    mixed = F.col("token").rlike(r"[\p{IsLatin}]") | (F.col("token").rlike(r"[\p{IsGreek}]") & F.col("token").rlike(r"[\p{IsCyrillic}]"))
    found = found.filter(mixed | (F.col("n") >= F.coalesce("own_n", F.lit(0))))
    best = Window.partitionBy("token").orderBy(F.desc("n"), "pos")
    return found.withColumn("r", F.row_number().over(best)).filter("r = 1").select("token", "repaired")


def canonicalize(df: DataFrame, cols: Sequence[str], suffix: str = "_canonical") -> DataFrame:
    """``df`` with a canonical form of each of ``cols`` in a further column ``<col><suffix>``."""
    names = [f"{c}{suffix}" for c in cols]
    any_suspect = F.lit(False)
    for c in cols:
        any_suspect = any_suspect | suspect(c)
    folded = df.withColumns({n: fold_udf(c) for n, c in zip(names, cols)})
    plain = folded.filter(~any_suspect)
    odd = cut(folded.filter(any_suspect))

    texts = (
        odd.select(F.explode(F.array(*[F.when(suspect(n), F.col(n)) for n in names])).alias("text"))
        .filter("text IS NOT NULL").distinct().withColumn("bad", _suspicious("text"))
    )
    texts = cut(texts.filter(F.size("bad") > 0))
    words = vocabulary(plain.select(*names).unionByName(odd.select(*names)), names)
    fixes = cut(token_repairs(texts, words))
    fixed = (
        texts.select("text", F.explode("bad").alias("token"))
        .join(fixes, "token")
        .groupBy("text")
        .agg(F.collect_list("token").alias("bad"), F.collect_list("repaired").alias("good"))
        .select(F.col("text").alias("_text"), _replace("text", "bad", "good").alias("_fixed"))
    )
    fixed = cut(fixed)
    for n in names:
        odd = odd.join(fixed, F.col(n) == F.col("_text"), "left").withColumn(n, F.coalesce("_fixed", n)).drop("_text", "_fixed")
    return plain.unionByName(odd)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "predictions").select("pred_id", "prediction", "answer")
    return (
        canonicalize(rows, ["prediction", "answer"])
        .filter((F.col("prediction") != F.col("answer")) & (F.col("prediction_canonical") == F.col("answer_canonical")))
        .select("pred_id").distinct()
    )


def p3_canonical(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "predictions").select("pred_id", "prediction", "answer").distinct()
    return canonicalize(rows, ["prediction", "answer"])


QUERIES = {"p3_found": p3_found, "p3_canonical": p3_canonical}
ORACLES: dict[str, str] = {}
