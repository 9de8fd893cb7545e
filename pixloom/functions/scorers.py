"""Named scorers, aggregations and sets: the extension points, and the dispatch by task.

A scorer is a function of two columns (prediction, truth) to a score from 0 to 1; an aggregation is a function of a
column to an aggregate; a hash is a function of (image, h, w) columns to a text of 64 bits. Register one under a new name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixloom.functions import answers as A
from pixloom.functions import denotation, structures

SCORERS: dict[str, Callable[[Column, Column], Column]] = {}
AGGREGATIONS: dict[str, Callable[[Column], Column]] = {}
HASHES: dict[str, Callable[[Column, Column, Column], Column]] = {}
#: Scorer of each kind of task.
TASKS: dict[str, str] = {"mcq": "letter", "yorn": "yes_no", "vqa": "anls", "open": "contains"}


def register(kind: dict, name: str):
    """Add the decorated function; a name is taken once."""

    def add(fn):
        if name in kind:
            raise ValueError(f"name used twice: {name}")
        kind[name] = fn
        return fn

    return add


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


register(SCORERS, "exact")(lambda p, t: _flag(A.exact(p, t)))
register(SCORERS, "contains")(lambda p, t: _flag(F.contains(F.lower(p), F.lower(t))))
register(SCORERS, "anls")(lambda p, t: F.coalesce(A.anls(t, p), F.lit(0.0)))
register(SCORERS, "relaxed")(lambda p, t: _flag(A.relaxed(p, t)))
register(SCORERS, "letter")(lambda p, t: _flag(A.first_letter(p) == t))
register(SCORERS, "yes_no")(lambda p, t: _flag(A.yes_no(p) == A.yes_no(t)))
register(SCORERS, "normal")(lambda p, t: _flag(A.normal_answer(p) == A.normal_answer(t)))
register(SCORERS, "near_text")(lambda p, t: F.coalesce(structures.udf(structures.near_text, T.DoubleType())(p, t), F.lit(0.0)))
register(SCORERS, "math")(lambda p, t: _flag(structures.udf(denotation.math_equal, T.BooleanType())(p, t)))
register(SCORERS, "table")(lambda p, t: F.coalesce(structures.udf(structures.table_similarity, T.DoubleType())(p, t), F.lit(0.0)))
register(SCORERS, "denotation")(lambda p, t: _flag(structures.udf(lambda a, b: denotation.same_denotation(b.split("|"), a.split("|")), T.BooleanType())(p, t)))
register(AGGREGATIONS, "mean")(F.avg)
register(AGGREGATIONS, "min")(F.min)
register(AGGREGATIONS, "all")(lambda c: F.min((c >= 1).cast("int")))


def score(df: DataFrame, pred: str, truth: str, task: str, name: str = "score", tasks: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the score of each row by its task's scorer; null for an unknown task."""
    out = F.lit(None).cast("double")
    for kind, scorer in (tasks or TASKS).items():
        out = F.when(F.col(task) == kind, SCORERS[scorer](F.col(pred), F.col(truth))).otherwise(out)
    return df.withColumn(name, out)


def aggregate(df: DataFrame, keys: list[str], value: str, *names: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.round(AGGREGATIONS[n](F.col(value)), 6).alias(n) for n in names])
