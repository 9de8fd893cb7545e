"""Accuracy reports as grouped aggregates: every operator is one or two hash aggregates with map-side combine.

A report takes any frame with the named columns; extra columns are ignored. Results are long
(one row per cell) unless the columns are given as a closed list. Null group names have no row
unless stated; a group without rows has no row; undefined ratios are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """One row per key, that of the greatest ``by``; of equal ones any, so ties should be equal rows."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), by).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def mean(col: str | Column, digits: int = 6) -> Column:
    """Rounded mean; exact sums of 0/1 columns make it equal on every engine."""
    return F.round(F.avg(col), digits)


def ratio(a: Column, b: Column, scale: float = 1.0, digits: int = 6, empty: float | None = None) -> Column:
    """Rounded ``scale * a / b``, ``empty`` when ``b`` is 0 or null."""
    good = b.isNotNull() & (b != 0)
    return F.round(F.when(good, F.lit(scale) * a / b).otherwise(F.lit(empty).cast("double")), digits)


def share(condition: Column, digits: int = 6) -> Column:
    """Share of the rows of a group that satisfy ``condition`` (null counts as false)."""
    return F.round(F.avg(F.coalesce(condition, F.lit(False)).cast("int")), digits)


def by_levels(df: DataFrame, keys: Sequence[str], levels: Sequence[str], *aggs: Column, overall: str | None = "Overall") -> DataFrame:
    """One grouping set for each of ``levels`` (and for all rows) in one pass: (keys, level, name, aggregates)."""
    sets = [[*keys, c] for c in levels] + ([list(keys)] if overall else [])
    n = len(levels)
    none = (1 << n) - 1
    out = df.groupingSets(sets, *keys, *levels).agg(F.grouping_id().alias("_g"), *aggs)
    level = F.lit(overall)
    name = F.lit(overall)
    for i, c in enumerate(levels):
        here = F.col("_g") == (none ^ (1 << (n - 1 - i)))
        level = F.when(here, c).otherwise(level)
        name = F.when(here, F.col(c)).otherwise(name)
    cells = [x for x in out.columns if x not in (*keys, *levels, "_g")]
    return out.select(*keys, level.alias("level"), name.alias("name"), *cells).filter("name IS NOT NULL")


def macro(df: DataFrame, outer: Sequence[str], inner: Sequence[str], value: str, name: str) -> DataFrame:
    """Unweighted mean over ``inner`` groups of their means."""
    per = df.filter(" AND ".join(f"{c} IS NOT NULL" for c in inner)).groupBy(*outer, *inner).agg(F.avg(value).alias("_m"))
    return per.groupBy(*outer).agg(F.round(F.avg("_m"), 6).alias(name))


def all_correct(df: DataFrame, keys: Sequence[str], hit: str = "hit") -> DataFrame:
    """(keys, n, hit): a group hits when each of its rows does (the product of 0/1 hits)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(hit).alias("hit"))


def confusion(truth: Column, guess: Column) -> list[Column]:
    """Counts ``tp fp fn tn`` of two boolean columns; a null guess is false, rows of null truth don't count."""
    g = F.coalesce(guess, F.lit(False))
    return [
        F.count_if(truth & g).alias("tp"),
        F.count_if(~truth & g).alias("fp"),
        F.count_if(truth & ~g).alias("fn"),
        F.count_if(~truth & ~g).alias("tn"),
    ]


def prf(df: DataFrame, scale: float = 1.0, digits: int = 6) -> DataFrame:
    """``precision``, ``recall``, ``f1`` and ``accuracy`` from ``tp fp fn tn``; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return df.withColumns(
        {
            "precision": ratio(tp, tp + fp, scale, digits, 0.0),
            "recall": ratio(tp, tp + fn, scale, digits, 0.0),
            "f1": ratio(2 * tp, 2 * tp + fp + fn, scale, digits, 0.0),
            "accuracy": ratio(tp + tn, tp + fp + fn + tn, scale, digits, 0.0),
        }
    )


def win_reward(df: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """Share of wins and the reward ``(100 much better + 50 better - 50 worse - 100 much worse) / n``; scores -2 to 2."""
    s = F.col(score)
    reward = 50 * F.sum(F.coalesce(s, F.lit(0)))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), share(s > 0).alias("win_rate"), share(s == 0).alias("tie_rate"),
        F.round(reward / F.count("*"), 6).alias("reward"),
    )


def verdict_score(verdict: str | Column, reverse: Column) -> Column:
    """A>>B .. B>>A as 2 .. -2, other words as 0; the sign flips when the sides were exchanged."""
    v = F.col(verdict) if isinstance(verdict, str) else verdict
    s = F.when(v == "A>>B", 2).when(v == "A>B", 1).when(v == "B>A", -1).when(v == "B>>A", -2).otherwise(0)
    return F.when(reverse, -s).otherwise(s)


def with_control(df: DataFrame, group: str, control: str, counts: Sequence[str]) -> DataFrame:
    """Add the counts of the shared control group to every other group; joins one row per group, never the records."""
    shared = df.filter(F.col(group) == control).select(*[F.col(c).alias(f"_c_{c}") for c in counts])
    own = df.filter(F.col(group) != control)
    joined = own.join(F.broadcast(shared.limit(1)), F.lit(True), "left")
    return joined.select(group, *[(F.col(c) + F.coalesce(F.col(f"_c_{c}"), F.lit(0))).alias(c) for c in counts])


def pivot_means(df: DataFrame, row: Sequence[str], column: str, values: Sequence[str], value: str, fill: float | None = None) -> DataFrame:
    """Mean of ``value`` by row and by a closed list of column values; ``fill`` stands for a missing cell."""
    cells = [F.round(F.avg(F.when(F.col(column) == v, F.col(value))), 6).alias(str(v)) for v in values]
    out = df.groupBy(*row).agg(*cells)
    return out if fill is None else out.fillna(fill, subset=[str(v) for v in values])


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of the values that are not null or negative, by weight; -1 when there are none."""
    ok = value >= 0
    top = F.sum(F.when(ok, value * weight))
    low = F.sum(F.when(ok, weight))
    return F.coalesce(F.when(low > 0, top / low), F.lit(-1.0))
