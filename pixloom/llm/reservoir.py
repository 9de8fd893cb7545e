"""Fixed-size uniform sample from data of unknown length that arrives in pieces (problem 6).

A reservoir of ``k`` records, too large for one machine, is kept in hash-partitioned slots. When a
batch of ``m`` new records meets ``n`` seen ones, the number of places it takes is hypergeometric:
the batch's share of a uniform ``k``-subset of ``n + m``. That count is split over the slots of the
batch (multivariate hypergeometric over their new records), the evictions over the slots of the
reservoir (over their kept records); each slot evicts uniformly and inserts a uniform sample of
its new records. After every batch the reservoir is a uniform ``k``-subset of all records so far.

Plan. One aggregate counts new records by (folder, slot, batch). The draws need these counts
only: one small group per run, independent of the records. The records are hashed to (folder,
slot) once; a task walks one slot batch by batch for all runs of the folder, with a bounded
number of records as the number of slots follows the folder's size. Every random number comes
from a generator keyed by (seed, run, batch, slot), so a lost task repeats itself exactly, and
``Reservoir.update`` applies the same step to batches as they arrive.

Defined results: null or non-positive sample sizes give no rows, sizes above the population give
all of it; repeated deliveries and members count as one record; a record belongs to the batch in
which it was first seen, late or not; null folders match no run; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.session import cut, table
from pixloom.tables import bare_folder, sample_key


def rng(*key) -> np.random.Generator:
    """A generator that depends on the key alone."""
    digest = hashlib.blake2b("\x1f".join(map(str, key)).encode(), digest_size=16).digest()
    return np.random.default_rng(int.from_bytes(digest, "little"))


def hypergeometric(g: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among ``n`` drawn without replacement, for populations of any size.

    Inversion outwards from the mode. Probabilities relative to the mode's follow from ratios of small products, so no
    large logarithms are needed; both walks end where the rest is below the precision of a float."""
    lo, hi = max(0, n - bad), min(n, good)
    if lo >= hi:
        return lo
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), lo), hi)
    up, down = [], []
    p, k = 1.0, mode
    while k < hi and p > 1e-20:
        p *= (good - k) / (k + 1) * ((n - k) / (bad - n + k + 1))
        k += 1
        up.append(p)
    p, k = 1.0, mode
    while k > lo and p > 1e-20:
        p *= k / (good - k + 1) * ((bad - n + k) / (n - k + 1))
        k -= 1
        down.append(p)
    weights = np.concatenate([np.array(down[::-1]), [1.0], np.array(up)])
    at = np.searchsorted(np.cumsum(weights), g.random() * weights.sum(), side="right")
    return int(mode - len(down) + min(int(at), len(weights) - 1))


def split(g: np.random.Generator, counts, n: int) -> list[int]:
    """Multivariate hypergeometric: ``n`` draws split over slots holding ``counts``."""
    out, rest = [], int(sum(counts))
    for c in counts:
        c = int(c)
        x = hypergeometric(g, c, rest - c, n) if n else 0
        out.append(x)
        rest, n = rest - c, n - x
    return out


def step(seed, run, batch, k: int, seen: int, kept: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(evictions, insertions) by slot when a batch with ``new`` records by slot meets a reservoir."""
    g = rng(seed, run, batch)
    m, size = int(new.sum()), int(kept.sum())
    fresh = max(0, min(m, k - size))  # the reservoir first fills
    taken = fresh
    if m > fresh:
        # of the k-subset of seen + m records, the share of the batch
        taken = hypergeometric(g, m, seen, k)
    insert = np.array(split(g, new, taken), dtype=np.int64)
    evict = np.array(split(g, kept, size + taken - k if size + taken > k else 0), dtype=np.int64)
    return evict, insert


def apply_step(seed, run, batch, slot, kept: np.ndarray, new: np.ndarray, evict: int, insert: int) -> np.ndarray:
    """One slot's records after a batch: uniform eviction, uniform insertion (arrays of positions)."""
    g = rng(seed, run, batch, slot, "slot")
    if evict:
        kept = g.choice(kept, len(kept) - evict, replace=False)
    if insert:
        kept = np.concatenate([kept, g.choice(new, insert, replace=False)])
    return kept


PLAN = "run_id bigint, folder string, slot int, batch long, evict long, insert long"


def draws(counts: DataFrame, runs: DataFrame) -> DataFrame:
    """All draws of all runs from (folder, slot, batch, m), one small group per run."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        run, folder, k, seed = pdf.run_id.iloc[0], pdf.folder.iloc[0], int(pdf.k.iloc[0]), pdf.seed.iloc[0]
        slots = np.sort(pdf.slot.unique())
        kept, seen, rows = np.zeros(len(slots), np.int64), 0, []
        for batch, part in pdf.groupby("batch", sort=True):
            new = np.zeros(len(slots), np.int64)
            new[np.searchsorted(slots, part.slot.to_numpy())] = part.m.to_numpy()
            evict, insert = step(seed, run, batch, k, seen, kept, new)
            kept, seen = kept - evict + insert, seen + int(new.sum())
            rows += [(run, folder, s, batch, e, i) for s, e, i in zip(slots, evict, insert) if e or i]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PLAN.split(", ")])

    return counts.join(runs, "folder").groupBy("run_id").applyInPandas(one, PLAN)


def sample(records: DataFrame, runs: DataFrame, slot_records: int = 200_000) -> DataFrame:
    """(run_id, folder, key) from ``records(folder, key, batch)``, distinct by folder and key, and
    ``runs(run_id, folder, k, seed)``: a uniform ``k``-subset of the folder's records for each run."""
    runs = runs.filter("k >= 1 AND folder IS NOT NULL").withColumn("seed", F.coalesce("seed", F.lit(0)))
    wanted = records.join(runs.select("folder").distinct(), "folder", "left_semi")
    sizes = wanted.groupBy("folder").agg(F.ceil(F.count("*") / slot_records).cast("int").alias("slots"))
    placed = cut(wanted.join(sizes, "folder").withColumn("slot", F.expr("pmod(xxhash64(key), slots)").cast("int")).drop("slots"))
    counts = placed.groupBy("folder", "slot", "batch").agg(F.count("*").alias("m"))
    steps = cut(draws(counts, runs)).join(runs.select("run_id", "seed"), "run_id")

    def walk(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["batch", "key"], kind="stable")
        names, batches = left.key.to_numpy(), left.batch.to_numpy()
        out = []
        for run, mine in right.groupby("run_id", sort=True):
            kept = np.empty(0, dtype=np.int64)
            for r in mine.sort_values("batch").itertuples():
                new = np.arange(np.searchsorted(batches, r.batch, "left"), np.searchsorted(batches, r.batch, "right"))
                kept = apply_step(r.seed, run, r.batch, key[1], kept, new, int(r.evict), int(r.insert))
            out.append(pd.DataFrame({"run_id": run, "folder": key[0], "key": names[kept]}))
        # no run may take a record of this slot; columns of floats would not become strings
        return pd.concat(out) if out else pd.DataFrame([], columns=["run_id", "folder", "key"], dtype=object)

    return (
        placed.groupBy("folder", "slot").cogroup(steps.groupBy("folder", "slot"))
        .applyInPandas(walk, "run_id bigint, folder string, key string")
    )


class Reservoir:
    """The same reservoir over batches as they arrive, its state a table below ``path``.

    ``update`` reads the state of the last finished batch and writes the next one beside it; a
    batch that died half-way is simply written again, a batch already finished is skipped.
    """

    def __init__(self, spark: SparkSession, path: str, k: int, seed: int = 0, slots: int | None = None):
        """``slots`` follows from ``k`` unless given: about 200 000 kept records each."""
        self.spark, self.path, self.k, self.seed = spark, path, k, seed
        self.slots = slots or max(8, -(-k // 200_000))

    def _at(self, batch: int) -> str:
        return os.path.join(self.path, f"batch={batch:012d}")

    def last(self) -> int:
        if not os.path.isdir(self.path):
            return -1
        done = [d for d in os.listdir(self.path) if os.path.exists(os.path.join(self.path, d, "_SUCCESS"))]
        return max((int(d.split("=")[1]) for d in done), default=-1)

    def state(self) -> DataFrame:
        """(slot, key, kept): kept records, and one row per slot with the number seen under a null key."""
        at = self.last()
        schema = "slot int, key string, seen long"
        return self.spark.read.schema(schema).parquet(self._at(at)) if at >= 0 else self.spark.createDataFrame([], schema)

    def sample(self) -> DataFrame:
        return self.state().filter("key IS NOT NULL").select("key")

    def update(self, batch: DataFrame, number: int) -> None:
        """Take in ``batch(key)``, records not seen before."""
        if number <= self.last():
            return
        slot = F.expr(f"pmod(xxhash64(key), {self.slots})").cast("int")
        new = cut(batch.select("key").filter("key IS NOT NULL").distinct().withColumn("slot", slot))
        state = self.state()
        was = state.groupBy("slot").agg(F.count("key").alias("kept"), F.sum("seen").alias("seen")).collect()
        now = new.groupBy("slot").count().collect()  # both bounded by the number of slots
        kept, m, seen = np.zeros(self.slots, np.int64), np.zeros(self.slots, np.int64), 0
        for r in was:
            kept[r["slot"]], seen = r["kept"], seen + int(r["seen"] or 0)
        for r in now:
            m[r["slot"]] = r["count"]
        evict, insert = step(self.seed, 0, number, self.k, seen, kept, m)
        seed, total = self.seed, seen + int(m.sum())

        def walk(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            s = int(key[0])
            names = np.concatenate([np.sort(left.key.dropna().to_numpy(dtype=object)), np.sort(right.key.to_numpy(dtype=object))])
            n = len(names) - len(right)
            at = apply_step(seed, 0, number, s, np.arange(n), np.arange(n, len(names)), int(evict[s]), int(insert[s]))
            rows = [(s, names[i], None) for i in at]
            return pd.DataFrame(rows + [(s, None, None)], columns=["slot", "key", "seen"]).astype({"seen": "Int64"})

        after = state.groupBy("slot").cogroup(new.groupBy("slot")).applyInPandas(walk, "slot int, key string, seen long")
        after = after.filter("key IS NOT NULL").unionByName(
            self.spark.createDataFrame([(0, None, total)], "slot int, key string, seen long")
        )
        after.write.mode("overwrite").parquet(self._at(number))


def arrivals(members: DataFrame) -> DataFrame:
    """(folder, key, batch): distinct samples of each folder; the batch is the day its file began to arrive."""
    first = (
        members.select(bare_folder("wds_shards_folder").alias("folder"), "shard", sample_key("fname").alias("key"), "arrived_at")
        .groupBy("folder", "shard", "key").agg(F.min("arrived_at").alias("at"))
    )
    by_file = first.groupBy("folder", "shard").agg(F.min("at").alias("file_at"))
    day = F.unix_date(F.to_date("file_at")).cast("bigint")
    f = by_file.select(F.col("folder").alias("f_folder"), F.col("shard").alias("f_shard"), day.alias("day"))
    return (
        first.join(f, first.folder.eqNullSafe(F.col("f_folder")) & first.shard.eqNullSafe(F.col("f_shard")))
        .groupBy("folder", "key").agg(F.coalesce(F.min("day"), F.lit(0)).alias("batch"))
    )


def p6_sample(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "run_args").select(
        "run_id",
        bare_folder("wds_shards_folder").alias("folder"),
        F.col("wds_nsamples_per_epoch").alias("k"),
        F.col("wds_shuffle_seed").alias("seed"),
    )
    got = sample(arrivals(table(spark, sf, "shard_members")), runs)
    return got.withColumnsRenamed({"folder": "wds_shards_folder", "key": "sample_key"})


def p6_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the samples: for each run with a size, as many distinct samples as asked for or there are, all known."""
    got = p6_sample(spark, sf)
    known = arrivals(table(spark, sf, "shard_members")).select(F.col("folder").alias("wds_shards_folder"), F.col("key").alias("sample_key"), F.lit(1).alias("known"))
    return got.join(known, ["wds_shards_folder", "sample_key"], "left").groupBy("run_id", "wds_shards_folder").agg(
        F.count("*").alias("n"), F.count_distinct("sample_key").alias("different"), F.count("known").alias("known"))


QUERIES = {"p6_sample": p6_sample, "p6_counts": p6_counts}
ORACLES = {
    "p6_counts": """WITH m AS (SELECT DISTINCT list_filter(string_split(wds_shards_folder, '/'), lambda x: trim(x) <> '')[-1] AS folder, regexp_extract(fname, '^([^_.]*)', 1) AS key FROM shard_members),
      c AS (SELECT folder, count(*) AS n FROM m GROUP BY folder)
      SELECT run_id, folder AS wds_shards_folder, least(wds_nsamples_per_epoch, n) AS n, least(wds_nsamples_per_epoch, n) AS different, least(wds_nsamples_per_epoch, n) AS known
      FROM run_args JOIN c ON c.folder = list_filter(string_split(wds_shards_folder, '/'), lambda x: trim(x) <> '')[-1] WHERE wds_nsamples_per_epoch >= 1"""
}
