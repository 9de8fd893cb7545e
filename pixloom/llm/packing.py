"""Filling fixed-capacity containers with items (problem 8).

Bounded-space online packing: a packer holds at most ``windows`` open containers. An item goes
to the open container it fits best (least room left); when none has room and all windows are
open, the fullest is emitted. An item longer than the capacity is first split into parts of the
capacity and a rest. Containers still open when a partition ends are merged in further passes
over fewer partitions, container by container, so no text is split by merging.

Plan. Lengths are computed in one Arrow pass that reads only id and text. Items are hashed into
about ``items / bucket_items`` buckets and each task streams its sorted bucket through one packer
per capacity, so memory is ``capacities x windows`` open containers at any scale. The order in a
bucket is fixed by a seeded hash of the item, so a retried task packs alike. Each merging pass
sees ``windows`` leftovers of each bucket; the number of buckets falls by ``fan_in`` a pass.

Defined results: null and empty texts have length 0 and take part in exactly one container; a
text whose length is a multiple of the capacity leaves no rest; null ids are packed like others;
repeated ids are packed once for each row; an empty table has no containers; capacities that are
null or below 1 are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.llm.tokens import count_tokens
from pixloom.session import cut, spread, table

SCHEMA = "capacity int, seq_id string, item_id bigint, part int, start bigint, n_tokens bigint, open boolean"


class Packer:
    """Containers of one capacity; ``add`` and ``finish`` yield (number, used, content) of closed ones."""

    def __init__(self, capacity: int, windows: int):
        self.capacity, self.windows = capacity, windows
        self.used: list[int] = []
        self.content: list[list] = []
        self.number: list[int] = []
        self.made = 0

    def _close(self, i: int):
        out = self.number[i], self.used[i], self.content[i]
        for part in (self.number, self.used, self.content):
            part[i] = part[-1]
            part.pop()
        return out

    def add(self, size: int, payload: list):
        """Place an item of ``size``; the container this emits, if any."""
        room, best, fullest = self.capacity - size, -1, -1
        for i, u in enumerate(self.used):
            if u <= room and (best < 0 or u > self.used[best]):
                best = i
            if fullest < 0 or u > self.used[fullest]:
                fullest = i
        out = None
        if best < 0:
            if len(self.used) >= self.windows:
                out = self._close(fullest)
            best = len(self.used)
            self.used.append(0)
            self.content.append([])
            self.number.append(self.made)
            self.made += 1
        self.used[best] += size
        self.content[best] += payload
        if out is None and self.used[best] == self.capacity:
            out = self._close(best)
        return out

    def finish(self):
        while self.used:
            yield self._close(len(self.used) - 1)


def _rows(capacity, tag, closed, is_open):
    number, used, content = closed
    full = used == capacity
    return [(capacity, f"{tag}-{number}", *x, is_open and not full) for x in content]


def _pack_items(capacities: Sequence[int], windows: int, level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packers, bucket = {}, None

        def flush():
            return [r for c, p in packers.items() for done in p.finish() for r in _rows(c, f"{level}-{bucket}", done, True)]

        for pdf in batches:
            out = []
            for b, item, size in zip(pdf.bucket, pdf.item_id, pdf.n_tokens):
                if b != bucket:
                    out += flush()
                    bucket, packers = b, {c: Packer(c, windows) for c in capacities}
                item = None if pd.isna(item) else int(item)
                for c, p in packers.items():
                    parts = [(k, k * c, min(c, size - k * c)) for k in range(max(1, -(-size // c)))]
                    for k, start, n in parts:
                        if closed := p.add(n, [(item, k, start, n)]):
                            out += _rows(c, f"{level}-{bucket}", closed, False)
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])
        yield pd.DataFrame(flush(), columns=[x.split()[0] for x in SCHEMA.split(", ")])

    return run


def _merge_open(windows: int, level: int):
    """Leftover containers, each whole, through the same packer; rows arrive by container."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, key = None, None

        def flush():
            return [r for done in packer.finish() for r in _rows(key[1], f"{level}-{key[0]}", done, True)] if packer else []

        for pdf in batches:
            out = []
            for b, c, used, content in zip(pdf.bucket, pdf.capacity, pdf.used, pdf.content):
                if (b, c) != key:
                    out += flush()
                    key, packer = (b, c), Packer(int(c), windows)
                rows = [(x["item_id"], x["part"], x["start"], x["n_tokens"]) for x in content]
                if closed := packer.add(int(used), rows):
                    out += _rows(int(c), f"{level}-{b}", closed, False)
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])
        yield pd.DataFrame(flush(), columns=[x.split()[0] for x in SCHEMA.split(", ")])

    return run


def pack(
    items: DataFrame, capacities: Sequence[int], windows: int = 32, bucket_items: int = 50_000, fan_in: int = 16
) -> DataFrame:
    """``items(item_id, n_tokens)`` to (capacity, seq_id, item_id, part, start, n_tokens)."""
    capacities = sorted({int(c) for c in capacities if c is not None and c >= 1})
    spark = items.sparkSession
    names = ("capacity", "seq_id", "item_id", "part", "start", "n_tokens")
    items = cut(items.select(F.col("item_id").cast("bigint"), F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")))
    # at least a bucket for each core: a packer's leftovers are few, and they meet below
    buckets = max(1, -(-items.count() // bucket_items), min(spark.sparkContext.defaultParallelism, items.count() // 2_000))
    spread = (
        items.withColumn("h", F.xxhash64("item_id", "n_tokens", F.lit(8)))
        .withColumn("bucket", F.expr(f"pmod(h, {buckets})").cast("int"))
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "h", "item_id")
        .select("bucket", "item_id", "n_tokens")
    )
    packed = cut(spread.mapInPandas(_pack_items(capacities, windows, 0), SCHEMA))
    done = packed.filter("NOT open").select(*names)
    left, level = packed.filter("open"), 0
    while True:
        level += 1
        last = buckets == 1
        buckets = max(1, buckets // fan_in)
        again = (
            left.groupBy("capacity", "seq_id")
            .agg(F.sum("n_tokens").alias("used"), F.collect_list(F.struct("item_id", "part", "start", "n_tokens")).alias("content"))
            .withColumn("bucket", F.expr(f"pmod(xxhash64(seq_id), {buckets})").cast("int"))
            .repartition(max(1, min(buckets * len(capacities), 2000)), "bucket", "capacity")
            .sortWithinPartitions("bucket", "capacity", F.desc("used"), "seq_id")
            .select("bucket", "capacity", "used", "content")
        )
        left = cut(again.mapInPandas(_merge_open(windows, level), SCHEMA))
        done = done.unionByName(left.filter("NOT open").select(*names))
        left = left.filter("open")
        if last or buckets == 1:
            return done.unionByName(left.select(*names))


def run_capacities(spark: SparkSession, sf: str) -> list[int]:
    """The distinct sequence lengths asked for by the runs (a fixed, small table)."""
    rows = table(spark, sf, "run_args").select("model_max_length").filter("model_max_length >= 1").distinct()
    return [r[0] for r in rows.orderBy("model_max_length").collect()]


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), "text"))
    sized = docs.select("item_id", count_tokens("text").alias("n_tokens"))
    return pack(sized, run_capacities(spark, sf)).withColumnsRenamed(
        {"capacity": "model_max_length", "item_id": "doc_id"}
    )


def p8_conserved(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the packing, by capacity: every text in it, split only beyond the capacity, no container too full."""
    p = p8_packed(spark, sf)
    by_seq = p.groupBy("model_max_length", "seq_id").agg(F.sum("n_tokens").alias("used"))
    full = by_seq.groupBy("model_max_length").agg(F.count_if(F.col("used") > F.col("model_max_length")).alias("too_full"))
    by_doc = p.groupBy("model_max_length", "doc_id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("n"), F.count_distinct("part").alias("different"))
    c = F.col("model_max_length")
    due = F.greatest(F.lit(1), F.ceil(F.col("n") / c))
    docs = by_doc.groupBy("model_max_length").agg(
        F.count("*").alias("documents"), F.count_if((F.col("parts") != due) | (F.col("different") != F.col("parts"))).alias("wrong_parts"))
    return docs.join(full, "model_max_length")


QUERIES = {"p8_packed": p8_packed, "p8_conserved": p8_conserved}
ORACLES = {
    "p8_conserved": """SELECT model_max_length, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0::BIGINT AS wrong_parts, 0::BIGINT AS too_full
        FROM run_args WHERE model_max_length >= 1 GROUP BY model_max_length"""
}
