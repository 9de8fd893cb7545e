"""The corpus pipeline on archive members: samples, pixel filter, joins, re-sharding, manifests.

Members are rows of (folder, shard, pos, fname, data): see ``pixloom.tables.valid_members`` for the delivered
table and ``pixloom.sources.archives`` for archive files. Every step is a narrow projection or one
aggregate or equi-join by (folder, shard) or by key; no step reads ``data`` that doesn't need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixloom.operators.ordinal import islands, ordinal
from pixloom.tables import sample_key, sample_suffix

IMAGE = ("jpg", "jpeg", "png")


def sample_runs(members: DataFrame) -> DataFrame:
    """(folder, shard, run, key, n, suffixes, doubled): consecutive members of one key in archive order.

    ``doubled`` is set where a suffix occurs twice in a run, which a strict reader refuses."""
    m = members.select("folder", "shard", "pos", "fname", sample_key("fname").alias("key"), sample_suffix("fname").alias("suffix"))
    runs = islands(m, ["folder", "shard"], ["pos", "fname"], "key")
    return runs.groupBy("folder", "shard", "run", "key").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("suffix")), ",").alias("suffixes"),
        (F.count("*") > F.count_distinct("suffix")).alias("doubled"),
    )


def triples(members: DataFrame) -> DataFrame:
    """(folder, shard, key, text, meta, image): the parts of each sample side by side, the first of each kind by position."""
    suffix = sample_suffix("fname")

    def part(kind):
        return F.min_by(F.when(kind, F.col("data")), F.when(kind, F.struct("pos", "fname")))

    return members.groupBy("folder", "shard", sample_key("fname").alias("key")).agg(
        part(suffix == "txt").alias("text"), part(suffix == "json").alias("meta"), part(suffix.isin(*IMAGE)).alias("image")
    )


def readable(t: DataFrame) -> DataFrame:
    """Samples with all three parts, the text and the record being valid UTF-8."""
    return t.filter(
        F.col("text").isNotNull() & F.col("meta").isNotNull() & F.col("image").isNotNull()
        & F.is_valid_utf8(F.col("text").cast("string")) & F.is_valid_utf8(F.col("meta").cast("string"))
    )


def picture_sizes(members: DataFrame) -> DataFrame:
    """(folder, shard, key, w, h) from the record members; null sizes where they can't be read."""
    meta = F.from_json(F.col("data").cast("string"), "w int, h int")
    rows = members.filter(sample_suffix("fname") == "json").select("folder", "shard", sample_key("fname").alias("key"), meta.alias("m"))
    return rows.select("folder", "shard", "key", "m.w", "m.h")


def resolution_verdict(w: Column, h: Column, size: int = 448, least: int = 1, most: int = 12) -> Column:
    """min for a side below ``least * size``, else max for one above ``most * size``, else keep; null without sizes."""
    low, high = least * size, most * size
    return F.when(w.isNull() | h.isNull(), F.lit(None)).when((h < low) | (w < low), "min").when((h > high) | (w > high), "max").otherwise("keep")


def picture_stats(w: Column, h: Column) -> Column:
    return F.struct(F.least(w, h).alias("shorter"), F.greatest(w, h).alias("longer"), (F.rint(w / h * 10_000) / 10_000).alias("ratio"), (w.cast("bigint") * h).alias("area"))


def reshard(samples: DataFrame, order: list[str], per_shard: int) -> DataFrame:
    """``samples`` with the new shard number, the offset in it and the key of 5 + 4 digits, in a global order."""
    numbered = ordinal(samples, order, "_ord")
    shard = F.floor(F.col("_ord") / per_shard)
    offset = F.col("_ord") % per_shard
    return numbered.withColumns({"new_shard": shard, "offset": offset, "new_key": F.format_string("%05d%04d", shard, offset)}).drop("_ord")


def manifest(members: DataFrame) -> DataFrame:
    """(folder, shard, n, names): names of each shard in archive order; a shard's members bound a row."""
    return members.groupBy("folder", "shard").agg(
        F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "fname"))), lambda x: x["fname"]).alias("names")
    )


def missing_shards(listing: DataFrame, digits: int = 8) -> DataFrame:
    """(folder, shard) of the numbers from 0 to the greatest of a folder that have no file."""
    n = F.regexp_extract("shard", r"^([0-9]+)\.tar$", 1).try_cast("bigint")
    have = listing.select("folder", n.alias("n")).filter("n IS NOT NULL").distinct()
    top = have.groupBy("folder").agg(F.max("n").alias("top"))
    wanted = top.select("folder", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("top"))).alias("n"))
    return wanted.join(have, ["folder", "n"], "left_anti").select("folder", F.format_string(f"%0{digits}d.tar", F.col("n")).alias("shard"))


def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, in_a, in_b): where each key occurs, from one aggregate of both sides."""
    rows = a.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("b")))
    return rows.groupBy(*keys).agg((F.max("a") == 1).alias("in_a"), (F.max("b") == 1).alias("in_b"))


def contains_first(texts: DataFrame, annotations: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """(id, ord): for each of ``texts(id, text)`` the first of ``annotations(ord, stem)`` whose stem it contains.

    The stems, at most ``limit`` of them (checked), are sent as one automaton, so each text is read once, whatever their
    number; a larger set is taken in parts of ``limit`` and the least ``ord`` of the parts holds. Null and empty stems match nothing.
    """
    import pandas as pd

    spark = texts.sparkSession
    stems = annotations.filter("stem IS NOT NULL AND stem <> ''").groupBy("stem").agg(F.min("ord").alias("ord"))
    parts = max(1, -(-stems.count() // (limit // 2 + 1)))
    out = None
    for k in range(parts):
        rows = stems.filter(F.pmod(F.xxhash64("stem"), F.lit(parts)) == k).collect()  # at most about half of ``limit``
        sent = spark.sparkContext.broadcast([(r["stem"], r["ord"]) for r in rows])

        def match(batches, sent=sent):
            import ahocorasick

            machine = ahocorasick.Automaton()
            for stem, at in sent.value:
                machine.add_word(stem, at)
            if sent.value:
                machine.make_automaton()
            for pdf in batches:
                found = [min((at for _, at in machine.iter(t)), default=None) if t and sent.value else None for t in pdf.text]
                got = pd.DataFrame({"id": pdf.id, "ord": pd.array(found, dtype="Int64")})
                yield got[got.ord.notna()]

        part = texts.select("id", "text").mapInPandas(match, f"id {dict(texts.dtypes)['id']}, ord bigint")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("id").agg(F.min("ord").alias("ord"))


def circular(items: DataFrame, letters: str = "ABCD", offset: int = 1_000_000) -> DataFrame:
    """Every item with its ``k`` options in all ``k`` rotations: rotation r shows option ``i + r`` under letter ``i``.

    ``item_index`` grows by ``offset`` a rotation, ``answer`` follows its option, ``g_index`` names the item; items with
    gaps between their options or fewer than two stand once as they are."""
    opts = [f"option_{c.lower()}" for c in letters]
    packed = F.array(*[F.col(o) for o in opts])
    some = F.filter(packed, lambda x: x.isNotNull())
    k = F.size(some)
    whole = (k >= 2) & F.forall(F.slice(packed, 1, F.greatest(k, F.lit(1))), lambda x: x.isNotNull())
    at = F.when(F.col("answer").isin(*letters), F.ascii("answer") - 65)
    rows = items.withColumns({"_k": F.when(whole, k).otherwise(1), "_o": some, "_at": at, "_whole": whole})
    rows = rows.withColumn("rotation", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    turned = {o: F.when(F.col("_whole") & (F.col("_k") > i), F.element_at("_o", F.pmod(F.col("rotation") + i, F.col("_k")) + 1)).otherwise(F.col(o)) for i, o in enumerate(opts)}
    answer = F.when(F.col("_whole") & F.col("_at").isNotNull(), F.char(F.pmod(F.col("_at") - F.col("rotation"), F.col("_k")) + 65)).otherwise(F.col("answer"))
    return rows.withColumns({**turned, "answer": answer, "g_index": F.col("item_index"), "item_index": F.col("item_index") + F.col("rotation") * F.lit(offset).cast("bigint")}).drop("_k", "_o", "_at", "_whole")


def remaining(items: DataFrame, done: DataFrame, key: str, text: str, failed: str) -> DataFrame:
    """Items without a good result: never answered, null or failed."""
    good = done.filter(F.col(text).isNotNull() & ~F.contains(F.col(text), F.lit(failed))).select(key).distinct()
    return items.join(good, key, "left_anti")
