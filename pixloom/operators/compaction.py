"""Size-tiered incremental compaction of too many small shard files.

A file's tier is 0 below ``small_bytes`` and one more for each factor ``fan_in``. Level ``L`` merges,
inside a folder, the files of tier ``L`` and what lower levels left alone, in order of size, into files
of at most ``small_bytes * fan_in**(L+1)`` and never above the target; so files of like size meet
and a byte is rewritten once a level, not once an arriving file. Files at or above the target stay.

Every merge is a transaction; its id is the digest of its inputs' names and content marks, so planning the
same files again yields the same ids and names, and late rows of an input yield another one.

Scale. The plan works on the catalogue (one row a file), never on records, and reads no content. A folder
with any share of the files is spread over hash buckets of ``bucket_files`` files, each planned through all
levels in one task; what the buckets of such a folder leave below the target meets in a further
pass with fewer buckets. Records move once, straight to their final file.

Defined results: null ``data`` counts as 0 bytes; a null or empty folder path is the folder null and is compacted
like any other; an empty table gives an empty plan and journal; repeated deliveries count once (the latest
``arrived_at``); a file alone keeps its name; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import json
import math
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.session import cut
from pixloom.sources.archives import file_system
from pixloom.tables import bare_folder, valid_members


@dataclass(frozen=True)
class TierPolicy:
    """``small_bytes``: files below are tier 0. ``fan_in``: growth per level. ``target_bytes``: files of at least that
    size stay. ``bucket_files``: most files planned together. ``max_inputs``: most inputs of one merge."""

    small_bytes: int = 2_000
    fan_in: int = 8
    target_bytes: int = 128 * 1024 * 1024
    bucket_files: int = 20_000
    max_inputs: int = 10_000

    @property
    def levels(self) -> int:
        return max(1, math.ceil(math.log(self.target_bytes / self.small_bytes, self.fan_in)))

    def ceiling(self, level: int) -> int:
        return min(self.target_bytes, self.small_bytes * self.fan_in ** (level + 1))

    def tier(self, size: int) -> int:
        t = 0
        while size >= self.small_bytes * self.fan_in**t:
            t += 1
        return t


def catalogue(members: DataFrame) -> DataFrame:
    """(folder, file, n_records, bytes, mark) of the valid records of each delivered file.

    ``mark`` changes with every record that is added or delivered again."""
    sized = members.withColumn("_n", F.coalesce(F.length("data"), F.lit(0)))
    one = F.xxhash64("fname", F.col("arrived_at").cast("string"), "_n").cast("decimal(38,0)")
    return (
        valid_members(sized, "_n")
        .groupBy("folder", F.col("shard").alias("file"))
        .agg(F.count("*").alias("n_records"), F.sum("_n").cast("bigint").alias("bytes"), F.sum(one).cast("string").alias("mark"))
    )


@dataclass
class _Unit:
    name: str
    n: int
    size: int
    mark: str
    parts: list[str]  # units of the catalogue inside


def _merge(group: list[_Unit], folder, level: int) -> _Unit:
    inputs = sorted((u.name, u.mark) for u in group)
    mark = hashlib.sha256(json.dumps([folder, level, inputs]).encode()).hexdigest()
    return _Unit(f"c{level}-{mark[:24]}.tar", sum(u.n for u in group), sum(u.size for u in group), mark, [p for u in group for p in u.parts])


def merge_levels(units: list[_Unit], folder, policy: TierPolicy) -> tuple[list[_Unit], list[tuple[int, _Unit, list[str]]]]:
    """All levels over the files of one bucket: (files that stand at the end, transactions)."""
    txns = []
    for level in range(policy.levels):
        cap = policy.ceiling(level)
        ready = sorted((u for u in units if policy.tier(u.size) <= level and u.size < policy.target_bytes), key=lambda u: (u.size, u.name))
        units = [u for u in units if not (policy.tier(u.size) <= level and u.size < policy.target_bytes)]
        group: list[_Unit] = []
        total = 0

        def close(group):
            if len(group) > 1:
                made = _merge(group, folder, level)
                txns.append((level, made, [u.name for u in group]))
                units.append(made)
            else:
                units.extend(group)

        for u in ready:
            if group and (total + u.size > cap or len(group) >= policy.max_inputs):
                close(group)
                group, total = [], 0
            group.append(u)
            total += u.size
        close(group)
    return units, txns


_STEP = "folder string, kind string, level int, txn_id string, output string, name string, inputs array<string>, n_records bigint, bytes bigint, mark string, tier int"


def _plan_bucket(policy: TierPolicy):
    names = [c.split()[0] for c in _STEP.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        folder = pdf.folder.iloc[0] if isinstance(pdf.folder.iloc[0], str) else None
        units = [_Unit(f, int(n), int(b), m, [f]) for f, n, b, m in zip(pdf.file, pdf.n_records, pdf.bytes, pdf.mark)]
        sizes = {u.name: u for u in units}
        last, txns = merge_levels(units, folder, policy)
        rows = [(folder, "txn", level, u.mark, u.name, None, inputs, u.n, u.size, u.mark, None) for level, u, inputs in txns]
        rows += [(folder, "end", None, None, u.name, p, None, sizes[p].n, sizes[p].size, u.mark, policy.tier(sizes[p].size)) for u in last for p in u.parts]
        return pd.DataFrame(rows, columns=names)

    return run


@dataclass
class CompactionPlan:
    """``journal``: one row a transaction. ``assignment``: (folder, file, final, tier, n_records, bytes, final_mark) of each
    file of the catalogue; ``tier`` is its own at the start."""

    files: DataFrame
    journal: DataFrame
    assignment: DataFrame


def plan_files(files: DataFrame, policy: TierPolicy = TierPolicy()) -> CompactionPlan:
    """The plan of a catalogue ``files(folder, file, n_records, bytes, mark)``."""
    counts = cut(files.groupBy("folder").agg(F.ceil(F.count("*") / policy.bucket_files).cast("int").alias("buckets")))
    todo, first, journals = files, None, []
    while True:
        c = counts.select(F.col("folder").alias("_f"), "buckets")
        spread = todo.join(c, todo.folder.eqNullSafe(F.col("_f"))).drop("_f").withColumn("bucket", F.expr("pmod(xxhash64(file), buckets)"))
        steps = cut(spread.groupBy("folder", "bucket").applyInPandas(_plan_bucket(policy), _STEP))
        journals.append(steps.filter("kind = 'txn'").select("txn_id", "level", "folder", "output", "inputs", "n_records", "bytes"))
        end = steps.filter("kind = 'end'").select("folder", F.col("name").alias("file"), F.col("output").alias("final"), "tier", "n_records", "bytes", F.col("mark").alias("final_mark"))
        if first is None:
            first = end
        else:
            moved = end.select(F.col("folder").alias("_f"), F.col("file").alias("_name"), F.col("final").alias("_to"), F.col("final_mark").alias("_mark"))
            joined = first.join(moved, first.folder.eqNullSafe(F.col("_f")) & (first.final == F.col("_name")), "left")
            first = cut(joined.select("folder", "file", F.coalesce("_to", "final").alias("final"), "tier", "n_records", "bytes", F.coalesce("_mark", "final_mark").alias("final_mark")))
        # folders of several buckets go on with what is below the target
        counts = cut(counts.filter("buckets > 1").select("folder", F.greatest(F.lit(1), F.floor(F.col("buckets") / 16)).cast("int").alias("buckets")))
        if counts.isEmpty():
            journal = journals[0]
            for j in journals[1:]:
                journal = journal.unionByName(j)
            return CompactionPlan(files, journal, first)
        g = first.groupBy("folder", F.col("final").alias("file"), F.col("final_mark").alias("mark")).agg(F.sum("n_records").alias("n_records"), F.sum("bytes").alias("bytes"))
        todo = g.filter(F.col("bytes") < policy.target_bytes).select("folder", "file", "n_records", "bytes", "mark")


def plan(members: DataFrame, policy: TierPolicy = TierPolicy()) -> CompactionPlan:
    """The plan of all valid records of a delivered table."""
    return plan_files(cut(catalogue(members)), policy)


def small_files(p: CompactionPlan) -> DataFrame:
    """(folder, file, bytes) of the tier-0 inputs of a plan."""
    return p.assignment.filter("tier = 0").select("folder", "file", "bytes")


def compacted_files(p: CompactionPlan) -> DataFrame:
    """(folder, final, n_files, n_records, bytes) after the compaction."""
    return p.assignment.groupBy("folder", "final").agg(
        F.count("*").alias("n_files"), F.sum("n_records").alias("n_records"), F.sum("bytes").alias("bytes")
    )


def _tar_writer(out_dir: str):
    """Rows sorted by (folder, final, shard, fname, arrived_at) to archives; of a record's deliveries the last is written."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(out_dir)
        key, tar, sink, n, at, held = None, None, None, 0, ("", ""), None

        def put():
            nonlocal n
            if held is not None:
                name = held.fname if held.final == held.shard else f"{held.shard}/{held.fname}"
                data = held.data if held.data is not None else b""
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n += 1

        def close():
            put()
            tar.close()
            sink.close()
            system.move(*at)  # the name appears only when complete
            return (*key, n)

        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if (r.folder, r.final) != key:
                    if key is not None:
                        rows.append(close())
                    key, n, held = (r.folder, r.final), 0, None
                    to = f"{root}/{r.folder if isinstance(r.folder, str) else '_null'}"
                    system.create_dir(to, recursive=True)
                    at = (f"{to}/.{r.final}.{uuid.uuid4().hex}", f"{to}/{r.final}")
                    sink = system.open_output_stream(at[0])
                    tar = tarfile.open(fileobj=sink, mode="w|")
                elif held is not None and (held.shard, held.fname) != (r.shard, r.fname):
                    put()
                held = r
            yield pd.DataFrame(rows, columns=["folder", "final", "written"])
        yield pd.DataFrame([close()] if key is not None else [], columns=["folder", "final", "written"])

    return write


_STATE = "seq bigint, state string, folder string, final string, file string, file_mark string, n_records bigint, bytes bigint, final_mark string"


def _journal(spark: SparkSession, out_dir: str) -> DataFrame:
    try:
        return spark.read.schema(_STATE).parquet(f"{out_dir}/_journal")
    except Exception as e:  # before the first run
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _STATE)


def live_files(spark: SparkSession, out_dir: str) -> DataFrame:
    """(folder, final, file, file_mark, n_records, bytes, final_mark): delivered files inside each live output.

    A run appends ``prepared`` rows before it writes and, by one append, ``live`` rows of its new outputs and ``retired``
    rows of the ones they replace; an output is live when its last word is."""
    rows = _journal(spark, out_dir).filter("state <> 'prepared'")
    last = rows.groupBy("folder", "final").agg(F.max("seq").alias("seq")).select(F.col("folder").alias("_f"), F.col("final").alias("_final"), F.col("seq").alias("_seq"))
    now = rows.join(last, rows.folder.eqNullSafe(F.col("_f")) & (rows.final == F.col("_final")) & (rows.seq == F.col("_seq")))
    return now.filter("state = 'live'").select("folder", "final", "file", "file_mark", "n_records", "bytes", "final_mark")


def _units(files: DataFrame, live: DataFrame) -> DataFrame:
    """(folder, file, file_mark, unit, n_records, bytes): each delivered file and the live output it stands in (or itself)."""
    l = live.select(F.col("folder").alias("_f"), F.col("file").alias("_file"), F.col("final").alias("_unit"))
    j = files.join(l, files.folder.eqNullSafe(F.col("_f")) & (files.file == F.col("_file")), "left")
    return j.select("folder", "file", F.col("mark").alias("file_mark"), F.coalesce("_unit", "file").alias("unit"), "n_records", "bytes")


def _delete(spark: SparkSession, out_dir: str, rows: DataFrame) -> None:
    system, root = file_system(out_dir)
    for r in rows.select("folder", "final").distinct().toLocalIterator():
        path = f"{root}/{r['folder'] if r['folder'] is not None else '_null'}/{r['final']}"
        if system.get_file_info(path).is_file:
            system.delete_file(path)


def compact(spark: SparkSession, members: DataFrame, out_dir: str, policy: TierPolicy = TierPolicy()) -> DataFrame:
    """Bring the archives below ``out_dir`` up to date with ``members``, all that was delivered so far.

    Incremental: the plan starts from the live outputs and the files not yet in one, so what stands is read again only when
    it merges further or when a file in it changed. Safe to run again after a crash at any point: names follow from the
    inputs, archives appear whole, one append commits, and outputs that were prepared or retired but are not live are
    removed. ``out_dir`` must be shared by all executors. Returns the live outputs (folder, final, n_records, bytes)."""
    files = cut(catalogue(members))
    live = cut(live_files(spark, out_dir))
    log = _journal(spark, out_dir)
    seq = (log.agg(F.max("seq")).first()[0] or 0) + 1
    outputs = live.select("folder", "final").distinct()

    def unlike(a, b):
        return a.join(b, a.folder.eqNullSafe(b.folder) & (a.final == b.final), "left_anti")

    _delete(spark, out_dir, unlike(log.select("folder", "final").distinct(), outputs))  # left over from a run that died
    units = cut(_units(files, live))
    # content mark of a unit: that of its own file, or of all files inside
    inside = F.concat_ws("|", F.sort_array(F.collect_list(F.concat_ws(":", "file", "file_mark"))))
    as_files = units.groupBy("folder", F.col("unit").alias("file")).agg(F.sum("n_records").alias("n_records"), F.sum("bytes").alias("bytes"), F.sha2(inside, 256).alias("mark"))
    p = plan_files(cut(as_files), policy)
    a = p.assignment.select(F.col("folder").alias("_f"), F.col("file").alias("_u"), "final", "final_mark")
    placed = cut(units.join(a, units.folder.eqNullSafe(F.col("_f")) & (units.unit == F.col("_u"))).select("folder", "file", "file_mark", "final", "final_mark", "n_records", "bytes"))
    # an output stands when it is live with just these files in just these versions
    have = live.select("folder", "final", "file", "file_mark")
    changed = placed.select("folder", "final", "file", "file_mark").exceptAll(have).select("folder", "final").distinct()
    # a changed file that stays alone keeps its name and is replaced; other changed outputs have new names
    same = lambda x, y: x.folder.eqNullSafe(y.folder) & (x.final == y.final)
    todo = cut(placed.join(changed, same(placed, changed), "left_semi"))
    gone = cut(unlike(outputs, placed.select("folder", "final").distinct()))
    if not (todo.isEmpty() and gone.isEmpty()):
        stamped = todo.withColumns({"seq": F.lit(seq).cast("bigint"), "state": F.lit("prepared")})
        columns = [c.split()[0] for c in _STATE.split(", ")]
        stamped.select(*columns).write.mode("append").parquet(f"{out_dir}/_journal")
        rows = members.select(bare_folder("wds_shards_folder").alias("folder"), "shard", "fname", "arrived_at", "data")
        t = todo.select(F.col("folder").alias("_f"), F.col("file").alias("_file"), "final")
        ready = (
            rows.join(t, rows.folder.eqNullSafe(F.col("_f")) & (rows.shard == F.col("_file"))).select("folder", "final", "shard", "fname", "arrived_at", "data")
            .repartition("folder", "final").sortWithinPartitions("folder", "final", "shard", "fname", "arrived_at")
        )
        written = cut(ready.mapInPandas(_tar_writer(out_dir), "folder string, final string, written bigint"))
        want = todo.groupBy("folder", "final").agg(F.sum("n_records").alias("n"))
        bad = want.join(written, same(want, written) & (written.written == want.n), "left_anti")
        if not bad.isEmpty():
            raise RuntimeError("an output doesn't hold the records planned for it; nothing was committed")
        empty = F.lit(None)
        retired = gone.select(
            F.lit(seq).cast("bigint").alias("seq"), F.lit("retired").alias("state"), "folder", "final", empty.cast("string").alias("file"), empty.cast("string").alias("file_mark"),
            empty.cast("bigint").alias("n_records"), empty.cast("bigint").alias("bytes"), empty.cast("string").alias("final_mark"))
        stamped.withColumn("state", F.lit("live")).select(*columns).unionByName(retired).coalesce(1).write.mode("append").parquet(f"{out_dir}/_journal")
        _delete(spark, out_dir, gone)
    now = live_files(spark, out_dir)
    return now.groupBy("folder", "final").agg(F.sum("n_records").alias("n_records"), F.sum("bytes").alias("bytes"))


__all__ = ["TierPolicy", "CompactionPlan", "catalogue", "compact", "compacted_files", "live_files", "merge_levels", "plan", "plan_files", "small_files"]
