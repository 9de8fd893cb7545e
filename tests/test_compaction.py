"""Compaction: each valid record stands in exactly one file, whatever arrives late and wherever a run dies."""

import datetime as dt
import tarfile
from collections import Counter
from pathlib import Path

import pytest

from pixloom.operators import compaction as K

SCHEMA = "wds_shards_folder string, shard string, pos int, fname string, data binary, arrived_at timestamp"
POLICY = K.TierPolicy(small_bytes=2_000, fan_in=8, target_bytes=20_000)


def day(d):
    return dt.datetime(2025, 1, d)


def stored(out: Path) -> Counter:
    found = Counter()
    for path in out.glob("*/*.tar"):
        if path.parent.name == "_journal":
            continue
        with tarfile.open(path) as tar:
            for m in tar:
                shard, _, name = m.name.rpartition("/")
                found[(path.parent.name, shard or path.name, name, tar.extractfile(m).read())] += 1
    return found


def valid(rows) -> Counter:
    last = {}
    for f, s, _, n, d, _ in sorted(rows, key=lambda r: r[5]):
        parts = [p for p in (f or "").split("/") if p.strip()]
        last[(parts[-1] if parts else "_null", s, n)] = d or b""
    return Counter((f, s, n, d) for (f, s, n), d in last.items())


def delivered():
    rows = [(f"/in/{f}/", f"{s:03}.tar", 0, "same.txt", bytes([65 + s % 20]) * 300, day(1)) for f in ("a", "b") for s in range(50)]
    return [*rows, ("/in/a", "big.tar", 0, "big.txt", b"x" * 25_000, day(1)), (None, "n.tar", 0, "n.txt", None, day(1))]


def test_late_rows(spark, tmp_path):
    rows = delivered()
    late = [
        ("a/", "big.tar", 1, "more.txt", b"late", day(3)),  # another record of a file that stands alone
        ("a", "001.tar", 0, "same.txt", b"y" * 300, day(3)),  # same size, other content
        ("a", "002.tar", 1, "empty.txt", None, day(3)),  # a new member without content
        ("a", "003.tar", 0, "same.txt", b"old", day(0 + 1) - dt.timedelta(days=1)),  # older than what stands
        *[("b", f"9{k}.tar", 0, f"n{k}.txt", b"n" * 900, day(3)) for k in range(50)],  # new files
    ]
    before = None
    for given in (rows, rows, rows + late, rows + late):
        live = K.compact(spark, spark.createDataFrame(given, SCHEMA), str(tmp_path), POLICY).collect()
        assert stored(tmp_path) == valid(given)
        assert sum(r["n_records"] for r in live) == sum(valid(given).values())
        assert all(r["bytes"] <= POLICY.target_bytes or r["final"] == "big.tar" for r in live)
        now = {p: p.stat().st_mtime_ns for p in tmp_path.glob("*/*.tar")}
        if given is not rows and before and len(before) == len(now) and given == last:
            assert now == before  # nothing new, nothing written
        before, last = now, given
    # what was not touched by late rows was not written again
    assert len(before) < 20


@pytest.mark.parametrize("at", ["written", "committed"])
def test_runs_that_die(spark, tmp_path, monkeypatch, at):
    rows = delivered()
    df = spark.createDataFrame(rows, SCHEMA)
    K.compact(spark, df, str(tmp_path), POLICY)
    more = rows + [("b", f"8{k}.tar", 0, f"n{k}.txt", b"n" * 500, day(2)) for k in range(9)]
    real = K.cut if at == "written" else K._delete
    calls = []

    def dies(*args):
        calls.append(1)
        out = real(*args)
        if at == "written" and "written" in args[0].columns:
            raise KeyboardInterrupt
        if at == "committed" and len(calls) == 2:
            raise KeyboardInterrupt
        return out

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(K, "cut" if at == "written" else "_delete", dies)
        K.compact(spark, spark.createDataFrame(more, SCHEMA), str(tmp_path), POLICY)
    # other rows than at the time of the crash: nothing of the dead run may stay
    more.append(("b", "7.tar", 0, "z.txt", b"z" * 700, day(3)))
    K.compact(spark, spark.createDataFrame(more, SCHEMA), str(tmp_path), POLICY)
    assert stored(tmp_path) == valid(more)


def test_levels_and_targets():
    units = [K._Unit(f"f{k}", 1, 100 + k, "m", [f"f{k}"]) for k in range(500)] + [K._Unit("big", 1, 30_000, "m", ["big"]), K._Unit("mid", 1, 9_000, "m", ["mid"])]
    last, txns = K.merge_levels(units, "a", POLICY)
    assert sorted(p for u in last for p in u.parts) == sorted(u.name for u in units)
    assert sum(u.size for u in last) == sum(u.size for u in units)
    assert all(u.size <= POLICY.target_bytes or u.name == "big" for u in last)
    assert len(last) <= 2 * (sum(u.size for u in units) // POLICY.target_bytes + 1)
    assert {level for level, _, _ in txns} <= set(range(POLICY.levels))
    again, _ = K.merge_levels(list(reversed(units)), "a", POLICY)
    assert {u.name for u in again} == {u.name for u in last}


def test_a_folder_of_many_buckets(spark):
    rows = [("a", f"f{k}", 1, 100, f"m{k}") for k in range(300)] + [(None, "x", 1, 5, "m"), (None, "y", 1, 5, "m")]
    files = spark.createDataFrame(rows, "folder string, file string, n_records long, bytes long, mark string")
    p = K.plan_files(files, K.TierPolicy(2_000, 8, 20_000, bucket_files=20))
    got = K.compacted_files(p).collect()
    assert sum(r["n_records"] for r in got) == 302 and all(r["bytes"] <= 20_000 for r in got)
    assert len(got) <= 5
    made = {r["output"] for r in p.journal.collect()}
    assert {r["final"] for r in got} <= made
    empty = K.plan_files(files.limit(0))
    assert empty.assignment.count() == 0 and empty.journal.count() == 0
