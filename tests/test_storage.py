"""Files, archives, models over the rest, and streams that equal their batch."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pixloom.operators.inference import run_rest
from pixloom.sources import archives, files
from pixloom.streaming import tables as S


def test_archives_keep_every_member(spark, tmp_path):
    rows = [("a", "0.tar", k, f"{k:04}.txt", bytes([k]) * k) for k in range(20)] + [("a", "1.tar", 0, "x.json", None), ("b", "0.tar", 0, "é.jpg", b"")]
    df = spark.createDataFrame(rows, archives.SCHEMA)
    for _ in range(2):  # again: the same archives
        assert {tuple(r) for r in archives.write_archives(df, str(tmp_path)).collect()} == {("a", "0.tar", 20), ("a", "1.tar", 1), ("b", "0.tar", 1)}
    back = {(r["folder"], r["shard"], r["fname"], bytes(r["data"])) for r in archives.read_archives(spark, str(tmp_path)).collect()}
    assert back == {(f, s, n, d or b"") for f, s, _, n, d in rows}
    assert archives.read_archives(spark, str(tmp_path), names_only=True).filter("data IS NOT NULL").count() == 0
    assert archives.read_archives(spark, str(tmp_path / "none")).count() == 0
    assert not [p for p in tmp_path.rglob(".*.tar*")]


def test_text_shards_refuse_gaps(spark, tmp_path):
    keys = spark.createDataFrame([("f", "0.tar", 0, "k1"), ("f", "0.tar", 1, "k2")], "folder string, shard string, pos int, key string")
    texts = spark.createDataFrame([("k1", "one")], "key string, text string")
    with pytest.raises(Exception, match="no text for key k2"):
        archives.write_text_shards(texts, keys, str(tmp_path)).collect()


def test_tables_through_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'tab\there "q"\nline', None), (2, "", "x")], "id long, a string, b string")
    for kind in ("tsv", "csv", "jsonl", "parquet"):
        at = str(tmp_path / f"t.{kind}")
        files.dump(df, at)
        back = {r["id"]: r["a"] or "" for r in files.load(spark, at, "id long, a string, b string").collect()}
        assert back == {1: 'tab\there "q"\nline', 2: ""}, kind
    with pytest.raises(ValueError):
        files.load(spark, "x.abc")
    pd.DataFrame({"a": [1]}).to_pickle(tmp_path / "p.pkl")
    assert files.load(spark, str(tmp_path / "p.pkl")).count() == 1


def test_listing_and_annotations(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("d/keep_1.csv", "d/drop_1.csv", "keep.json", ".hidden.csv"):
        (tmp_path / name).write_text("id,caption\na,one\nb,two\n" if name.endswith("csv") else '{"data": [{"id": "z", "caption": "c"}]}')
    got = files.listing(spark, str(tmp_path), include=["keep"], exclude=[".json"])
    assert [r["path"].rsplit("/", 1)[1] for r in got.collect()] == ["keep_1.csv"]
    assert files.listing(spark, str(tmp_path), include=["keep"], depth=1).count() == 1
    assert [(r["id"], r["caption"]) for r in files.annotations(spark, str(tmp_path / "d/keep_1.csv")).orderBy("ord").collect()] == [("a", "one"), ("b", "two")]
    assert files.annotations(spark, str(tmp_path / "keep.json")).first()["id"] == "z"


def test_models_run_on_what_is_left(spark, tmp_path):
    items = spark.createDataFrame([(k, f"q{k}") for k in range(10)], "id long, q string")
    seen = run_rest(items, lambda pdf: pdf.q.where(pdf.id != 3, "fail"), "id", str(tmp_path / "o"), "fail")
    assert {r["id"]: r["result"] for r in seen.collect()}[3] == "fail"
    asked = run_rest(items, lambda pdf: pdf.q + "!", "id", str(tmp_path / "o"), "fail")
    got = {r["id"]: r["result"] for r in asked.collect()}
    assert got[3] == "q3!" and got[4] == "q4" and len(got) == 10


def test_streams_equal_batches_and_drop_late_rows(spark, tmp_path):
    at = dt.datetime(2025, 1, 1)
    at_minute = lambda m: at + dt.timedelta(minutes=m)
    rows = [(k, at_minute(17 * k % 600), k % 3) for k in range(60)]
    schema = "event_id long, ts timestamp, user_id long"
    folder = str(tmp_path / "events.parquet")
    for part in range(3):
        spark.createDataFrame(rows[part * 20 : part * 20 + 20], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: S.stream_table(spark, str(tmp_path), "events", files_per_batch=1)
    counts = S.drain_complete(S.tumbling(stream(), "ts", "1 hour", "user_id"))
    batch = spark.read.parquet(folder).groupBy(F.window("ts", "1 hour").alias("w"), "user_id").count()
    assert {(r["w"]["start"], r["user_id"], r["n"]) for r in counts.collect()} == {(r["w"]["start"], r["user_id"], r["count"]) for r in batch.collect()}
    assert S.drain(S.first_seen(stream(), ["user_id"], "ts", "365 days")).count() == 3
    # a row days behind the watermark is dropped by an appending window
    spark.createDataFrame([(99, at - dt.timedelta(days=9), 0)], schema).coalesce(1).write.mode("append").parquet(folder)
    late = S.drain(S.tumbling(stream(), "ts", "1 hour", late="1 minute").select("w.start", "n"))
    assert late.filter(F.col("start") < F.lit(at)).count() == 0
