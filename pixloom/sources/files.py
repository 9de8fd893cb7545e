"""Tables in and out of common file formats, dispatched by suffix."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixloom.sources.archives import file_system

TEXT = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def load(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """parquet, json (one document), jsonl, csv, tsv, or pkl/xlsx through pandas (small files, on the driver)."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "parquet":
        return reader.parquet(path)
    if kind == "json":
        return reader.option("multiLine", True).json(path)
    if kind == "jsonl":
        return reader.json(path)
    if kind in ("csv", "tsv"):
        return reader.options(sep="\t" if kind == "tsv" else ",", **TEXT).csv(path)
    if kind in ("pkl", "xlsx"):
        import pandas as pd

        return spark.createDataFrame(pd.read_pickle(path) if kind == "pkl" else pd.read_excel(path))
    raise ValueError(f"no reader for .{kind}")


def dump(df: DataFrame, path: str, single: bool = False) -> None:
    """The inverse of ``load`` for parquet, jsonl, csv and tsv folders; texts are always quoted."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    out = (df.coalesce(1) if single else df).write.mode("overwrite")
    if kind == "parquet":
        out.parquet(path)
    elif kind == "jsonl":
        out.json(path)
    elif kind in ("csv", "tsv"):
        out.options(sep="\t" if kind == "tsv" else ",", header=True, quoteAll=True, escape='"').csv(path)
    else:
        raise ValueError(f"no writer for .{kind}")


def write_sidecar(arguments: dict, path: str) -> None:
    """Arguments of a run beside its output, keys sorted."""
    system, at = file_system(path)
    with system.open_output_stream(at) as f:
        f.write(json.dumps(arguments, sort_keys=True, indent=2, default=str).encode())


def listing(spark: SparkSession, folder: str, include: list[str] = (), exclude: list[str] = (), depth: int | None = None) -> DataFrame:
    """(path, bytes) of the files below ``folder`` whose name holds each of ``include`` and none of ``exclude``; hidden ones are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.col("length").alias("bytes"))
    name = F.substring_index("path", "/", -1)
    inside = F.substring_index("path", folder.rstrip("/") + "/", -1)
    keep = ~name.startswith(".")
    for word in include:
        keep = keep & F.contains(name, F.lit(word))
    for word in exclude:
        keep = keep & ~F.contains(name, F.lit(word))
    if depth is not None:
        keep = keep & (F.size(F.split(inside, "/")) <= depth)
    return files.filter(keep)


def verified(spark: SparkSession, path: str, digests: DataFrame) -> DataFrame:
    """(name, ok): files below ``path`` against ``digests(name, md5)``."""
    have = spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("name"), F.md5("content").alias("have"))
    return digests.join(have, "name", "left").select("name", (F.col("have") == F.col("md5")).alias("ok")).fillna(False, subset=["ok"])


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """(ord, id, caption): a csv's first two columns, or the ``data`` list of a json document, in file order."""
    if path.endswith(".json"):
        doc = spark.read.schema("data array<struct<id:string,caption:string>>").option("multiLine", True).json(path)
        return doc.select(F.posexplode("data").alias("ord", "x")).select(F.col("ord").cast("bigint").alias("ord"), "x.id", "x.caption")
    rows = spark.read.options(**TEXT).csv(path)
    a, b = rows.columns[:2]
    return rows.select(F.monotonically_increasing_id().alias("ord"), F.col(a).alias("id"), F.col(b).alias("caption"))
