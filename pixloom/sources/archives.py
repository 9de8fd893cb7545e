"""Archives as tables and tables as archives, on any file system that pyarrow and Spark both know.

Reading: a Python data source whose partitions are the archive files; members are yielded one by one,
so an archive needs no more memory than its largest member. Writing: rows are brought together by
(folder, shard), sorted, and each archive appears under its name only when it is complete.
"""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "folder string, shard string, pos int, fname string, data binary"


def file_system(uri: str):
    """(file system, path) of a URI or a local path."""
    import pyarrow.fs as fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def list_archives(uri: str, suffix: str = ".tar", recursive: bool = True) -> list[str]:
    """Paths below ``uri`` with the suffix, hidden files and folders left out."""
    import pyarrow.fs as fs

    system, path = file_system(uri)
    found = system.get_file_info(fs.FileSelector(path, recursive=recursive, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(suffix) and not any(p.startswith((".", "_")) for p in f.path[len(path):].split("/")))


class _Part(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.per_task = options["path"], int(options.get("filespertask", 16))
        self.names_only = options.get("namesonly", "false") == "true"

    def partitions(self):
        paths = list_archives(self.uri)
        return [_Part(paths[i : i + self.per_task]) for i in range(0, len(paths), self.per_task)] or [_Part([])]

    def read(self, partition: _Part) -> Iterator[tuple]:
        system, _ = file_system(self.uri)
        for path in partition.paths:
            folder, shard = (["", *path.split("/")])[-2:]
            with system.open_input_stream(path) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
                for pos, m in enumerate(x for x in tar if x.isfile()):
                    data = None if self.names_only else tar.extractfile(m).read()
                    yield folder, shard, pos, m.name, data


class ArchiveSource(DataSource):
    """``spark.read.format("archives").load(uri)``; option ``namesOnly`` leaves the content out."""

    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, uri: str, names_only: bool = False) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archives").option("namesOnly", str(names_only).lower()).load(uri)


def write_archives(members: DataFrame, uri: str) -> DataFrame:
    """Write ``members(folder, shard, pos, fname, data)``, one archive a (folder, shard); returns (folder, shard, written).

    The result must be run (it does the writing); running it again replaces each archive by the same one."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as fs

        system, root = file_system(uri)
        key, tar, sink, n, at = None, None, None, 0, ("", "")

        def close():
            tar.close()
            sink.close()
            system.move(*at)
            return (*key, n)

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if (r.folder, r.shard) != key:
                    if key is not None:
                        out.append(close())
                    key, n = (r.folder, r.shard), 0
                    to = f"{root}/{r.folder}" if isinstance(r.folder, str) else f"{root}/_null"
                    system.create_dir(to, recursive=True)
                    at = (f"{to}/.{r.shard}.{uuid.uuid4().hex}", f"{to}/{r.shard}")
                    sink = system.open_output_stream(at[0])
                    tar = tarfile.open(fileobj=sink, mode="w|")
                data = r.data if r.data is not None else b""
                info = tarfile.TarInfo(r.fname)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n += 1
            yield pd.DataFrame(out, columns=["folder", "shard", "written"])
        yield pd.DataFrame([close()] if key is not None else [], columns=["folder", "shard", "written"])
        del fs

    placed = members.select("folder", "shard", "pos", "fname", "data").repartition("folder", "shard").sortWithinPartitions("folder", "shard", "pos", "fname")
    return placed.mapInPandas(write, "folder string, shard string, written bigint")


def write_text_shards(captions: DataFrame, keys: DataFrame, uri: str) -> DataFrame:
    """Texts by key as one archive of ``.txt`` members a shard; a key without a text is an error, not a gap.

    ``captions(key, text)`` and ``keys(folder, shard, pos, key)``."""
    j = keys.join(captions, "key", "left")
    text = F.when(F.col("text").isNull(), F.raise_error(F.concat(F.lit("no text for key "), F.col("key")))).otherwise(F.col("text"))
    return write_archives(j.select("folder", "shard", "pos", F.concat("key", F.lit(".txt")).alias("fname"), F.encode(text, "UTF-8").alias("data")), uri)
