"""File access of the Python sources and of file sinks, by path or URI, through Arrow's file systems."""

from __future__ import annotations

from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def exists(path: str) -> bool:
    system, p = open_path(path)
    return system.get_file_info(p).type != fs.FileType.NotFound


def size(path: str) -> int:
    system, p = open_path(path)
    info = system.get_file_info(p)
    return info.size if info.type == fs.FileType.File else 0


def read_from(path: str, start: int, end: int) -> bytes:
    system, p = open_path(path)
    with system.open_input_file(p) as f:
        f.seek(start)
        return f.read(end - start)


def join_parts(spark: SparkSession, folder: str, file: str) -> None:
    """Append a folder's part files to a new file, in the order of their names, each deleted once it is copied.

    One file has one writer: the driver copies, 1 MB at a time, whatever the file system.
    """
    to, io = spark._jvm.org.apache.hadoop.fs.Path(file), spark._jvm.org.apache.hadoop.io.IOUtils
    system = to.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*"))), key=lambda p: p.getName())
    out = system.create(to, True)
    try:
        for part in parts:
            read = system.open(part)
            try:
                io.copyBytes(read, out, 1 << 20, False)
            finally:
                read.close()
            system.delete(part, False)
    finally:
        out.close()


#: Files in a numbered folder, about; a task reads one folder, and writes five times as many files at most.
PER_FOLDER = 2000


def save_each(rows: DataFrame, folder: str, suffix: str, key: str = "id", content: str = "page", spread: bool = False) -> DataFrame:
    """Write one file per row, named by the percent-encoded key; returns key and bytes of each file written.

    Rows whose key is null, or whose content is null or empty, give no file. The folder must be shared with
    the executors. A task that runs again overwrites its own files, so the files follow from the rows alone.
    The files are written when the result is read. With ``spread``, which is for many rows, the rows with a key are counted
    and their files lie in folders inside, about ``PER_FOLDER`` in each. Where a task has over five times as many rows, all
    are dealt by their keys, so that each writes one folder; else their contents are not moved.
    """

    def run(batches):
        system, p = open_path(folder)
        made = set()
        for b in batches:
            sizes = []
            for k, raw, inside in zip(*(c.to_pylist() for c in b.columns)):
                at = p if inside is None else f"{p}/{inside}"
                if at not in made:
                    system.create_dir(at, recursive=True)
                    made.add(at)
                with system.open_output_stream(f"{at}/{quote(k, safe='')}{suffix}") as f:
                    f.write(raw)
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["key", "bytes"])

    named = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(content).cast("binary").alias("raw"))
    inside = F.lit(None).cast("int")
    if spread:
        total, most = named.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
        n = max(1, -(-(total or 0) // PER_FOLDER))
        if (most or 0) > 5 * PER_FOLDER:
            named = named.repartition(n, "key")
        inside = F.pmod(F.hash("key"), F.lit(n))  # after that, the partition's number
    some = named.select("key", "raw", inside.alias("inside")).where("octet_length(raw) > 0")
    return some.mapInArrow(run, "key string, bytes long")


def read_each(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """key and raw bytes of the files that ``save_each`` spread in a folder, a task for each folder inside; none if there is no such folder."""
    system, p = open_path(folder)
    inside = sorted(int(i.base_name) for i in system.get_file_info(fs.FileSelector(p, allow_not_found=True)) if i.type == fs.FileType.Directory and i.base_name.isdigit())

    def run(batches):
        system, p = open_path(folder)
        for b in batches:
            for i in b.column(0).to_pylist():
                names = [x.path for x in system.get_file_info(fs.FileSelector(f"{p}/{inside[i]}")) if x.base_name.endswith(suffix)]
                for start in range(0, len(names), 64):
                    part, raw = names[start : start + 64], []
                    for name in part:
                        with system.open_input_stream(name) as f:
                            raw.append(f.read())
                    keys = [unquote(name.rpartition("/")[2][: len(name.rpartition("/")[2]) - len(suffix)]) for name in part]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(raw, pa.binary())], names=["key", "raw"])

    return spark.range(0, len(inside), 1, max(1, len(inside))).mapInArrow(run, "key string, raw binary")
