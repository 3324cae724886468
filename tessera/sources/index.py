"""Batch reads of index lines, texts by file name, and settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.schemas import INDEX_ROW
from tessera.sources.files import exists, read_each


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of JSON lines; malformed lines have only ``_corrupt_record``. A missing path is an empty index."""
    reader = spark.read.schema(INDEX_ROW).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.json(path) if exists(path) else spark.createDataFrame([], INDEX_ROW)


def parse_lines(lines: DataFrame) -> DataFrame:
    """line_no and index fields of text lines; malformed JSON leaves the line in ``_corrupt_record``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return lines.select("line_no", F.from_json("value", INDEX_ROW, options).alias("_r")).select("line_no", "_r.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no (from 0, in the order of file names, then of lines) and value of text lines.

    A line's place is its place in its block of a file, plus the lines of all blocks before; only the
    counts of blocks are put in order in one task, one row for each block that the scan reads, and sent to
    every task, so that no line is moved. The files must not change between the two scans.
    """
    at = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_id")
    )
    blocks = at.groupBy("_file", "_from").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_file", "_from").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    return at.join(F.broadcast(placed), ["_file", "_from"]).select((F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), F.make_valid_utf8("value").alias("value"))


def read_texts(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """id (the file's name without .txt) and text of whole files; invalid UTF-8 becomes U+FFFD. ``spread``: as ``save_each`` spread them."""
    if spread:
        return read_each(spark, path, ".txt").select(F.col("key").alias("id"), F.make_valid_utf8(F.col("raw").cast("string")).alias("text"))
    files = spark.read.text(path, wholetext=True)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return files.select(F.regexp_replace(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), r"\.txt$", "").alias("id"), F.make_valid_utf8("value").alias("text"))


def read_offset(value: str | None) -> int:
    """A stored line offset; missing or unreadable ones are 0."""
    try:
        return int((value or "").strip() or 0)
    except ValueError:
        return 0


def append_index(rows: DataFrame, path: str) -> None:
    """Append rows as JSON lines, characters outside ASCII kept as they are."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def append_meta(rows: DataFrame, path: str) -> None:
    rows.select("ts", "id", "crawl_desc").write.mode("append").json(path)
