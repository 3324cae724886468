"""A streaming source of one growing file of lines.

Spark's own file stream follows files, not lines, and would miss lines appended to a known file. Offsets
hold the line and the byte where the next batch starts, so a batch reads only what is new.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, InputPartition, SimpleDataSourceStreamReader

from tessera.sources.files import read_from, size


class GrowingLines(DataSource):
    """``path``; options ``startLine`` and ``maxLinesPerBatch`` (0: all there are)."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "line_no long, value string"

    def simpleStreamReader(self, schema) -> "LineReader":
        return LineReader(self.options["path"], int(self.options.get("maxLinesPerBatch", 0)), int(self.options.get("startLine", 0)))


class LineReader(SimpleDataSourceStreamReader):
    #: Bytes looked at in one batch at most; the next batch takes up where it ends.
    MOST = 64 << 20
    #: Bytes read at once.
    STEP = 4 << 20

    def __init__(self, path: str, most: int, start: int):
        self.path, self.most, self.start = path, most, start

    def initialOffset(self) -> dict:
        return {"line": 0, "byte": 0}

    def _lines(self, start: dict, end: int) -> tuple[list[bytes], int]:
        """Complete lines from a byte on, and the byte after the last of them."""
        raw = read_from(self.path, start["byte"], end) if end > start["byte"] else b""
        whole = raw[: raw.rfind(b"\n") + 1]
        return whole.split(b"\n")[:-1], start["byte"] + len(whole)

    def read(self, start: dict):
        end, at, lines, rest = size(self.path), start["byte"], [], []
        while at < end and not (lines and (at - start["byte"] >= self.MOST or 0 < self.most <= len(lines))):  # a line may be longer than the limit
            raw = read_from(self.path, at, min(end, at + self.STEP))
            if not raw:
                break
            at += len(raw)
            cut = raw.rfind(b"\n")
            if cut < 0:
                rest.append(raw)
                continue
            lines += b"".join([*rest, raw[:cut]]).split(b"\n")
            rest = [raw[cut + 1 :]]
        if self.most:
            lines = lines[: self.most]
        after = start["byte"] + sum(map(len, lines)) + len(lines)
        return iter(self._rows(start["line"], lines)), {"line": start["line"] + len(lines), "byte": after}

    def readBetweenOffsets(self, start: dict, end: dict):
        lines, _ = self._lines(start, end["byte"])
        return iter(self._rows(start["line"], lines))

    def _rows(self, first: int, lines: list[bytes]) -> list[tuple[int, str]]:
        return [(first + i, x.decode("utf-8", "replace")) for i, x in enumerate(lines) if first + i >= self.start]

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GrowingLines)


def _batches(spark: SparkSession, checkpoint: str) -> int:
    """The batches that a stream has committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return max((int(f.getPath().getName()) + 1 for f in found or [] if f.getPath().getName().isdigit()), default=0)


def drain(lines: Callable[[], DataFrame], out: str, checkpoint: str) -> int:
    """Write a stream of a growing file to Parquet until it has nothing new; returns the batches run.

    Spark takes one batch of such a source for all there is now, so the query goes on, without a trigger that
    ends it, until a look finds nothing.
    """
    rows = lines()
    before = _batches(rows.sparkSession, checkpoint)
    query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start(out)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _batches(rows.sparkSession, checkpoint) - before
