"""A batch source of recorded search pages: one partition per block of pages.

Pages are files ``page-<number>.json`` in a folder, or what ``write_pages`` wrote there, each a response envelope. Simple comparisons are
taken as filters and tested where the pages are read. An error envelope fails the read and names its
page, whatever the blocks are; with ``until``, that number, the pages before it are read.
"""

from __future__ import annotations

import json
import re

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual

from tessera.functions.text import CHALLENGES
from tessera.sources.files import open_path

FIELDS = ("id", "daireKurul", "esasNo", "kararNo", "kararTarihi", "arananKelime")


#: A page's file: ``page-7.json``, or a part in the folder ``page=7``.
_PAGE = re.compile(r"page-(\d+)\.json$|page=(\d+)/part-[^/]*$")


def _number(name: str) -> int:
    found = _PAGE.search(name)
    return int(found[1] or found[2])


class RefusedError(RuntimeError):
    """The recorded server asked for a captcha: stop, and resume later."""


class PageError(RuntimeError):
    """A page holds an error envelope: nothing may pass for the end of the results."""


class PagedSearch(DataSource):
    """``path``; options ``pagesPerPartition`` (default 8) and ``until`` (the first page not to be read)."""

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return ", ".join(f"{f} string" for f in FIELDS)

    def reader(self, schema) -> "PagedReader":
        return PagedReader(self.options["path"], int(self.options.get("pagesPerPartition", 8)), int(self.options.get("until", 0)))


class Block(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)


class PagedReader(DataSourceReader):
    def __init__(self, path: str, per: int, until: int = 0):
        self.path, self.per, self.until, self.equal, self.bounds = path, per, until, {}, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1:
                self.equal[f.attribute[0]] = f.value
            elif isinstance(f, (GreaterThanOrEqual, LessThanOrEqual)) and len(f.attribute) == 1:
                self.bounds.append((f.attribute[0], isinstance(f, GreaterThanOrEqual), f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, p = open_path(self.path)
        names = sorted((i.path for i in system.get_file_info(fs.FileSelector(p, recursive=True)) if _PAGE.search(i.path)), key=_number)
        names = [n for n in names if not self.until or _number(n) < self.until]
        return [Block(names[i : i + self.per]) for i in range(0, len(names), self.per)] or [Block([])]

    def _keeps(self, row: dict) -> bool:
        if any(row.get(k) != v for k, v in self.equal.items()):
            return False
        return all(row.get(k) is not None and (row[k] >= v if low else row[k] <= v) for k, low, v in self.bounds)

    def read(self, partition: Block):
        system, _ = open_path(self.path)
        for name in partition.value:
            with system.open_input_stream(name) as f:
                payload = json.loads(f.read().decode("utf-8", "replace"))
            meta = payload.get("metadata") or {}
            if meta.get("FMTY") == "ERROR":
                message = meta.get("FMTE") or ""
                if any(c in message for c in CHALLENGES):
                    raise RefusedError(f"page {_number(name)}: {message}")
                raise PageError(f"page {_number(name)}: {message}")
            for row in (payload.get("data") or {}).get("data") or []:
                row = {k: None if row.get(k) is None else str(row[k]) for k in FIELDS}
                if self._keeps(row):
                    yield tuple(row[k] for k in FIELDS)


def write_pages(rows: DataFrame, order: str, path: str, per: int = 50) -> None:
    """Record rows as pages of ``per`` rows, by ``order``, a row number from 0; a page holds what the server would send."""
    fields = [F.col(c).cast("string").alias(c) for c in FIELDS if c in rows.columns]
    numbered = rows.select((F.floor(F.col(order) / per) + 1).alias("page"), F.struct(F.col(order).alias("at"), F.struct(*fields).alias("row")).alias("r"))
    total = rows.count()
    pages = numbered.groupBy("page").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["row"]).alias("data"))
    envelope = F.struct(F.struct(F.lit("SUCCESS").alias("FMTY")).alias("metadata"), F.struct("data", F.lit(total).alias("recordsTotal"), F.lit(total).alias("recordsFiltered")).alias("data"))
    pages.select("page", F.to_json(envelope).alias("value")).write.partitionBy("page").text(path)


def register(spark: SparkSession) -> None:
    """Register the source; Spark hands filters to Python sources only if the session says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSearch)
