"""Status: counters and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcome_counts(rows: DataFrame, outcome: str = "outcome") -> DataFrame:
    return rows.groupBy(outcome).agg(F.count("*").alias("n"))


def last_lines(log: DataFrame, n: int = 2, pattern: str | None = None) -> DataFrame:
    """The last ``n`` lines, of those that match the pattern; log has line_no and value."""
    rows = log.where(F.col("value").rlike(pattern)) if pattern else log
    return rows.orderBy(F.col("line_no").desc()).limit(n)


def summary(index: DataFrame, texts: DataFrame) -> DataFrame:
    """Index rows, distinct ids, and texts, in one row."""
    a = index.agg(F.count("*").alias("index_rows"), F.countDistinct("id").alias("index_ids"))
    return a.crossJoin(texts.agg(F.count("*").alias("text_files")))
