"""Resumable work: what is done already, what has its text, and what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def known_ids(index: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of an index, as text; rows without an id are left out."""
    return index.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()


def not_yet_done(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is not done."""
    return rows.join(done.select(key), key, "left_anti").select(*rows.columns)


def first_of_each(rows: DataFrame, key: str | list[str], order: list) -> DataFrame:
    """The first row of each key in the given order.

    Ranks are limited before the shuffle too, so a key with very many rows sends one row per task.
    """
    keys = [key] if isinstance(key, str) else key
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def new_rows(rows: DataFrame, done: DataFrame, key: str, order: list, limit: int = 0) -> DataFrame:
    """New ids only, each once, and of those the first ``limit`` in order (0: all)."""
    fresh = first_of_each(not_yet_done(rows, done, key), key, order)
    return fresh.orderBy(*order).limit(limit) if limit else fresh


def with_text(rows: DataFrame, texts: DataFrame, key: str = "id") -> DataFrame:
    """Rows that have a text, with it."""
    return rows.join(texts, key)


def saved_rows(rows: DataFrame, texts: DataFrame, full_text: bool = True, key: str = "id") -> DataFrame:
    """Rows with their text, null where it is missing; without ``full_text`` the texts are never read, and text is null for all."""
    if not full_text:
        return rows.withColumn("text", F.lit(None).cast("string"))
    return rows.join(texts.select(key, "text"), key, "left")


def run_counters(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """One row: ``saved``, the ids that this run adds, and ``total_done``, the ids known after it."""
    both = rows.select(F.col(key).cast("string").alias(key), F.lit(0).alias("known")).unionByName(done.select(F.col(key).cast("string").alias(key), F.lit(1).alias("known")))
    ids = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("known").alias("known"))
    return ids.agg(F.count_if(F.col("known") == 0).alias("saved"), F.count("*").alias("total_done"))


def missing_text(rows: DataFrame, texts: DataFrame, key: str = "id") -> DataFrame:
    """Rows that wait for their text; they stay pending and are joined again by the next run."""
    return rows.join(texts.select(key), key, "left_anti")


def fetched(index: DataFrame, pages: DataFrame, key: str = "id") -> DataFrame:
    """Point lookup of each row's page; a page that is missing is empty."""
    return index.join(pages, key, "left").withColumn("html", F.coalesce("html", F.lit("")))


def lines_window(lines: DataFrame, start: int, most: int = 0) -> DataFrame:
    """Index lines from ``start`` on: blank ones dropped; at most ``most`` physical lines (0: all).

    As the cap is looked at after lines that are not blank only, a window that ends in blank lines takes
    one more line that is not blank.
    """
    rows = lines.where((F.col("line_no") >= start) & (F.trim("value") != ""))
    if not most:
        return rows
    inside = rows.where(F.col("line_no") < start + most)
    reached = inside.agg(F.max("line_no").alias("last"))
    after = rows.where(F.col("line_no") >= start + most).agg(F.min("line_no").alias("next"))
    edge = reached.crossJoin(after).select(F.when(F.coalesce(F.col("last"), F.lit(-1)) >= start + most - 1, F.col("last")).otherwise(F.coalesce("next", "last")).alias("edge"))
    return rows.join(F.broadcast(edge), F.col("line_no") <= F.col("edge"), "left_semi")
