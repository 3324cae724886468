"""Search: predicates, order, pages and totals over a table of decisions."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import day_of
from tessera.functions.text import has_words
from tessera.session import materialize

#: What the sort codes order by.
SORT_CODES = {1: "case_order", 2: "decision_order", 3: "decided"}
MAX_PAGE = 100


def keyword_predicate(text: Column, all_of: list[str] = (), any_of: list[str] = (), none_of: list[str] = (), not_all_of: list[str] = ()) -> Column:
    """AND, OR and NOT lists of whole words, whatever their case; ``not_all_of`` drops texts that hold all of its words."""
    tests = []
    if all_of:
        tests.append(has_words(text, list(all_of)))
    if any_of:
        tests.append(has_words(text, list(any_of), "any"))
    if none_of:
        tests.append(~has_words(text, list(none_of), "any"))
    if not_all_of:
        tests.append(~has_words(text, list(not_all_of)))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def criteria_predicate(require: bool = False, **criteria) -> Column:
    """Structured search: only criteria that are set (not None, 0 or '') become predicates.

    Known: chamber, case_year, decision_year, case_from, case_to, decision_from, decision_to, from_day,
    to_day (``dd.MM.yyyy``), statute_no, statute_name, article. With ``require`` an empty search is refused.
    """
    given = {k: v for k, v in criteria.items() if v}
    if require and not given:
        raise ValueError("a search needs at least one criterion")
    day = lambda v: day_of(F.lit(v))
    known = {
        "chamber": lambda v: F.col("chamber") == v,
        "case_year": lambda v: F.col("case_year") == int(v),
        "decision_year": lambda v: F.col("decision_year") == int(v),
        "case_from": lambda v: F.col("case_no") >= int(v),
        "case_to": lambda v: F.col("case_no") <= int(v),
        "decision_from": lambda v: F.col("decision_no") >= int(v),
        "decision_to": lambda v: F.col("decision_no") <= int(v),
        "from_day": lambda v: F.col("decided") >= day(v),
        "to_day": lambda v: F.col("decided") <= day(v),
        "statute_no": lambda v: F.col("statute_no") == str(v),
        "statute_name": lambda v: F.col("statute_name").contains(v),
        "article": lambda v: F.col("article") == str(v),
    }
    if unknown := given.keys() - known.keys():
        raise ValueError(f"unknown criteria: {sorted(unknown)}")
    return reduce(lambda a, b: a & b, [known[k](v) for k, v in given.items()], F.lit(True))


def ordered(df: DataFrame, code: int = 3, direction: str = "desc", tie: str = "id") -> DataFrame:
    """Order by a sort code; rows that tie are ordered by ``tie``."""
    col = F.col(SORT_CODES[code])
    return df.orderBy(col.asc() if direction == "asc" else col.desc(), F.col(tie))


def ranked(rows: DataFrame, name: str = "rank") -> DataFrame:
    """Rows of an ordered frame with their place, counted from 1.

    The order is written once, with each row's partition and place in it; only the partitions' sizes reach the driver.
    """
    at = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    sizes = sorted(at.groupBy(part.alias("part")).count().collect())
    before = dict(zip((r["part"] for r in sizes), accumulate((r["count"] for r in sizes), initial=0)))
    offset = F.get(F.array(*map(F.lit, (before.get(i, 0) for i in range(max(before, default=0) + 1)))), part.cast("int"))
    return at.withColumn(name, offset.cast("long") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at")


def page(df: DataFrame, number: int, size: int = 50) -> DataFrame:
    """One page of an ordered frame, numbered from 1; sizes over the maximum are cut to it."""
    size = max(1, min(size, MAX_PAGE))
    return df.offset((number - 1) * size).limit(size)


def page_numbers(total: Column, size: int) -> Column:
    """1 .. the last page that holds a row; an empty array without rows."""
    last = F.ceil(total / size).cast("int")
    return F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def totals(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows in all, and rows that the predicate keeps, in one pass."""
    return df.agg(F.count("*").alias("records_total"), F.count_if(predicate).alias("records_filtered"))


def preview(df: DataFrame, predicate: Column, most: int = 3, code: int = 3, direction: str = "desc") -> DataFrame:
    """The first rows of a search, each with records_total, the number of rows found; nothing is written.

    A search that finds nothing gives one row of nulls with the total 0.
    """
    found = df.where(predicate)
    total = found.agg(F.count("*").alias("records_total"))
    return total.join(F.broadcast(page(ordered(found, code, direction), 1, most)), F.lit(True), "left").select(*df.columns, "records_total")
