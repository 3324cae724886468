"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The places of all shards are cut into blocks of bounded size. How many rows each input partition sends
to each block follows the multivariate hypergeometric law, so the matrix of counts has exact row and
column sums. Each partition assigns its rows to blocks by a local random permutation, the rows are
exchanged by block, and each block permutes its rows again: every order of the rows is equally likely.

No one holds the matrix: a partition draws its own row by walking a binary tree over the partitions, in
which each node splits its places between its two halves with a generator seeded by the node. Only
the row counts of the partitions are gathered. Python sees the places of rows, never the rows.

Law ``rows``: shard sizes differ by at most one row. Every row counts for itself: repeated rows and
rows of equal text (the groups) are spread like any others, null ids and texts included; an empty
table gives no rows; all columns are kept by ``shuffle_rows`` under their names, but for one called shard
or slot, which gets a trailing underscore; texts of any length are only moved. A block holds about
``BLOCK_ROWS`` rows whatever their keys, so hot keys make no difference.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shingles import mix

SHARDS = 8
BLOCK_ROWS = 1024
MAX_BLOCKS = 65_536
#: Bits of ``monotonically_increasing_id`` below the partition's number.
_ROW_BITS = 33
#: numpy's hypergeometric draws take populations below this.
_NUMPY_MOST = 10**9


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    if good + bad < _NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, n))
    # Inverse transform over the mode and 40 standard deviations around it; the rest is below 1e-300.
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    sd = math.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1))) + 1
    a, b = max(low, int(mode - 40 * sd)), min(high, int(mode + 40 * sd))
    k = np.arange(a, b, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.append(0.0, np.cumsum(steps))
    weights = np.exp(logs - logs.max())
    return a + int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum()))


def matrix_row(counts: list[int], places: np.ndarray, p: int, seed: int) -> np.ndarray:
    """Rows that partition ``p`` sends to each block; all partitions' rows sum to ``places``."""
    before = np.append(0, np.cumsum(counts)).tolist()
    low, high = 0, len(counts)
    here = np.array(places, dtype=np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        draws, population = before[middle] - before[low], before[high] - before[low]
        rng, left = np.random.default_rng([seed, low, high]), np.zeros_like(here)
        for b, good in enumerate(here.tolist()):
            left[b] = _hypergeometric(rng, good, population - good, draws)
            draws, population = draws - int(left[b]), population - good
        here, low, high = (left, low, middle) if p < middle else (here - left, middle, high)
    return here


_DEALT: dict[tuple[str, int], np.ndarray] = {}


def _blocks(tag: str, p: int, shared, seed: int) -> np.ndarray:
    """The block of each row of partition ``p``: its counts per block in a random order, the same in every attempt."""
    if (tag, p) not in _DEALT:
        counts, places = shared.value
        row = matrix_row(counts, np.array(places), p, seed) if p < len(counts) else np.zeros(len(places), np.int64)
        _DEALT.clear()
        _DEALT[tag, p] = np.random.default_rng([seed, p, 1 << 40]).permutation(np.repeat(np.arange(len(places), dtype=np.int32), row))
    return _DEALT[tag, p]


def shuffle_rows(df: DataFrame, shards: int = SHARDS, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` and ``slot``, its place there, gapless from 0.

    ``df`` must give the same partitions each time it is read, as a scan of files does; a task that
    finds more rows than were counted fails rather than give wrong sizes.
    """
    found = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    counts = [0] * (1 + max((r["p"] for r in found), default=0))
    for r in found:
        counts[r["p"]] = r["count"]
    total = sum(counts)
    per_shard = max(1, min(MAX_BLOCKS // shards, math.ceil(total / shards / block_rows)))
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    places = [size // per_shard + (k < size % per_shard) for size in sizes for k in range(per_shard)]
    shared, tag = df.sparkSession.sparkContext.broadcast((counts, places)), uuid.uuid4().hex
    names = [f"_c{i}" for i in range(len(df.columns))]

    @F.pandas_udf("block int, key long")
    def deal(ids: pd.Series) -> pd.DataFrame:
        ids = ids.to_numpy()
        out, keys = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int64)
        for p in np.unique(ids >> _ROW_BITS).tolist():
            own = np.flatnonzero(ids >> _ROW_BITS == p)
            at, blocks = ids[own] & (1 << _ROW_BITS) - 1, _blocks(tag, p, shared, seed)
            if at.max() >= len(blocks):
                raise RuntimeError("an input partition changed between two passes; materialize the input first")
            out[own] = blocks[at]
            with np.errstate(over="ignore"):
                keys[own] = mix(mix(at.astype(np.uint64) + np.uint64(p << _ROW_BITS)) ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 2**64 - 1)).view(np.int64)
        return pd.DataFrame({"block": out, "key": keys})

    at = df.toDF(*names).withColumn("_at", F.monotonically_increasing_id())
    dealt = at.withColumn("_dealt", deal("_at")).select(*names, "_at", F.col("_dealt.block").alias("_block"), F.col("_dealt.key").alias("_key"))
    starts = [0] * len(places)
    for b in range(len(places)):
        starts[b] = 0 if b % per_shard == 0 else starts[b - 1] + places[b - 1]
    first = F.array(*[F.lit(x).cast("long") for x in starts]) if len(starts) <= 512 else None
    rank = F.row_number().over(Window.partitionBy("_block").orderBy("_key", "_at")).cast("long") - 1
    ranked = dealt.withColumn("_rank", rank)
    if first is not None:
        placed = ranked.withColumn("slot", F.get(first, F.col("_block")) + F.col("_rank"))
    else:
        table = df.sparkSession.createDataFrame(list(enumerate(starts)), "_block int, _start long")
        placed = ranked.join(F.broadcast(table), "_block").withColumn("slot", F.col("_start") + F.col("_rank"))
    return placed.select(*[F.col(n).alias(_free(old, df.columns)) for n, old in zip(names, df.columns)], (F.col("_block") / F.lit(per_shard)).cast("int").alias("shard"), "slot")


def _free(name: str, taken: list[str]) -> str:
    """``name``, with underscores where it would clash with the columns added."""
    if name.lower() not in ("shard", "slot"):
        return name
    while (name := name + "_").lower() in map(str.lower, taken):
        pass
    return name


def shard_digest(sharded: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and a null grown_shard for rows that were sharded by ``shuffle_rows``."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return sharded.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
