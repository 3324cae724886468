"""Deduplication by key: exact, against published keys, and by a Bloom filter of fixed size."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import Seen
from tessera.operators.resume import first_of_each


def first_wins(docs: DataFrame, key: str, order: list) -> DataFrame:
    """The first document of each key."""
    return first_of_each(docs, key, order)


def unseen(docs: DataFrame, seen: DataFrame, key: str, order: list) -> DataFrame:
    """First documents of keys that were not published before."""
    return first_wins(docs.join(seen.select(key), key, "left_anti"), key, order)


class BloomFilter:
    """A set of keys with false positives but no false negatives; its size follows capacity and error rate.

    Tasks set bits in words of their own before they are shuffled and joined by word, so no task sees more than a share
    of the words, however many tasks there are. The table of bits, about 9 MB at five million keys and an error of
    0.1 %, is what reaches the driver and is broadcast; its size does not depend on the keys.
    """

    WORD = 64

    def __init__(self, seen: Seen = Seen()):
        bits = math.ceil(-seen.capacity * math.log(seen.error_rate) / math.log(2) ** 2)
        self.bits = -(-bits // self.WORD) * self.WORD
        self.hashes = max(1, round(self.bits / seen.capacity * math.log(2)))
        self.table = np.zeros(self.bits // self.WORD, dtype=np.uint64)

    def _walk(self, key: Column) -> list[Column]:
        """The first place of a key, and the step from each place to the next."""
        first, step = (F.xxhash64(F.lit(s), key) for s in (11, 23))
        return [F.pmod(first, F.lit(self.bits)).alias("_first"), (1 + F.pmod(step, F.lit(self.bits - 1))).alias("_step")]

    def add(self, keys: DataFrame, key: str) -> "BloomFilter":
        walks = keys.where(F.col(key).isNotNull()).select(*self._walk(F.col(key)))
        steps = walks.select("*", F.explode(F.sequence(F.lit(0), F.lit(self.hashes - 1))).alias("_i"))
        places = steps.select(((F.col("_first") + F.col("_i") * F.col("_step")) % self.bits).alias("_place"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_place") % self.WORD).cast("int"))
        words = places.groupBy(F.floor(F.col("_place") / self.WORD).alias("_word")).agg(F.bit_or(bit).alias("_bits")).toArrow()
        self.table[words["_word"].to_numpy()] |= words["_bits"].to_numpy().view(np.uint64)
        return self

    def may_hold(self, spark, key: Column) -> Column:
        shared, bits, hashes, word = spark.sparkContext.broadcast(self.table), self.bits, self.hashes, self.WORD

        @F.pandas_udf("boolean")
        def test(first: pd.Series, step: pd.Series) -> pd.Series:
            at = (first.to_numpy()[:, None] + np.arange(hashes) * step.to_numpy()[:, None]) % bits
            found = shared.value[at // word] >> (at % word).astype(np.uint64) & np.uint64(1)
            return pd.Series(found.all(axis=1))

        return test(*self._walk(key))


def probably_unseen(docs: DataFrame, seen: DataFrame, key: str, order: list, limits: Seen = Seen()) -> DataFrame:
    """Like ``unseen``, with a Bloom filter before the published keys; what it takes for published is looked up exactly.

    The filter keeps its size however many keys it takes: an overfull one makes more look-ups, and loses no document.
    """
    bloom = BloomFilter(limits).add(seen, key)
    flagged = docs.withColumn("_maybe", F.coalesce(bloom.may_hold(docs.sparkSession, F.col(key)), F.lit(False)))
    known = seen.select(F.col(key).alias("_seen"))
    return first_wins(flagged.join(known, F.col("_maybe") & (F.col(key) == F.col("_seen")), "left_anti").drop("_maybe"), key, order)
