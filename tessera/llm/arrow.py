"""Small helpers shared by the Arrow-batched operators."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_bytes(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns ``keep`` and the text as UTF-8 bytes; every other column is pruned from the scan."""
    return df.select(*keep, F.col(text).cast("binary").alias("_utf8"))


def sliced(batches, rows: int = 1000, size: int = 4 << 20):
    """The batches in slices of at most ``rows`` rows and, unless one row holds more, ``size`` bytes of text.

    So the Python objects of few rows live at a time, however long the texts are.
    """
    for b in batches:
        texts = [c for c in b.columns if pa.types.is_string(c.type) or pa.types.is_binary(c.type)]
        total = np.zeros(b.num_rows, np.int64)
        for c in texts:
            total += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(total), 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, side="right"))), b.num_rows)
            yield b.slice(at, end - at)
            at = end


def give_back() -> None:
    """Return what Arrow and the C library hold without need, so that an idle worker keeps little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
