"""Packing of token sequences by minimum bin slack.

Each document is its ids and an end id. Full windows of ``capacity`` ids become sequences by
themselves; the remainders of a block of documents are packed by minimum bin slack: the longest
remainder opens a window, and a bitset subset-sum dynamic programme over the multiset of remaining
lengths finds the fill closest to the capacity. Its backtracked counts per length are applied as often
as the multiset allows. Where the closest fill leaves a slack, no remainder is short enough for it; so
just that many ids are cut off the longest one left. What is less than one window at the end of a block
is cut into powers of two, which need no padding.

Defined results: a null or empty text is one end id; repeated rows are packed each for itself; an
empty table gives no rows; other columns are ignored. Very long texts, white space or not, give full
windows as they stream. One task holds the remainders of at most ``block`` documents and no shuffle is needed, so
hot sources and groups of copies make no difference. Rows are a function of the input partitions:
a task that runs again gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import give_back, sliced
from tessera.llm.tokens import SLICE, TextEncoder

CAPACITY = 1024
BLOCK = 8_192


def best_fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """How many pieces of each length give the largest sum of at most ``room``.

    Bit s of ``reach`` says that some multiset has the sum s. Lengths enter longest first, each in
    batches of 1, 2, 4, ... pieces; the dynamic programme ends early once ``room`` itself is reached.
    """
    mask, reach = (1 << room + 1) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, batch = min(counts[length], room // length), 1
        while left:
            k = min(batch, left)
            steps.append((length, k, reach))
            reach |= reach << length * k & mask
            left, batch = left - k, batch * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            used[length] += k
            total -= length * k
    return dict(used)


def fill_windows(lengths: list[int], capacity: int) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Windows of pieces (index, from, to) that sum to the capacity, and the pieces left over, less than one window."""
    by_length: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for i in reversed(range(len(lengths))):
        by_length[lengths[i]].append((i, 0, lengths[i]))
    counts, total = {k: len(v) for k, v in by_length.items()}, sum(lengths)
    windows: list[list[tuple[int, int, int]]] = []
    while total >= capacity:
        longest = max(counts)
        counts[longest] -= 1
        used = best_fill(capacity - longest, {k: v for k, v in counts.items() if v})
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        slack = capacity - sum(k * n for k, n in used.items())
        for _ in range(1 if slack else min(counts[k] // n for k, n in used.items())):
            windows.append([by_length[k].pop() for k, n in used.items() for _ in range(n)])
            for k, n in used.items():
                counts[k] -= n
            total -= capacity
        counts = {k: v for k, v in counts.items() if v}
        if slack:
            longest = max(counts)
            i, a, b = by_length[longest].pop()
            windows[-1].append((i, a, a + slack))
            by_length[longest - slack].append((i, a + slack, b))
            counts[longest] -= 1
            counts[longest - slack] = counts.get(longest - slack, 0) + 1
            counts = {k: v for k, v in counts.items() if v}
    return windows, sorted(piece for pieces in by_length.values() for piece in pieces)


def cut_tail(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Sequences of (index, from, to) whose sizes are powers of two, the largest first, for pieces joined in order."""
    total = sum(b - a for _, a, b in pieces)
    out, left = [], list(reversed(pieces))
    for size in (1 << k for k in reversed(range(total.bit_length())) if total >> k & 1):
        sequence = []
        while size:
            i, a, b = left.pop()
            end = min(b, a + size)
            sequence.append((i, a, end))
            size -= end - a
            if end < b:
                left.append((i, end, b))
        out.append(sequence)
    return out


class _Rows:
    """Output rows of one task."""

    def __init__(self, task: int, capacity: int, with_ids: bool):
        self.capacity, self.with_ids, self.sequence = capacity, with_ids, task << 32
        self.rows: list[list] = [[] for _ in range(8)]
        self.waiting: list[tuple] = []

    def put(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int, offset: int) -> None:
        values = (doc_id, start, len(ids), zlib.crc32(ids), doc_tokens, self.sequence, offset, ids.view(np.int32) if self.with_ids else None)
        for column, value in zip(self.rows, values):
            column.append(value)

    def document(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            self.put(doc_id, start, ids[start : start + self.capacity], len(ids), 0)
            self.sequence += 1
        if whole < len(ids):
            self.waiting.append((doc_id, whole, ids[whole:].copy(), len(ids)))

    def flush(self) -> None:
        lengths = [len(x[2]) for x in self.waiting]
        windows, rest = fill_windows(lengths, self.capacity)
        for sequence in windows + cut_tail(rest):
            offset = 0
            for i, a, b in sequence:
                doc_id, start, ids, n = self.waiting[i]
                self.put(doc_id, start + a, ids[a:b], n, offset)
                offset += b - a
            self.sequence += 1
        self.waiting = []

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        rows, self.rows = self.rows, [[] for _ in range(8)]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, schema)], schema=schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, block: int = BLOCK, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, ids."""
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches):
        encoder = TextEncoder.open(tokenizer)
        out = _Rows(TaskContext.get().partitionId(), capacity, with_ids)
        for b in sliced(batches, 3000, 2 * SLICE):
            ids, lengths = encoder.encode(b.column("text"))
            at = 0
            for doc_id, n in zip(b.column("doc_id").to_pylist(), lengths.tolist()):
                out.document(doc_id, np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4", copy=False))
                at += n
                if len(out.waiting) >= block:
                    out.flush()
            yield out.take(schema)
        out.flush()
        yield out.take(schema)
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids)
