"""Benchmark decontamination with one Aho-Corasick automaton over benchmark windows.

Text is normalised to words: A-Z lower-cased, then maximal runs of letters, digits and non-ASCII
characters. A benchmark item gives every window of ``window`` consecutive words; an item with fewer
words, but at least one, is one window. The automaton reads each document once, word by word, and
reports every occurrence of every window, overlapping ones included; word positions map back to code
point offsets of the original text.

Defined results: a null or empty text has no words and is never contaminated; null or empty items
give no windows; repeated windows and repeated items each count; repeated document rows are each
reported; an empty documents or benchmark table gives no rows or no hits; columns other than the id
and the text are ignored, whatever their names. Very long texts are read whole.

Size: windows are broadcast only up to ``max_bytes`` of item text. Beyond it the items are split into
groups of that size by hash and the documents are scanned once for each group, with the hits so far
carried along, so any benchmark size gives whole results.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import sliced
from tessera.session import materialize

WINDOW = 13
MAX_BYTES = 2 << 20

_NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(raw: bytes | None) -> list[bytes]:
    """The normalised words of a UTF-8 text, as bytes."""
    return raw.translate(_NORMAL).split() if raw else []


def windows_of(items: list[tuple], window: int) -> dict[tuple[bytes, ...], list[str]]:
    """Each window and the ids, as strings, of the items that hold it."""
    out: dict[tuple[bytes, ...], set[str]] = {}
    for item_id, raw in items:
        words = words_of(raw)
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            out.setdefault(tuple(words[i : i + window]), set()).add(str(item_id))
    return {k: sorted(v) for k, v in out.items()}


class WindowAutomaton:
    """Aho-Corasick over word ids; words that no window holds share the id 0."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]]):
        import ahocorasick

        class Ids(dict):
            def __missing__(self, word):
                return 0

        self.ids = Ids()
        for words in windows:
            for w in words:
                self.ids.setdefault(w, len(self.ids) + 1)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, items in windows.items():
            self.automaton.add_word(tuple(map(self.ids.__getitem__, words)), (len(words), items))
        self.empty = not windows
        if windows:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged runs [first word, end word) of words inside occurrences, and the items that occur."""
        runs: list[list[int]] = []
        items: set[str] = set()
        if self.empty or not words:
            return runs, items
        for end, (length, found) in self.automaton.iter(tuple(map(self.ids.__getitem__, words))):
            items.update(found)
            first = end - length + 1
            while runs and runs[-1][0] >= first:
                runs.pop()
            if runs and runs[-1][1] >= first:
                runs[-1][1] = end + 1
            else:
                runs.append([first, end + 1])
        return runs, items


_BUILT: dict[str, WindowAutomaton] = {}


def _automaton(tag: str, shared) -> WindowAutomaton:
    """The automaton of a broadcast, built once per worker process."""
    if tag not in _BUILT:
        _BUILT.clear()
        _BUILT[tag] = WindowAutomaton(shared.value)
    return _BUILT[tag]


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("_utf8")).where("_utf8 is not null and item_id is not null")


def _size(items: DataFrame) -> int:
    return items.agg(F.sum(F.octet_length("_utf8"))).first()[0] or 0

_SPANS = "array<struct<start:int,end:int>>"


def _merge(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and out[-1][1] >= a:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _scan(docs: DataFrame, windows: dict, carried: bool) -> DataFrame:
    """One pass; docs has doc_id, _utf8 and, where ``carried``, the runs and items of earlier passes."""
    shared, tag = docs.sparkSession.sparkContext.broadcast(windows), uuid.uuid4().hex
    schema = pa.schema(
        [("doc_id", pa.int64()), ("_utf8", pa.binary()), ("n_words", pa.int64()), ("runs", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string()))]
    )

    def run(batches):
        automaton = _automaton(tag, shared)
        for b in sliced(batches):
            raws = b.column("_utf8").to_pylist()
            old_runs, old_items = (b.column(c).to_pylist() if carried else [[]] * len(raws) for c in ("runs", "items"))
            n, runs, items, kept = [], [], [], []
            for i, raw in enumerate(raws):
                words = words_of(raw)
                got, found = automaton.scan(words)
                n.append(len(words))
                runs.append(_merge(got + old_runs[i]))
                items.append(sorted(found.union(old_items[i])))
                kept.append(raw)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v, f.type) for v, f in zip((kept, n, runs, items), list(schema)[1:]))], schema=schema)

    return docs.mapInArrow(run, "doc_id long, _utf8 binary, n_words long, runs array<array<int>>, items array<string>")


def _finish(docs: DataFrame, one_in: int) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
         ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    )

    def run(batches):
        for b in sliced(batches):
            rows = [[] for _ in range(7)]
            for raw, n, runs, items in zip(*(b.column(c).to_pylist() for c in ("_utf8", "n_words", "runs", "items"))):
                hit, spans = sum(e - a for a, e in runs), []
                if runs:
                    at = [m.span() for m in _WORD.finditer(raw.decode("utf-8", "replace"))]
                    spans = [{"start": at[a][0], "end": at[e - 1][1]} for a, e in runs]
                for column, value in zip(rows, (n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0 and one_in * hit >= n, items, spans)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v, f.type) for v, f in zip(rows, list(schema)[1:]))], schema=schema)

    return docs.mapInArrow(
        run, f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans {_SPANS}"
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per document: words, words inside benchmark windows, items found and original spans.

    ``contaminated`` holds where at least one word in ``one_in`` lies inside a window.
    """
    items = _items(benchmark)
    groups = max(1, math.ceil(_size(items) / max_bytes))
    at = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("_utf8"))
    for g in range(groups):
        part = items if groups == 1 else items.where(F.pmod(F.xxhash64("item_id", "_utf8"), F.lit(groups)) == g)
        at = _scan(at, windows_of([tuple(r) for r in part.collect()], window), carried=g > 0)
        if g < groups - 1:
            at = materialize(at, "contamination")
    return _finish(at, one_in)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns; each row is judged by its own text.

    With one automaton the texts are read once and nothing is shuffled. A benchmark over ``max_bytes``
    needs a scan per group: the rows are written once with a key of their own, by which the hits meet
    them again, so null and repeated ids make no difference.
    """
    items = _items(benchmark)
    if _size(items) > max_bytes:
        key = "_row"
        while key in map(str.lower, docs.columns):
            key += "_"
        rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "contamination-rows")
        found = find_contamination(rows.select(F.col(key).alias("doc_id"), "text"), benchmark, window, one_in, max_bytes)
        return rows.join(found.where("contaminated").select(F.col("doc_id").alias(key)), key, "left_anti").drop(key)
    shared, tag = docs.sparkSession.sparkContext.broadcast(windows_of([tuple(r) for r in items.collect()], window)), uuid.uuid4().hex

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        automaton, out = _automaton(tag, shared), []
        for raw in texts.tolist():
            words = words_of(raw)
            hit = sum(e - a for a, e in automaton.scan(words)[0])
            out.append(not (hit > 0 and one_in * hit >= len(words)))
        return pd.Series(out, dtype=bool)

    return docs.where(clean(F.col("text").cast("binary")))
