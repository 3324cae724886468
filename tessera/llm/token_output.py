"""Token ids written as ORC, in ascending document order, and read back.

ORC keeps integers run-length encoded in stripes, with row indexes and Bloom filters on doc_id, so
readers work stripe by stripe and skip stripes and row groups that cannot hold an id.

Defined results: a null or empty text has only the end id; rows with a null id sort first; rows with
one id sort by a hash of the text, then by the text, so their order is fixed; an empty table gives no
rows; other columns are ignored. Documents are dealt by ranges of id and hash, so that rows of one id are
split too; one task streams its range in order, whatever its texts' length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrow import give_back, sliced
from tessera.llm.tokens import SLICE, TextEncoder
from tessera.session import scratch_path

END_ID = 1
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
_FILE = "doc_id long, ids array<int>, n_tokens long, part int, before long"


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write doc_id, ids, n_tokens, the part, and the ids in that part before the document."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("part", pa.int32()), ("before", pa.int64())])

    def run(batches):
        encoder, part, before = TextEncoder.open(tokenizer), TaskContext.get().partitionId(), 0
        for b in sliced(batches, 3000, 2 * SLICE):
            ids, lengths = encoder.encode(b.column("text"))
            ends = np.cumsum(lengths)
            ids = np.insert(ids, ends, end_id).astype(np.int32)
            offsets = np.append(0, ends + np.arange(1, len(ends) + 1))
            if offsets[-1] >= 2**31:
                raise ValueError("too many ids in one Arrow batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), lists, pa.array(lengths + 1), pa.array(np.full(len(lengths), part, np.int32)), pa.array(before + offsets[:-1])], schema=schema
            )
            before += int(offsets[-1])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.withColumn("_hash", F.xxhash64("text")).repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text")
    ordered.select("doc_id", "text").mapInArrow(run, _FILE).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids, from the files.

    Only part and n_tokens are read for the totals, one number per part; a filter on doc_id is
    pushed down to the row indexes and Bloom filters.
    """
    files = spark.read.schema(_FILE).orc(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, rows = 0, []
    for r in totals:
        rows.append((r["part"], base))
        base += r["n"]
    bases = spark.createDataFrame(rows, "part int, base long")
    return files.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in (x.slice(at, 1000) for x in batches for at in range(0, x.num_rows, 1000)):
            ids = b.column("ids")
            flat = memoryview(ids.flatten().to_numpy().astype("<u4")).cast("B")
            at = (4 * (ids.offsets.to_numpy() - ids.offsets[0].as_py())).tolist()
            crc = [zlib.crc32(flat[x:y]) for x, y in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())], schema=schema)

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, tokenizer, path)
    return with_checksums(read_token_files(docs.sparkSession, path))
