"""Vector records: collections, size checks, nearest neighbours."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.config import Vectors
from tessera.operators import neighbours
from tessera.operators.resume import first_of_each
from tessera.session import materialize, path_exists, scratch_path


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def collection_of(source: Column, settings: Vectors = Vectors()) -> Column:
    """The collection of a source's vectors; null for other sources."""
    out = F.lit(None).cast("string")
    for name, collection in settings.collections:
        out = F.when(source == name, collection).otherwise(out)
    return out


def vector_records(rows: DataFrame, vector: str = "embedding", size: int = Vectors().size) -> DataFrame:
    """Rows whose vector has the collection's size."""
    return rows.where(F.size(vector) == size)


#: Queries that are compared at once; their vectors are sent to every task.
BLOCK = 4096
#: Rows that a task compares with a block of queries.
TASK_ROWS = 1 << 16


def nearest(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, the k nearest by dot product with their rank; ties by id. ``queries`` is a stated set.

    A query id is asked once, with the least of its vectors if it has several. Queries are counted and taken in
    blocks of about ``block``, of which the driver holds one at a time; each block reads the rows once, in
    tasks of about ``TASK_ROWS`` rows. All pairs are compared, by ``neighbours``; a task sends about k rows per query.
    """
    named = queries.where(F.col(key).isNotNull()).select(F.col(key).alias("query_id"), F.col(vector).cast("array<double>").alias("_q"))
    asked = first_of_each(named, "query_id", [F.col("_q")])
    blocks = max(1, -(-named.count() // block))
    some = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("neighbour_id"), F.col(vector).cast("array<double>").alias("_v"))
    tasks = -(-some.count() // TASK_ROWS)
    if tasks > 1:
        some = some.repartition(tasks)
    if blocks == 1:
        met = _compared(some, asked, k)
    else:
        asked, path = materialize(asked, "queries"), scratch_path(rows.sparkSession, "nearest")
        for i in range(blocks):
            met = _compared(some, asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i), k)
            met.write.mode("append").parquet(path)
        met = rows.sparkSession.read.schema(met.schema).parquet(path)
    met = met.select("query_id", "neighbour_id", F.round("score", 6).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "neighbour_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)


def _compared(some: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    block = asked.select("query_id", "_q").toArrow().combine_chunks()
    made = StructType([asked.schema["query_id"], some.schema["neighbour_id"], StructField("score", DoubleType())])
    ids, vectors = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in block.columns)
    return some.mapInArrow(neighbours.compared(ids, vectors, k, to_arrow_schema(made)), made)


class VectorStore:
    """Vectors by collection and key, in a folder that driver and executors share.

    An upsert writes only its own rows, under its number; a read gives the row of the highest number of
    each key. An upsert that runs again replaces what it wrote. ``compact`` bounds what a read merges.
    """

    def __init__(self, root: str, key: str = "vec_id", vector: str = "embedding", size: int = Vectors().size):
        self.root, self.key, self.vector, self.size = root.rstrip("/"), key, vector, size

    def upsert(self, rows: DataFrame, number: int, order: list[Column]) -> None:
        """Write rows, which have a column collection. Rows without a key, a collection or a vector of the
        store's size are left out; of a repeated key the first row in ``order`` is kept."""
        some = vector_records(rows.where(F.col(self.key).isNotNull() & F.col("collection").isNotNull()), self.vector, self.size)
        self._write(first_of_each(some, ["collection", self.key], order), f"upserts/number={number}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.select("collection", self.key, self.vector).write.mode("overwrite").partitionBy("collection").parquet(f"{self.root}/{folder}")

    def _read(self, spark: SparkSession, folder: str) -> DataFrame:
        return spark.read.schema(f"{self.key} long, {self.vector} array<float>, number long, collection string").parquet(f"{self.root}/{folder}")

    def _base(self, spark: SparkSession) -> int:
        """The number up to which upserts are compacted; -1 without any. Only complete folders count."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/bases/number=*/_SUCCESS")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        return max((int(str(f.getPath().getParent().getName()).split("=")[1]) for f in found or []), default=-1)

    def current(self, spark: SparkSession, through: int | None = None) -> DataFrame:
        """collection, key and vector as they are after the upserts up to ``through``, or all."""
        base, parts = self._base(spark), []
        if base >= 0:
            parts.append(self._read(spark, "bases").where(F.col("number") == base))
        if path_exists(spark, f"{self.root}/upserts"):
            later = self._read(spark, "upserts").where(F.col("number") > base)
            parts.append(later if through is None else later.where(F.col("number") <= through))
        if not parts:
            return spark.createDataFrame([], f"collection string, {self.key} long, {self.vector} array<float>")
        merged = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return first_of_each(merged, ["collection", self.key], [F.col("number").desc()]).select("collection", self.key, self.vector)

    def compact(self, spark: SparkSession, through: int) -> None:
        """Merge the upserts up to ``through``, which must have ended, into a new base; what it replaces stays on disk for readers under way."""
        if through > self._base(spark):
            self._write(self.current(spark, through), f"bases/number={through}")
