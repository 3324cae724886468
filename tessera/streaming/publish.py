"""Incremental publishing: validity split, first wins, published keys, dead letters, pending texts.

A batch is written in full before its keys count as published, so a failed batch is published again
rather than lost. Everything a batch writes is named by its number: a batch that runs again replaces
its own files and reads only the keys of earlier batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.dedup import unseen
from tessera.operators.normalize import document_key, split_valid
from tessera.operators.publish import dead_letters, messages

KEYS, MESSAGES = "key string", "topic string, key string, value string"


class Publisher:
    """foreachBatch target. ``root`` is a folder that driver and executors share."""

    def __init__(self, root: str, order: list[str] | None = None):
        self.root, self.order = root.rstrip("/"), order or ["line_no", "id"]

    def _read(self, spark: SparkSession, name: str, fields: str, before: int | None = None) -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], f"{fields}, batch long")
        rows = spark.read.schema(f"{fields}, batch long").parquet(f"{self.root}/{name}")
        return rows if before is None else rows.where(F.col("batch") < before)

    def _write(self, rows: DataFrame, name: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}")

    def __call__(self, docs: DataFrame, batch: int) -> None:
        spark = docs.sparkSession
        docs = docs.persist()
        valid, invalid = split_valid(docs)
        keyed = valid.withColumn("_key", document_key())
        seen = self._read(spark, "keys", KEYS, batch).withColumnRenamed("key", "_key")
        fresh = unseen(keyed, seen, "_key", [F.col(c) for c in self.order]).persist()
        self._write(messages(fresh.drop("line_no", "_key"), document_key()), "messages", batch)
        self._write(dead_letters(invalid.drop("line_no")), "dead_letters", batch)
        self._write(fresh.select(F.col("_key").alias("key")), "keys", batch)
        fresh.unpersist()
        docs.unpersist()

    def published(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "messages", MESSAGES)

    def refused(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "dead_letters", MESSAGES)


def publish_available(docs: DataFrame, publisher: Publisher, checkpoint: str, every: str | None = None):
    """Publish what a stream holds now and stop, or, given a period such as '300 seconds', go on."""
    writer = docs.writeStream.foreachBatch(publisher).option("checkpointLocation", checkpoint)
    query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    if not every:
        query.awaitTermination()
    return query


def dedup_stream(docs: DataFrame, key: str) -> DataFrame:
    """Each key once over the whole stream; the state has no horizon and lives in the checkpoint."""
    return docs.dropDuplicates([key])


def with_late_texts(rows: DataFrame, pending: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New and pending rows that have their text now, and those that still wait."""
    waiting = rows.unionByName(pending)
    return waiting.join(texts, "id"), waiting.join(texts.select("id"), "id", "left_anti")
