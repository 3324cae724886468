"""Topic consumers: a stage reads one topic as a group, and writes the messages of the next topic.

Topics are folders of ``batch=N`` with messages in Parquet, as ``Publisher`` writes them, or Kafka topics.
A group starts at the earliest message; its offsets are the stream's checkpoint, which is committed only
after a batch is written. A batch that runs again replaces its own folder. A topic's batch that was written
again after a group had read it is delivered again, so delivery is at least once, as ids follow from the content.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import CHUNKED_TOPIC, CHUNKER_GROUP, RAW_TOPIC, Chunking, Topics
from tessera.operators.chunk import chunked_documents
from tessera.operators.publish import as_json
from tessera.schemas import CHUNK, MESSAGE, RAW_DOCUMENT


def read_topic(spark: SparkSession, path: str, topic: str, group: str, topics: Topics | None = None) -> DataFrame:
    """A stream of key and value of one topic: of the message folder ``path``, or, given brokers, of Kafka."""
    if topics is not None:
        rows = spark.readStream.format("kafka").options(**topics.consumer_options(topic, group)).load()
        return rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    return spark.readStream.schema(MESSAGE).parquet(f"{path.rstrip('/')}/batch=*").where(F.col("topic") == topic).select("key", "value")


def run_group(messages: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, every: str | None = None):
    """Put each batch through ``stage``, which gives topic, key and value, and write it under ``out``.

    Reads what there is and stops, or, given a period such as '300 seconds', goes on.
    """

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).select("topic", "key", "value").write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    if not every:
        query.awaitTermination()
    return query


def chunk_stage(source: str, settings: Chunking = Chunking()) -> Callable[[DataFrame], DataFrame]:
    """Raw messages of a source to chunk messages, keyed by document; values that are no document give none."""

    def stage(messages: DataFrame) -> DataFrame:
        docs = messages.select(F.from_json("value", RAW_DOCUMENT).alias("_d")).select("_d.*").where("id is not null and text is not null")
        chunks = chunked_documents(docs, settings)
        return chunks.select(F.lit(CHUNKED_TOPIC.format(source)).alias("topic"), F.col("doc_id").alias("key"), as_json(chunks.columns).alias("value"))

    return stage


def chunk_source(spark: SparkSession, messages: str, source: str, out: str, checkpoints: str, settings: Chunking = Chunking()):
    """Run the chunker group of a source over what its raw topic holds now; its checkpoint is its own."""
    group = CHUNKER_GROUP.format(source)
    return run_group(read_topic(spark, messages, RAW_TOPIC.format(source), group), chunk_stage(source, settings), out, f"{checkpoints.rstrip('/')}/{group}")


def chunk_records(messages: DataFrame) -> DataFrame:
    """Chunk records of chunk messages, for the embedding stage."""
    return messages.select(F.from_json("value", CHUNK).alias("_c")).select("_c.*")
