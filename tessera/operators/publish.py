"""Messages: envelope, routing, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import CHUNKED_TOPIC, DEAD_LETTERS, RAW_TOPIC, Topics


def topic_of(source: Column, pattern: str = RAW_TOPIC) -> Column:
    before, after = pattern.split("{}")
    return F.concat(F.lit(before), source, F.lit(after))


def chunk_topic_of(source: Column) -> Column:
    return topic_of(source, CHUNKED_TOPIC)


def as_json(columns: list[str]) -> Column:
    """One JSON object of the columns; null fields stay and time stamps keep microseconds, without a zone."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def messages(docs: DataFrame, key: Column) -> DataFrame:
    """topic, key and value of each document; the key is the natural key."""
    return docs.select(topic_of(F.col("kaynak")).alias("topic"), F.nullif(key, F.lit("")).alias("key"), as_json(docs.columns).alias("value"))


def dead_letters(docs: DataFrame) -> DataFrame:
    """Invalid documents, error included, for the dead-letter topic; they have no key."""
    return docs.select(F.lit(DEAD_LETTERS).alias("topic"), F.lit(None).cast("string").alias("key"), as_json(docs.columns).alias("value"))


def write_messages(rows: DataFrame, path: str | None = None, topics: Topics | None = None) -> None:
    """Append messages to a folder per topic, or, given brokers, to Kafka."""
    if topics is not None:
        rows.withColumn("key", F.col("key").cast("binary")).write.format("kafka").options(**topics.kafka_options()).save()
    else:
        rows.write.mode("append").partitionBy("topic").json(path, ignoreNullFields=False)


def write_text_files(docs: DataFrame, path: str) -> None:
    """Texts by id, as Parquet; ids and texts only."""
    docs.select("id", "text").write.mode("append").parquet(path)
