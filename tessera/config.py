"""Settings with environment overrides, and the fixed values that records and topics must carry."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# Legal sources, topic names, dead-letter topic and field.
SOURCES = ("danistay", "yargitay", "mevzuat")
RAW_TOPIC, CHUNKED_TOPIC, DEAD_LETTERS, ERROR_FIELD = "legal.{}.raw", "legal.{}.chunked", "legal.dlq", "_dlq_error"
# Consumer groups per source.
CHUNKER_GROUP, EMBEDDER_GROUP = "chunker-{}", "embedder-{}"


def _text(name: str, default: str):
    return field(default_factory=lambda: os.environ.get(name, default))


def _number(name: str, default: int):
    return field(default_factory=lambda: int(os.environ.get(name, default)))


@dataclass(frozen=True)
class Topics:
    """The message system; ``brokers`` is a comma-separated list."""

    brokers: str = _text("TESSERA_BROKERS", "localhost:9092")
    acks: str = "all"
    retries: int = 5
    starting: str = "earliest"

    @property
    def broker_list(self) -> list[str]:
        return self.brokers.split(",")

    def kafka_options(self) -> dict[str, str]:
        """Options of Spark's Kafka sink for these settings."""
        return {"kafka.bootstrap.servers": self.brokers, "kafka.acks": self.acks, "kafka.retries": str(self.retries), "kafka.retry.backoff.ms": "500", "kafka.max.block.ms": "10000"}

    def consumer_options(self, topic: str, group: str) -> dict[str, str]:
        """Options of Spark's Kafka source; offsets are committed by the stream's checkpoint, never by the client."""
        return {"kafka.bootstrap.servers": self.brokers, "subscribe": topic, "startingOffsets": self.starting, "groupIdPrefix": group, "failOnDataLoss": "true"}


@dataclass(frozen=True)
class Seen:
    """Size and error rate of the approximate set of published keys."""

    capacity: int = 5_000_000
    error_rate: float = 0.001


@dataclass(frozen=True)
class Chunking:
    size: int = 512
    overlap: int = 64
    least: int = 50


@dataclass(frozen=True)
class Vectors:
    """Vector records; one collection per source."""

    size: int = _number("TESSERA_VECTOR_SIZE", 1024)
    batch: int = 32
    max_tokens: int = 8192
    collections: tuple[tuple[str, str], ...] = (("danistay", "danistay_kararlar"), ("yargitay", "yargitay_kararlar"), ("mevzuat", "mevzuat"))


@dataclass(frozen=True)
class Throttle:
    """Fixed values of the request throttle: limits, streaks and waits in seconds."""

    most: float = 30.0
    clean_run: int = 20
    strikes: int = 3
    block_waits: tuple[int, ...] = (60, 180, 600, 1800, 3600)
    limited_wait: int = 30
    network_wait: int = 10
    attempts: int = 4
    range_captchas: int = 30
    range_captcha_wait: int = 1800
    range_errors: int = 5
    range_error_wait: int = 300
