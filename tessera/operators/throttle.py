"""The request throttle, replayed over an event log."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.config import Throttle
from tessera.sources.files import open_path

#: Outcomes that are tried again; any other ends its request.
RETRIED = ("captcha", "backoff", "network")


def clamp(value: Column, most: float = Throttle().most) -> Column:
    """A restored multiplier, held between 1 and the cap; a missing or unreadable one is 1."""
    return F.greatest(F.lit(1.0), F.least(F.coalesce(value, F.lit(1.0)), F.lit(most)))


@dataclass
class State:
    multiplier: float = 1.0
    streak: int = 0
    escalation: int = 0
    strikes: int = 0

    def apply(self, outcome: str, rules: Throttle = Throttle()) -> "State":
        """The state after one response: ``captcha`` and ``backoff`` slow down, ``ok`` eases off."""
        if outcome in ("captcha", "backoff"):
            hard = outcome == "captcha"
            m = self.multiplier
            if m < rules.most:
                m = rules.most if hard else min(2 * m, rules.most)
            return State(m, 0, min(self.escalation + 1, len(rules.block_waits) - 1), self.strikes + hard)
        if outcome != "ok":
            return self
        if self.multiplier <= 1:
            return State(self.multiplier, self.streak, 0, self.strikes)
        if self.streak + 1 < rules.clean_run:
            return State(self.multiplier, self.streak + 1, self.escalation, self.strikes)
        m = max(self.multiplier / 2, 1.0)
        return State(m, 0, max(self.escalation - 1, 0), 0 if m <= 1 else self.strikes)


def replay(log: DataFrame, key: str, order: str, outcome: str, rules: Throttle = Throttle()) -> DataFrame:
    """key, order, outcome, and the throttle's state after each event of the key.

    Events of a key are sorted on disk and streamed; one state per task is held, whatever a key's length.
    """
    rows = log.select(key, order, outcome).repartition(F.col(key)).sortWithinPartitions(key, order)
    schema = f"{key} {log.schema[key].dataType.simpleString()}, {order} {log.schema[order].dataType.simpleString()}, {outcome} string, multiplier double, streak int, escalation int, strikes int"

    def run(batches):
        at, state = object(), State()
        for pdf in batches:
            out = []
            for k, what in zip(pdf[key], pdf[outcome]):
                if k != at:
                    at, state = k, State()
                state = state.apply(what, rules)
                out.append((state.multiplier, state.streak, state.escalation, state.strikes))
            yield pd.concat([pdf, pd.DataFrame(out, columns=["multiplier", "streak", "escalation", "strikes"], index=pdf.index)], axis=1)

    return rows.mapInPandas(run, schema)


def transitions(log: DataFrame, key: str, order: list, state: str) -> DataFrame:
    """Events whose state differs from the one before; the first of a key has none before it."""
    before = F.lag(state).over(Window.partitionBy(key).orderBy(*order))
    return log.withColumn("previous", before).where(F.col("previous").isNotNull() & (F.col("previous") != F.col(state)))


def clean_streak(log: DataFrame, key: str, order: list, rejected: Column) -> DataFrame:
    """How many events in a row up to each event were not rejected."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    island = log.withColumn("_island", F.count_if(rejected).over(w))
    inside = Window.partitionBy(key, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return island.withColumn("streak", F.count_if(~rejected).over(inside)).drop("_island")


def wait_seconds(outcome: Column, attempt: Column, escalation: Column, rules: Throttle = Throttle()) -> Column:
    """Seconds to wait before the next attempt (attempts count from 0); null where there is none."""
    ladder = F.array(*[F.lit(x) for x in rules.block_waits])
    return (
        F.when(outcome == "captcha", F.get(ladder, F.least(escalation, F.lit(len(rules.block_waits) - 1))))
        .when(outcome == "backoff", (attempt + 1) * rules.limited_wait)
        .when(outcome == "network", (attempt + 1) * rules.network_wait)
    )


def range_wait(outcome: Column, tries: Column, rules: Throttle = Throttle()) -> Column:
    """Seconds before a part of a range is run again after its ``tries``-th failure (from 1); null where it is skipped, or did not fail."""
    return F.when((outcome == "captcha") & (tries < rules.range_captchas), F.lit(rules.range_captcha_wait)).when(
        ~outcome.isin("ok", "captcha") & (tries < rules.range_errors), F.lit(rules.range_error_wait)
    )


def settled(log: DataFrame, request: list[str], order: str, outcome: str, rules: Throttle = Throttle()) -> DataFrame:
    """request, attempts and result of each request: its first outcome that is not tried again, or ``exhausted``.

    At most ``rules.attempts`` attempts of a request count. Attempts that tie in order are taken by outcome.
    """
    w = Window.partitionBy(*request).orderBy(order, outcome)
    tried = log.select(*request, order, outcome).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= rules.attempts)
    ended = F.min(F.when(~F.col(outcome).isin(*RETRIED), F.struct("_n", F.col(outcome).alias("result")))).alias("_end")
    return tried.groupBy(*request).agg(F.max("_n").alias("_most"), ended).select(
        *request, F.coalesce("_end._n", "_most").alias("attempts"), F.coalesce("_end.result", F.when(F.col("_most") == rules.attempts, "exhausted").otherwise("pending")).alias("result")
    )


def until_stop(states: DataFrame, key: str, order: str, rules: Throttle = Throttle()) -> DataFrame:
    """Replayed events of each key up to the captcha that reaches the limit, that one included; the rest waits for a resumed run.

    The stops are found by an aggregation, so a key with very many events is not gathered; keys must not be null.
    """
    stops = states.where(F.col("strikes") >= rules.strikes).groupBy(key).agg(F.min(order).alias("_stop"))
    return states.join(stops, key, "left").where(F.col("_stop").isNull() | (F.col(order) <= F.col("_stop"))).select(*states.columns)


def save_multipliers(states: DataFrame, key: str, order: str, path: str) -> None:
    """Write each key's last multiplier with two decimals, as the text that a later run restores."""
    last = states.groupBy(key).agg(F.max_by("multiplier", order).alias("_m"))
    last.select(F.col(key), F.format_string("%.2f", "_m").alias("value")).write.mode("overwrite").parquet(path)


def restored_multipliers(saved: DataFrame) -> DataFrame:
    """Saved values as multipliers within the limits; unreadable ones are 1."""
    return saved.withColumn("multiplier", clamp(F.nullif(F.expr("try_cast(trim(value) AS double)"), F.lit(float("nan"))))).drop("value")


def save_state(state: State, path: str) -> None:
    """Write the multiplier of one crawl; the rest of its state starts anew with each run."""
    system, p = open_path(path)
    with system.open_output_stream(p) as f:
        f.write(f"{state.multiplier:.2f}\n".encode())


def load_state(path: str, rules: Throttle = Throttle()) -> State:
    """The state that a run starts with; without a readable file it is the fresh one."""
    try:
        system, p = open_path(path)
        with system.open_input_stream(p) as f:
            value = float(f.read().decode().strip() or 1)
    except (OSError, ValueError):
        return State()
    return State(max(1.0, min(value, rules.most))) if value == value else State()
