"""Patrol state over a log of decisions, in batch and as a stream, and a trigger on accumulated samples."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATE = "patrol_id string, patrol_count long, idle_cycles long, last_action string"


def patrol_state(log: DataFrame, order: str) -> DataFrame:
    """Per patrol_id and decision: how many so far, how many idle ones (action none) since the last that was not, and the last action that was not."""
    w = Window.partitionBy("patrol_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    busy = F.col("action") != "none"
    island = F.count(F.when(busy, True)).over(w)
    out = log.withColumn("patrol_count", F.count("*").over(w)).withColumn("_island", island).withColumn("last_action", F.last(F.when(busy, F.col("action")), ignorenulls=True).over(w))
    inside = Window.partitionBy("patrol_id", "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("idle_cycles", F.count(F.when(~busy, True)).over(inside)).drop("_island")


def _update(key: tuple[Any, ...], frames: Iterable[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
    count, idle, last = state.get if state.exists else (0, 0, None)
    rows = pd.concat(list(frames)).sort_values("ordinal")
    for action in rows["action"]:
        count, idle, last = count + 1, idle + 1 if action == "none" else 0, last if action == "none" else action
    state.update((count, idle, last))
    yield pd.DataFrame({"patrol_id": [key[0]], "patrol_count": [count], "idle_cycles": [idle], "last_action": [last]})


def patrol_stream(decisions: DataFrame) -> DataFrame:
    """The same state for a stream of patrol_id, ordinal, action: a row for each patrol that a batch touches."""
    return decisions.groupBy("patrol_id").applyInPandasWithState(_update, STATE, "count long, idle long, last string", "update", "NoTimeout")


def deduplicated_stream(samples: DataFrame, hash_column: str, time_column: str, delay: str = "1 day") -> DataFrame:
    """Keep-first by hash within the watermark; weaker than the batch form, which sees all samples."""
    return samples.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([hash_column])


def windowed_counts(events: DataFrame, time_column: str, size: str, slide: str | None = None, delay: str = "10 minutes", *keys: str) -> DataFrame:
    """Counts in event-time windows, late rows up to ``delay`` included."""
    span = F.window(time_column, size, slide) if slide else F.window(time_column, size)
    return events.withWatermark(time_column, delay).groupBy(span, *keys).agg(F.count("*").alias("n"))


def retrain_stream(samples: DataFrame, known: DataFrame, share: float = 0.1) -> DataFrame:
    """role, new, known, due for a stream of samples with a role, as they add up against the known ones (static: role, known); for update or complete mode."""
    new = samples.groupBy("role").agg(F.count("*").alias("new"))
    both = new.join(known, "role", "left").withColumn("known", F.coalesce("known", F.lit(0)))
    return both.withColumn("due", (F.col("known") == 0) | (F.col("new") >= F.lit(share) * F.col("known")))


def retrain_due(new: int, known: int, share: float = 0.1) -> bool:
    """Whether new samples make up at least ``share`` of the known ones (described only)."""
    return known == 0 or new / known >= share
