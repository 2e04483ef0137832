"""Linking sessions to telemetry: outcome, topic, work item and duration, with local logs as a fallback.

``events`` needs session_id, message, time (ISO text), exit_type, status, topic, issue, stream, and ordinal (arrival).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def issue_of(issue: Column, stream: Column) -> Column:
    """The event's work item, else the one its stream label names."""
    label = F.regexp_extract(F.coalesce(stream, F.lit("")), r'(?:^|[{,])\s*gt\.issue="?([^",}]+)', 1)
    return F.coalesce(F.nullif(issue, F.lit("")), F.nullif(label, F.lit("")))


def outcomes(events: DataFrame) -> DataFrame:
    """Per session: exit_type, status and topic of the first done event that has an exit type, and the first work item named."""
    done = events.where("message = 'done'").withColumn("_issue", issue_of(F.col("issue"), F.col("stream"))).withColumn("_exit", F.nullif("exit_type", F.lit("")))
    first = F.min(F.when(F.col("_exit").isNotNull(), F.struct("ordinal", "_exit", F.nullif("status", F.lit("")).alias("status"), F.nullif("topic", F.lit("")).alias("topic"))))
    item = F.min(F.when(F.col("_issue").isNotNull(), F.struct("ordinal", "_issue")))
    return done.groupBy("session_id").agg(first.alias("f"), item.alias("i")).select("session_id", F.col("f._exit").alias("exit_type"), F.col("f.status").alias("status"), F.col("f.topic").alias("topic"), F.col("i._issue").alias("bead_id"))


def durations(events: DataFrame) -> DataFrame:
    """Per session the milliseconds from the earliest start to the latest stop, if it has both; times that don't parse are skipped."""
    at = F.expr("try_to_timestamp(time)")
    start = F.min(F.when(F.col("message").contains("session.start"), at))
    stop = F.max(F.when(~F.col("message").contains("session.start") & F.col("message").contains("session.stop"), at))
    lifecycle = events.where(F.col("message").contains("session.start") | F.col("message").contains("session.stop"))
    both = lifecycle.groupBy("session_id").agg(start.alias("a"), stop.alias("b")).where("a is not null and b is not null")
    return both.select("session_id", F.expr("(unix_micros(b) - unix_micros(a)) div 1000").alias("duration_ms"))


def last_of(log: DataFrame, *fields: str) -> DataFrame:
    """The last record of each session, by line number."""
    newest = F.max(F.struct("line_no", *fields))
    return log.groupBy("session_id").agg(newest.alias("r")).select("session_id", *(F.col(f"r.{f}").alias(f) for f in fields))


def first_n(events: DataFrame, n: int, *order: str) -> DataFrame:
    """At most n events a session."""
    from pyspark.sql import Window

    return events.withColumn("_rank", F.row_number().over(Window.partitionBy("session_id").orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def link_by(sessions: DataFrame, events: DataFrame, costs: DataFrame | None = None, commands: DataFrame | None = None, names: tuple[str, ...] = ("gt_session", "session_id")) -> DataFrame:
    """``link`` by the first of the named columns that is there and not blank, as telemetry may know a session by another
    name than its id. session_id stays as it is.
    """
    key = F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in names if c in sessions.columns))
    keyed = sessions.withColumn("_key", key).withColumnRenamed("session_id", "_own").withColumnRenamed("_key", "session_id")
    return link(keyed, events, costs, commands).drop("session_id").withColumnRenamed("_own", "session_id")


def link(sessions: DataFrame, events: DataFrame, costs: DataFrame | None = None, commands: DataFrame | None = None, key: str = "session_id") -> DataFrame:
    """Adds bead_id and otel_signals. The logs (costs: role, commands: actor; both line_no) only count where no work item was found; costs come first."""
    out = sessions.join(outcomes(events), key, "left").join(durations(events), key, "left")
    none = F.lit(None).cast("string")
    out = out.join(last_of(costs, "role").withColumnRenamed("role", "_role").withColumn("_cost", F.lit(True)), key, "left") if costs is not None else out.withColumn("_role", none).withColumn("_cost", F.lit(None).cast("boolean"))
    out = out.join(last_of(commands, "actor").withColumnRenamed("actor", "_actor").withColumn("_cmd", F.lit(True)), key, "left") if commands is not None else out.withColumn("_actor", none).withColumn("_cmd", F.lit(None).cast("boolean"))
    open_ = F.col("bead_id").isNull()
    source = F.when(open_ & F.col("_role").isNotNull(), "costs.jsonl").when(open_ & F.col("_actor").isNotNull(), "cmd-usage.jsonl")
    signals = F.struct("exit_type", "status", "topic", "duration_ms", source.alias("fallback_source"), F.when(open_, F.col("_role")).alias("role"), F.when(open_, F.col("_actor")).alias("actor"))
    return out.withColumn("otel_signals", signals).drop("exit_type", "status", "topic", "duration_ms", "_role", "_cost", "_actor", "_cmd")
