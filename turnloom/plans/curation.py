"""From sessions to a deduplicated, split and scrubbed chat dataset, as one lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import chat, chunks, quality, roles, score, scrub, select, tool_text
from ..sources.lines import read_json, write_json


@dataclass(frozen=True)
class Settings:
    window: int = fixed.WINDOW
    stride: int = fixed.STRIDE
    max_chars: int = fixed.WINDOW_CHARS
    result_chars: int = fixed.RESULT_CHARS
    val_share: int = 20
    role_aware: bool = False  # the scorer sees no role by default


def scored_sessions(sessions: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Adds role and quality_score. Scores come from the turns as they are, before tool results are cut."""
    role = roles.tag_role(F.col("folder"), roles.first_user_text(F.col("turns")))
    none = F.lit(None).cast("struct<exit_type:string,status:string,topic:string,duration_ms:bigint,fallback_source:string,role:string,actor:string>")
    signals = F.col("otel_signals") if "otel_signals" in sessions.columns else none
    seen = F.col("role") if settings.role_aware else F.lit("unknown")
    return sessions.withColumn("role", role).withColumn("quality_score", score.quality_score(chat.messages(F.col("turns")), seen, signals))


def samples(sessions: DataFrame, prompts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """conversations, metadata, file_rank and secrets (replacements made), before deduplication."""
    ready = scored_sessions(sessions, settings).withColumn("turns", tool_text.normalize_turns(F.col("turns"), settings.result_chars))
    cut = chunks.chunk_turns(ready.select("session_id", "file_rank", "role", "quality_score", "runtime_type", "mcp_servers", "turns"), settings.window, settings.stride, settings.max_chars)
    good = cut.withColumn("_q", quality.assess(F.col("turns"), F.col("quality_score"))).where("_q.keep")
    named = good.withColumn("quality_score", F.col("_q.score")).withColumn("outcome_score", F.col("_q.outcome_score")).withColumn("ordinal", F.struct("file_rank", "chunk_index"))
    made = chat.format_samples(chat.with_prompts(named, prompts)).withColumn("_s", scrub.scrub_messages(F.col("conversations")))
    return made.select(F.col("_s.conversations").alias("conversations"), "metadata", F.col("ordinal.file_rank").alias("file_rank"), F.col("ordinal.chunk_index").alias("chunk_index"), F.col("_s.n").alias("secrets"))


def dataset(made: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Deduplicated by answers (the first stays) and split at the head; role as a column of its own for partitions."""
    unique = select.keep_first(made, select.answer_hash(F.col("conversations")), "file_rank", "chunk_index")
    split = select.head_split(select.with_ordinal(unique, "file_rank", "chunk_index"), settings.val_share)
    return split.select("conversations", "metadata", "split", F.coalesce("metadata.role", F.lit("unknown")).alias("role"), "ordinal")


def stats(made: DataFrame, final: DataFrame) -> DataFrame:
    """(stage, role, n): samples by role before deduplication, and after it by split."""
    before = made.groupBy(F.col("metadata.role").alias("role")).agg(F.count("*").alias("n")).select(F.lit("before").alias("stage"), "role", "n")
    return before.unionByName(final.groupBy(F.col("split").alias("stage"), "role").agg(F.count("*").alias("n")))


def run_stats(sessions: DataFrame, made: DataFrame, final: DataFrame) -> DataFrame:
    """(kind, name, n) of a whole run: sessions, turns, linked ones and runtimes; samples and secrets before deduplication, by
    role too; samples after it, duplicates removed, and roles of the training part.
    """
    linked = score.has_signals(F.col("otel_signals")) if "otel_signals" in sessions.columns else F.lit(False)
    named = lambda df, *names: df.select(F.explode(F.array(*(F.struct(F.lit("total").alias("kind"), F.lit(n).alias("name"), F.coalesce(n, F.lit(0)).cast("long").alias("n")) for n in names))).alias("x")).select("x.*")
    by = lambda df, kind, column: df.groupBy(F.coalesce(column, F.lit("unknown")).alias("name")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "name", "n")
    parts = [
        named(sessions.agg(F.count("*").alias("sessions"), F.sum(F.size("turns")).alias("turns"), F.count_if(linked).alias("linked")), "sessions", "turns", "linked"),
        by(sessions, "runtime", F.col("runtime_type")),
        named(made.agg(F.count("*").alias("samples"), F.sum("secrets").alias("secrets")), "samples", "secrets"),
        by(made, "role", F.col("metadata.role")),
        named(final.agg(F.count("*").alias("kept"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val")), "kept", "train", "val"),
        by(final.where("split = 'train'"), "train role", F.col("role")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    removed = out.agg((F.sum(F.when(F.col("name") == "samples", F.col("n"))) - F.sum(F.when(F.col("name") == "kept", F.col("n")))).alias("n"))
    return out.unionByName(removed.select(F.lit("total").alias("kind"), F.lit("duplicates removed").alias("name"), "n"))


RAW = "session_id string, source_path string, num_turns int, runtime_type string, mcp_servers array<string>, role string, otel_signals struct<exit_type:string,status:string,topic:string,duration_ms:bigint,fallback_source:string,role:string,actor:string>"


def raw_sessions(sessions: DataFrame) -> DataFrame:
    """What is kept of extracted sessions for another look: no turns, but how many there were."""
    signals = F.col("otel_signals") if "otel_signals" in sessions.columns else F.lit(None).cast(RAW.split("otel_signals ")[1])
    role = F.col("role") if "role" in sessions.columns else F.lit("unknown")
    return sessions.select("session_id", "source_path", F.size("turns").alias("num_turns"), "runtime_type", "mcp_servers", role.alias("role"), signals.alias("otel_signals"))


def score_raw(raw: DataFrame) -> DataFrame:
    """Adds outcome_score to raw sessions. Without turns only signals tell one from another."""
    none = F.array().cast("array<struct<from:string,value:string>>")
    return raw.withColumn("outcome_score", score.quality_score(none, F.coalesce("role", F.lit("unknown")), F.col("otel_signals")))


def score_only(spark: SparkSession, folder: str) -> None:
    """Reads raw sessions that an earlier run left in a folder and writes them with scores; fails if there are none."""
    write_json(score_raw(read_json(spark, f"{folder}/raw_sessions", RAW)), f"{folder}/raw_sessions_scored")


def write(final: DataFrame, path: str) -> None:
    """JSON lines by split and role."""
    final.select("conversations", "metadata", "split", "role").write.mode("overwrite").partitionBy("split", "role").json(path)
