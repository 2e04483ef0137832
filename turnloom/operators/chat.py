"""Chat samples: messages from turns, merged, alternating, with a system prompt and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prompts that are few enough to broadcast.
FEW = 1000
DEFAULT_PROMPT = "You are an agent. You use command-line tools to accomplish software engineering tasks."


def messages(turns: Column) -> Column:
    """Turns of users and assistants as (from, value); other roles are left out."""
    kept = F.filter(turns, lambda t: t.role.isin("user", "assistant"))
    return F.transform(kept, lambda t: F.struct(F.when(t.role == "user", "human").otherwise("gpt").alias("from"), t.content.alias("value")))


def merge_consecutive(msgs: Column) -> Column:
    """Neighbours from one side become one message, joined by a newline. Each message is copied once."""
    places = F.sequence(F.lit(1), F.greatest(F.size(msgs), F.lit(1)))
    starts = F.filter(places, lambda i: (i == 1) | (F.try_element_at(msgs, i)["from"] != F.try_element_at(msgs, F.greatest(i - 1, F.lit(1)))["from"]))

    def island(starts: Column) -> Column:
        def one(first: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(msgs) + 1)
            part = F.slice(msgs, first, F.greatest(end - first, F.lit(0)))
            return F.struct(F.try_element_at(msgs, first)["from"].alias("from"), F.array_join(F.transform(part, lambda m: m.value), "\n").alias("value"))

        return F.transform(starts, one)

    return F.when(F.size(msgs) > 0, F.transform(F.array(starts), island)[0]).otherwise(F.filter(msgs, lambda m: F.lit(False)))


def alternate(merged: Column) -> Column:
    """Merged messages without a leading gpt and without a trailing human one; empty if nothing else is left."""
    first = F.when(F.try_element_at(merged, F.lit(1))["from"] == "gpt", 2).otherwise(1)
    last = F.when(F.try_element_at(merged, F.lit(-1))["from"] == "human", F.size(merged) - 1).otherwise(F.size(merged))
    return F.slice(merged, first, F.greatest(last - first + 1, F.lit(0)))


def conversation(turns: Column, prompt: Column) -> Column:
    """System prompt and alternating messages; empty when no message is left."""
    msgs = alternate(merge_consecutive(messages(turns)))
    system = F.struct(F.lit("system").alias("from"), prompt.alias("value"))
    return F.when(F.size(msgs) > 0, F.concat(F.array(system), msgs)).otherwise(msgs)


def has_both_sides(msgs: Column) -> Column:
    return F.exists(msgs, lambda m: m["from"] == "human") & F.exists(msgs, lambda m: m["from"] == "gpt")


def with_prompts(df: DataFrame, prompts: DataFrame, default: str = DEFAULT_PROMPT) -> DataFrame:
    """Adds ``prompt`` by role, the default for roles without one; of a role that is there twice the smallest prompt counts.

    Up to ``FEW`` prompts go to every task; more are joined as a table.
    """
    named = prompts.groupBy("role").agg(F.min("prompt").alias("prompt"))
    named = F.broadcast(named) if prompts.limit(FEW + 1).count() <= FEW else named
    return df.join(named, "role", "left").withColumn("prompt", F.coalesce("prompt", F.lit(default)))


def format_samples(chunks: DataFrame, source: str = "claude-session") -> DataFrame:
    """conversations and metadata from rows of turns, prompt, role, session_id, chunk_index, quality_score, runtime_type,
    mcp_servers, outcome_score. Samples without both sides go.
    """
    meta = F.struct("role", "session_id", "chunk_index", "quality_score", F.lit(source).alias("source"), "runtime_type", "mcp_servers", "outcome_score")
    out = chunks.select(conversation(F.col("turns"), F.col("prompt")).alias("conversations"), meta.alias("metadata"), *[c for c in ("ordinal",) if c in chunks.columns])
    return out.where(has_both_sides(F.col("conversations")))


def flat_to_messages(msgs: Column, prompt: Column | None = None) -> Column:
    """(role, content) messages as (from, value), with another system text if one is given."""
    names = F.create_map(*(F.lit(x) for x in ("user", "human", "assistant", "gpt", "system", "system")))

    def one(m: Column) -> Column:
        value = m.content if prompt is None else F.when(m.role == "system", F.coalesce(prompt, m.content)).otherwise(m.content)
        return F.struct(F.coalesce(F.try_element_at(names, m.role), m.role).alias("from"), value.alias("value"))

    return F.transform(msgs, one)
