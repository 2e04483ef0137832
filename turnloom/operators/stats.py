"""Statistics and reports over chat samples: counts, lengths, upper medians, commands, coverage, recommendations."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import floor_round, values_at_ranks
from .validate import coverage, full_text, short_commands


def sample_facts(samples: DataFrame) -> DataFrame:
    """Per sample: role, source, quality_score, turns (not system), chars, tool_calls (gpt messages that call a tool)."""
    msgs, meta = F.col("conversations"), F.col("metadata")
    return samples.select(
        F.coalesce(meta.role, F.lit("unknown")).alias("role"), F.coalesce(meta.source, F.lit("unknown")).alias("source"), F.coalesce(meta.quality_score, F.lit(0.0)).alias("quality_score"),
        F.size(F.filter(msgs, lambda m: m["from"] != "system")).alias("turns"), F.aggregate(msgs, F.lit(0), lambda a, m: a + F.length(F.coalesce(m.value, F.lit("")))).alias("chars"),
        F.size(F.filter(msgs, lambda m: (m["from"] == "gpt") & m.value.contains("<tool_call"))).alias("tool_calls"), "conversations",
    )


def dataset_stats(facts: DataFrame) -> DataFrame:
    """One row: samples, turns and chars (min, max, mean, upper median), tokens of four characters, quality over scores that are not 0, samples with tool calls.

    A median needs sorted values; counting equal values first keeps the sorted list as short as there are different lengths.
    """
    q = F.when(F.col("quality_score") != 0, F.col("quality_score"))
    return facts.agg(
        F.count("*").alias("total_samples"), F.min("turns").alias("min_turns"), F.max("turns").alias("max_turns"), floor_round(F.avg("turns"), 1).alias("mean_turns"), median_by_counts("turns").alias("median_turns"),
        F.min("chars").alias("min_chars"), F.max("chars").alias("max_chars"), floor_round(F.avg("chars"), 0).alias("mean_chars"), F.sum("chars").alias("total_chars"), F.floor(F.sum("chars") / 4).alias("approx_tokens"),
        F.min(q).alias("min_quality"), F.max(q).alias("max_quality"), floor_round(F.avg(q), 3).alias("mean_quality"), F.count_if(F.col("tool_calls") > 0).alias("tool_call_samples"), F.sum("tool_calls").alias("total_tool_calls"),
        floor_round(F.count_if(F.col("tool_calls") > 0) / F.greatest(F.count("*"), F.lit(1)), 3).alias("tool_call_ratio"),
    )


def median_by_counts(column: str) -> Column:
    """Upper median as an exact percentile: the value at place n div 2 of n sorted ones. Built-in ``percentile`` keeps counts by value, not rows."""
    # percentile interpolates between places (n - 1) * p; the upper median is the larger of the two middle values
    n, p = F.count(column), F.percentile(column, F.lit(0.5))
    above = F.percentile(column, F.lit(0.5)) * 2 - _lower_median(column)
    return F.when(n % 2 == 1, p).otherwise(above)


def _lower_median(column: str) -> Column:
    return F.expr(f"percentile_disc(0.5) within group (order by `{column}`)")


def counts(facts: DataFrame, column: str) -> DataFrame:
    return facts.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def command_frequency(samples: DataFrame, k: int | None = 50) -> DataFrame:
    """In how many samples each command occurs; the k most frequent, ties by name."""
    out = samples.select(F.explode(short_commands(full_text(F.col("conversations")))).alias("command")).groupBy("command").agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), "command").limit(k) if k else out


def workflow_coverage(samples: DataFrame) -> DataFrame:
    return samples.select(F.explode(coverage(full_text(F.col("conversations")))).alias("workflow")).groupBy("workflow").agg(F.count("*").alias("n"))


def report(samples: DataFrame, issues: list[str] = ()) -> dict:
    """All parts as one dictionary: the driver's view of a few aggregated rows."""
    facts = sample_facts(samples)
    stats = dataset_stats(facts).first().asDict()
    med = values_at_ranks(facts.where("quality_score != 0"), "quality_score", {"median_quality": 0.5}).first()[0]
    used = {r.command: r.n for r in command_frequency(samples, None).collect()}
    out = {
        "stats": stats | {"median_quality": med}, "role_distribution": {r.role: r.n for r in counts(facts, "role").collect()}, "source_distribution": {r.source: r.n for r in counts(facts, "source").collect()},
        "unique_commands": len(used), "top_commands": dict(sorted(used.items(), key=lambda x: (-x[1], x[0]))[:50]), "by_type": {t: sum(c.startswith(t + " ") for c in used) for t in ("gt", "bd", "git")},
        "workflow_coverage": {r.workflow: r.n for r in workflow_coverage(samples).collect()},
    }
    out["recommendations"] = recommendations(out, list(issues))
    out["potential_issues"] = list(issues)[:20]
    return out


_SHARES = (("collect more", 5), ("dominates", 50))


def balance(df: DataFrame, *columns: str) -> DataFrame:
    """(kind, name, n, advice) of the values of each column: under 5 percent collect more, over 50 it dominates."""
    out = None
    for c in columns:
        part = df.groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).select(F.lit(c).alias("kind"), "name", "n")
        out = part if out is None else out.unionByName(part)
    share = F.col("n") * 100 / F.sum("n").over(Window.partitionBy("kind"))
    return out.withColumn("advice", F.when(share < _SHARES[0][1], _SHARES[0][0]).when(share > _SHARES[1][1], _SHARES[1][0]).otherwise("balanced"))


def recommendations(found: dict, issues: list[str]) -> list[str]:
    """What to improve: roles under 5 or over 50 percent, low quality, few tool calls, no completed workflow, issues, few commands."""
    total, out = sum(found["role_distribution"].values()) or 1, []
    for role, n in found["role_distribution"].items():
        share = 100 * n / total
        if share < _SHARES[0][1]:
            out.append(f"collect more {role} samples ({share:.1f}%)")
        elif share > _SHARES[1][1]:
            out.append(f"{role} dominates the dataset ({share:.1f}%)")
    mean = found["stats"]["mean_quality"]
    if mean is not None and mean < 0.5:
        out.append(f"mean quality is low ({mean:.2f})")
    if found["stats"]["tool_call_ratio"] < 0.1:
        out.append("few samples call tools")
    if not found["workflow_coverage"].get("polecat_complete"):
        out.append("no completed polecat workflow")
    if issues:
        out.append(f"{len(issues)} data quality issues")
    if found["unique_commands"] < 10:
        out.append("few different commands")
    return out


def to_markdown(found: dict) -> str:
    """The report for reading."""
    lines = ["# Dataset report", ""]
    for key, value in found.items():
        lines.append(f"## {key.replace('_', ' ')}")
        if isinstance(value, dict):
            lines += ["| name | value |", "|-|-|", *(f"| {k} | {v} |" for k, v in value.items())]
        elif isinstance(value, list):
            lines += [f"- {x}" for x in value] or ["none"]
        else:
            lines.append(str(value))
        lines.append("")
    return "\n".join(lines)


def to_json(found: dict) -> str:
    return json.dumps(found, indent=2, default=str)


def to_console(found: dict) -> str:
    """The report as short lines: counts first, advice last."""
    lines = [f"{k}: {v}" for k, v in found["stats"].items()]
    lines += [f"role {k}: {v}" for k, v in found["role_distribution"].items()]
    return "\n".join(lines + [f"advice: {x}" for x in found["recommendations"]])
