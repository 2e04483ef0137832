"""Validation of chat samples: their structure, and the commands, workflows and faults in their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import ANTI_PATTERNS, BD_COMMAND, COVERAGE, GIT_COMMAND, GT_COMMAND, REQUIRED_COMMANDS, SUSPICIOUS_COMMANDS, WHOLE_COMMANDS, WORKFLOWS
from ..functions.text import contains_any, names_where, starts_any, strip
from ..sources.lines import json_lines


_MESSAGES = "array<struct<from:string,value:string>>"


def structure_errors(msgs: Column) -> Column:
    """Array of what is wrong: no list, too short, no system message first, unknown sides, blank values, sides out of turn, no gpt message last."""
    n = F.coalesce(F.size(msgs), F.lit(0))

    def of(i: Column) -> Column:
        m = F.try_element_at(msgs, i + 1)
        side, before = m["from"], F.try_element_at(msgs, F.greatest(i, F.lit(1)))["from"]
        where = F.concat(F.lit("message "), i.cast("string"), F.lit(": "))
        want = F.when(before == "human", "gpt").when(before.isin("gpt", "system"), "human")
        return F.array_compact(F.array(
            F.when(~F.coalesce(side.isin("system", "human", "gpt"), F.lit(False)), F.concat(where, F.lit("invalid from"))),
            F.when(F.coalesce(strip(m.value), F.lit("")) == "", F.concat(where, F.lit("empty value"))),
            F.when((i > 0) & want.isNotNull() & (F.coalesce(side, F.lit("")) != want), F.concat(where, F.lit("expected "), want)),
        ))

    each = F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), of))
    whole = F.array_compact(F.array(
        F.when(~F.coalesce(F.try_element_at(msgs, F.lit(1))["from"] == "system", F.lit(False)), F.lit("first message is not system")),
        F.when(~F.coalesce(F.try_element_at(msgs, F.lit(-1))["from"] == "gpt", F.lit(False)), F.lit("last message is not gpt")),
    ))
    return F.when(msgs.isNull(), F.array(F.lit("conversations is not a list"))).when(n < 2, F.array(F.lit("fewer than two messages"))).otherwise(F.concat(whole, each))


def totals(errors: DataFrame, column: str = "errors") -> DataFrame:
    """total, valid and errors over rows of error arrays."""
    return errors.agg(F.count("*").alias("total"), F.count_if(F.size(column) == 0).alias("valid"), F.coalesce(F.sum(F.size(column)), F.lit(0)).alias("errors"))


def numbered_errors(lines: DataFrame, k: int | None = None) -> DataFrame:
    """(source_path, line_no from 1, error) of JSON lines that are no JSON or break the structure of a sample; the first ``k`` of each file.

    ``lines`` as ``sources.lines.read_lines`` gives them.
    """
    rows = json_lines(lines).withColumn("conversations", F.from_json(F.get_json_object("line", "$.conversations"), _MESSAGES))
    errors = F.when(F.try_parse_json("line").isNull(), F.array(F.lit("invalid JSON"))).otherwise(structure_errors(F.when(F.col("is_valid"), F.col("conversations"))))
    out = rows.select("source_path", (F.col("line_no") + 1).alias("line_no"), F.posexplode(errors).alias("place", "error"))
    if k is not None:
        out = out.withColumn("_rank", F.row_number().over(Window.partitionBy("source_path").orderBy("line_no", "place"))).where(F.col("_rank") <= k).drop("_rank")
    return out.drop("place")


def file_totals(lines: DataFrame) -> DataFrame:
    """source_path, total, valid and errors of JSON-lines files; blank lines do not count."""
    bad = numbered_errors(lines).groupBy("source_path", "line_no").agg(F.count("*").alias("n"))
    bad = bad.groupBy("source_path").agg(F.count("*").alias("_bad"), F.sum("n").alias("errors"))
    return lines.groupBy("source_path").agg(F.count("*").alias("total")).join(bad, "source_path", "left").select("source_path", "total", (F.col("total") - F.coalesce("_bad", F.lit(0))).alias("valid"), F.coalesce("errors", F.lit(0)).alias("errors"))


def commands(text: Column) -> Column:
    """Commands in order: all of gt, then bd, then git. ``gt mail``, ``gt mol`` and ``gt handoff`` keep all their words, others two."""
    two = lambda c: F.array_join(F.slice(F.split(c, r"(?U)\s+"), 1, 2), " ")
    gt = F.regexp_extract_all(text, F.lit("(?U)" + GT_COMMAND), 0)
    gt = F.transform(gt, lambda c: F.when(starts_any(c, WHOLE_COMMANDS), c).otherwise(two(c)))
    bd = F.transform(F.regexp_extract_all(text, F.lit("(?U)" + BD_COMMAND), 0), two)
    git = F.transform(F.regexp_extract_all(text, F.lit("(?U)" + GIT_COMMAND), 0), two)
    return F.concat(gt, bd, git)


def short_commands(text: Column) -> Column:
    """Distinct commands of one or two words after gt and bd, one after git; sorted."""
    def of(tool: str, more: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(rf"(?U){tool}\s+\w+{more}"), 0)
        return F.transform(found, lambda c: F.regexp_replace(c, r"(?U)\s+", " "))

    return F.array_sort(F.array_distinct(F.concat(of("gt", r"(?:\s+\w+)?"), of("bd", r"(?:\s+\w+)?"), of("git", ""))))


def _found(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return names_where((name, text.rlike(f"(?isU){pattern}")) for name, pattern in rules)


def workflows(text: Column) -> Column:
    return _found(text, WORKFLOWS)


def anti_patterns(text: Column) -> Column:
    return _found(text, ANTI_PATTERNS)


def coverage(text: Column) -> Column:
    """Workflows of which any command occurs."""
    return names_where((name, contains_any(text, some)) for name, some in COVERAGE)


def full_text(msgs: Column) -> Column:
    return F.array_join(F.transform(F.filter(msgs, lambda m: m.value.isNotNull()), lambda m: m.value), "\n")


def check_sample(msgs: Column, role: Column, hallucinated: bool = False) -> Column:
    """STRUCT<commands, workflows, errors, warnings, is_valid>. With ``hallucinated``, also warns of commands that do not exist (ours)."""
    text = full_text(msgs)
    found = commands(text)
    faults = anti_patterns(text)
    missing = F.lit(None).cast("string")
    for name, needed in REQUIRED_COMMANDS.items():
        lacks = ~_any_of(found, needed)
        missing = F.when((role == name) & lacks & (F.size(found) > 0), F.lit(f"role '{name}' missing required commands")).otherwise(missing)
    many = F.transform(F.filter(F.transform(msgs, lambda m, i: F.struct(m.alias("m"), i.alias("i"))), lambda x: (x.m["from"] == "human") & (F.size(commands(x.m.value)) > 2)), lambda x: F.concat(F.lit("human message "), x.i.cast("string"), F.lit(" contains many commands")))
    warnings = F.concat(F.array_compact(F.array(missing)), many)
    if hallucinated:
        odd = F.filter(found, lambda c: starts_any(c, SUSPICIOUS_COMMANDS))
        warnings = F.concat(warnings, F.transform(odd, lambda c: F.concat(F.lit("possibly hallucinated command: "), c)))
    errors = F.transform(faults, lambda f: F.concat(F.lit("anti-pattern detected: "), f))
    return F.struct(F.array_distinct(found).alias("commands_found"), workflows(text).alias("workflows_detected"), errors.alias("errors"), warnings.alias("warnings"), (F.size(faults) == 0).alias("is_valid"))


def _any_of(found: Column, needed: tuple[str, ...]) -> Column:
    def one(c: Column) -> Column:
        return contains_any(c, needed)

    return F.exists(found, one)


def summary(checked: DataFrame) -> DataFrame:
    """(kind, name, n) of roles, commands (30 most frequent), workflows and anti-patterns over rows of role and check."""
    def counted(kind: str, column: Column) -> DataFrame:
        return checked.select(F.explode(column).alias("name")).groupBy("name").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "name", "n")

    roles = checked.groupBy(F.col("role").alias("name")).agg(F.count("*").alias("n")).select(F.lit("role").alias("kind"), "name", "n")
    used = counted("command", F.col("check.commands_found")).withColumn("_rank", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "name"))).where("_rank <= 30").drop("_rank")
    return roles.unionByName(used).unionByName(counted("workflow", F.col("check.workflows_detected"))).unionByName(counted("anti_pattern", F.col("check.errors")))
