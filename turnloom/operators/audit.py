"""Audits of workflow definitions: structure, steps, variables and prompts, as findings.

``formulas`` has formula, type, description STRING, version INT, steps ARRAY<STRUCT<id, title, description, acceptance,
needs ARRAY<STRING>>>, vars MAP<STRING, STRUCT<description, required BOOLEAN, has_default BOOLEAN>>, and error STRING.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import CONTEXT_WORDS, FENCED_BLOCK, FORMULA_TYPES, INSTRUCTION_WORDS, PROMPT_WORDS, REQUIRED_FIELDS, SEVERITIES
from ..functions.text import contains_any, first_match

_FINDING = "struct<severity:string,category:string,location:string,issue:string>"
#: What to do about a finding, by how its issue begins.
ADVICE = (
    ("missing required field", "add the field"), ("invalid formula type", "use one of the known types"), ("version not specified", "give a version"), ("no steps defined", "define at least one step"),
    ("duplicate step id", "give each step an id of its own"), ("step missing title", "give the step a title"), ("step missing acceptance", "say when the step is done"),
    ("step references unknown", "name a step that comes before"), ("variable missing description", "describe the variable"), ("variable required but", "drop the default or the requirement"),
    ("empty prompt", "write the prompt or take it out"), ("unmatched variable", "close the placeholder"), ("prompt may lack", "say what must be done"), ("prompt might benefit", "add an example or the context"),
)


def _finding(when: Column, severity: str, category: str, location: Column, issue: Column) -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(category).alias("category"), location.alias("location"), issue.alias("issue")).cast(_FINDING))


def _blank(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) == ""


def _rows(df: DataFrame, findings: Column) -> DataFrame:
    return df.select("formula", F.explode(F.array_compact(findings)).alias("f")).select("formula", "f.*")


def structure_findings(formulas: DataFrame) -> DataFrame:
    """Required fields (a version of 0 counts as missing), an unknown type, no version."""
    lacks = {"formula": _blank(F.col("formula")), "type": _blank(F.col("type")), "version": F.coalesce("version", F.lit(0)) == 0, "description": _blank(F.col("description"))}
    some = [_finding(lacks[name], "high", "structure", F.lit("root"), F.lit(f"missing required field: {name}")) for name in REQUIRED_FIELDS]
    some.append(_finding(~_blank(F.col("type")) & ~F.col("type").isin(*FORMULA_TYPES), "medium", "structure", F.lit("type"), F.concat(F.lit("invalid formula type: "), F.col("type"))))
    some.append(_finding(F.col("version").isNull(), "low", "structure", F.lit("version"), F.lit("version not specified")))
    some.append(_finding(F.coalesce(F.size("steps"), F.lit(0)) <= 0, "medium", "workflow", F.lit("steps"), F.lit("no steps defined")))
    return _rows(formulas, F.array(*some))


def steps_of(formulas: DataFrame) -> DataFrame:
    """formula, pos, id (``step-<pos>`` if missing), title, acceptance, description, needs."""
    out = formulas.select("formula", F.posexplode("steps").alias("pos", "s"))
    return out.select("formula", "pos", F.coalesce("s.id", F.concat(F.lit("step-"), F.col("pos").cast("string"))).alias("id"), "s.title", "s.acceptance", "s.description", F.coalesce("s.needs", F.array().cast("array<string>")).alias("needs"))


def step_findings(formulas: DataFrame) -> DataFrame:
    """Repeated ids, missing titles and acceptance, and needs that no step up to this one has (later ones do not count)."""
    from pyspark.sql import Window

    steps = steps_of(formulas).withColumn("copy", F.row_number().over(Window.partitionBy("formula", "id").orderBy("pos")))
    place = F.concat(F.lit("step:"), F.col("id"))
    own = _rows(steps, F.array(
        _finding(F.col("copy") > 1, "high", "workflow", place, F.concat(F.lit("duplicate step id: "), F.col("id"))),
        _finding(_blank(F.col("title")), "low", "workflow", place, F.lit("step missing title")),
        _finding(_blank(F.col("acceptance")), "low", "workflow", place, F.lit("step missing acceptance criteria")),
    ))
    edges = steps.select("formula", "pos", "id", F.explode("needs").alias("need"))
    known = steps.groupBy("formula", F.col("id").alias("need")).agg(F.min("pos").alias("first"))
    loose = edges.join(known, ["formula", "need"], "left").where(F.col("first").isNull() | (F.col("first") > F.col("pos")))
    return own.unionByName(loose.select("formula", F.lit("medium").alias("severity"), F.lit("workflow").alias("category"), place.alias("location"), F.concat(F.lit("step references unknown dependency: "), F.col("need")).alias("issue")))


def var_findings(formulas: DataFrame) -> DataFrame:
    rows = formulas.select("formula", F.explode("vars").alias("name", "v"))
    place = F.concat(F.lit("vars:"), F.col("name"))
    return _rows(rows, F.array(
        _finding(_blank(F.col("v.description")), "low", "variables", place, F.lit("variable missing description")),
        _finding(F.coalesce(F.col("v.required") & F.col("v.has_default"), F.lit(False)), "low", "variables", place, F.lit("variable required but has default")),
    ))


def find_prompts(formulas: DataFrame) -> DataFrame:
    """formula, step_id, step_title, location, content of fenced blocks in step descriptions that read like prompts."""
    blocks = steps_of(formulas).select("formula", "pos", "id", "title", F.posexplode(F.regexp_extract_all(F.coalesce("description", F.lit("")), F.lit(FENCED_BLOCK), 1)).alias("block", "content"))
    like = blocks.where(contains_any(F.lower("content"), PROMPT_WORDS))
    return like.select("formula", F.col("id").alias("step_id"), F.coalesce("title", F.lit("")).alias("step_title"), F.concat(F.lit("step-"), F.col("pos"), F.lit("-block-"), F.col("block")).alias("location"), F.regexp_replace("content", r"^\s+|\s+\z", "").alias("content"))


def prompt_findings(prompts: DataFrame) -> DataFrame:
    text = F.coalesce("content", F.lit(""))
    full, place = text != "", F.coalesce("location", F.lit("unknown"))
    return _rows(prompts, F.array(
        _finding(~full, "high", "prompt", place, F.lit("empty prompt content")),
        _finding(full & text.contains("{{") & ~text.contains("}}"), "medium", "prompt", place, F.lit("unmatched variable placeholder")),
        _finding(full & ~contains_any(F.lower(text), INSTRUCTION_WORDS), "low", "prompt", place, F.lit("prompt may lack clear instructions")),
        _finding(full & ~contains_any(F.lower(text), CONTEXT_WORDS) & (F.length(text) > 100), "info", "prompt", place, F.lit("prompt might benefit from examples or context")),
    ))


def audit(formulas: DataFrame) -> DataFrame:
    """All findings; a definition that could not be read is one critical finding."""
    good = formulas.where("error is null")
    broken = formulas.where("error is not null").select("formula", F.lit("critical").alias("severity"), F.lit("structure").alias("category"), F.lit("file").alias("location"), F.col("error").alias("issue"))
    out = broken
    for part in (structure_findings(good), step_findings(good), var_findings(good), prompt_findings(find_prompts(good))):
        out = out.unionByName(part)
    return out.withColumn("recommendation", first_match(F.col("issue"), [("^" + start, advice) for start, advice in ADVICE], F.lit("mend the file")))


def severity_counts(findings: DataFrame) -> DataFrame:
    """severity and n, zeros included, in order of weight."""
    dim = findings.sparkSession.createDataFrame([(i, s) for i, s in enumerate(SEVERITIES)], "place int, severity string")
    return F.broadcast(dim).join(findings.groupBy("severity").agg(F.count("*").alias("n")), "severity", "left").orderBy("place").select("severity", F.coalesce("n", F.lit(0)).alias("n"))


def findings_markdown(findings: DataFrame) -> str:
    """A report of a few findings, on the driver."""
    lines = ["# Audit", "", *(f"- {r.severity}: {r.n}" for r in severity_counts(findings).collect()), ""]
    for r in findings.orderBy("formula", "location", "issue").toLocalIterator():
        lines.append(f"- [{r.severity}] {r.formula} ({r.location}): {r.issue}; {r.recommendation}")
    return "\n".join(lines)


def findings_json(findings: DataFrame) -> str:
    """Counts and findings of a few definitions, on the driver."""
    rows = [r.asDict() for r in findings.orderBy("formula", "location", "issue").toLocalIterator()]
    return json.dumps({"summary": {r.severity: r.n for r in severity_counts(findings).collect()}, "findings": rows}, indent=2)


def findings_console(findings: DataFrame) -> str:
    rows = [f"[{r.severity.upper()}] {r.formula} {r.location}: {r.issue}\n  {r.recommendation}" for r in findings.orderBy("formula", "location", "issue").toLocalIterator()]
    return "\n".join(rows) or "no findings"
