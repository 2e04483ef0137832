"""Evaluation: acceptance of drafts, expected behaviours, decisions parsed from model output, and their roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import BEHAVIOURS, TOOLS
from ..functions.text import hash_uniform, literal_pattern, values_at_ranks

# --- acceptance of draft tokens


def greedy_accepted(draft: Column, target: Column) -> Column:
    """Booleans, one for each place of the shorter list: are both tokens equal?"""
    n = F.greatest(F.least(F.size(draft), F.size(target)), F.lit(0))
    return F.zip_with(F.slice(draft, 1, n), F.slice(target, 1, n), lambda a, b: a == b)


def log_softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    total = F.ln(F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - top)))
    return F.transform(logits, lambda x: x - (top + total))


def acceptance_probability(tokens: Column, draft: Column, target: Column) -> Column:
    """min(1, exp(target - draft)) of each draft token's log-probabilities; an infinite ratio, or a token outside a vocabulary, counts as 0."""
    n = F.greatest(F.least(F.size(tokens), F.size(draft), F.size(target)), F.lit(0))

    def one(i: Column) -> Column:
        token = F.try_element_at(tokens, i)
        t, d = F.try_element_at(F.try_element_at(target, i), token + 1), F.try_element_at(F.try_element_at(draft, i), token + 1)
        ratio = t - d
        return F.when(ratio.isNotNull() & (F.abs(ratio) < F.lit(float("inf"))), F.least(F.lit(1.0), F.exp(ratio))).otherwise(0.0)

    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one)).otherwise(F.array().cast("array<double>"))


def stochastic_accepted(probabilities: Column, sample_id: Column, seed: int = 42) -> Column:
    """Draws by a uniform hash of seed, sample and place: the same on every run and in any order."""
    return F.transform(probabilities, lambda p, i: p > hash_uniform(F.lit(seed), sample_id, i))


def acceptance_report(results: DataFrame) -> DataFrame:
    """Overall (role null) and per role: samples, drafted, accepted and their ratio over all tokens; rows without draft tokens are left out."""
    rows = results.where("n_draft_tokens > 0")
    agg = rows.rollup("role").agg(F.count("*").alias("n_samples"), F.sum("n_draft_tokens").alias("n_draft_tokens"), F.sum("n_accepted").alias("n_accepted"))
    return agg.withColumn("acceptance_rate", F.col("n_accepted") / F.col("n_draft_tokens"))


# --- expected behaviours


def behaviour_pattern(behaviour: Column) -> Column:
    """A known phrase's command, else the first three words in order with anything between."""
    words = F.slice(F.filter(F.split(F.lower(behaviour), r"(?U)\s+"), lambda w: w != ""), 1, 3)
    out = F.array_join(F.transform(words, lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), ".*")
    for phrase, command in reversed(BEHAVIOURS):
        out = F.when(F.lower(behaviour).contains(phrase), F.lit(literal_pattern(command))).otherwise(out)
    return out


def behaviour_scores(responses: DataFrame) -> DataFrame:
    """Per (role, scenario): matched behaviours, total and score = matched / max(total, 1), from response and expected_behaviors."""
    each = responses.select("role", "scenario", "response", F.explode_outer("expected_behaviors").alias("behaviour"))
    hit = F.coalesce(F.expr("response rlike concat('(?is)', pattern)"), F.lit(False))
    return each.withColumn("pattern", behaviour_pattern(F.col("behaviour"))).withColumn("hit", hit & F.col("behaviour").isNotNull()).groupBy("role", "scenario").agg(
        F.count_if("hit").alias("matched"), F.count("behaviour").alias("total"), (F.count_if("hit") / F.greatest(F.count("behaviour"), F.lit(1))).alias("score"))


def behaviour_report(scores: DataFrame) -> DataFrame:
    """Mean of scenario scores, overall (role null) and per role."""
    return scores.rollup("role").agg(F.count("*").alias("n"), F.avg("score").alias("average"))


# --- decisions in model output


def _json_object(text: Column) -> Column:
    """The text if it is a JSON object, else null."""
    return F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), text)


def _tool_of(obj: Column) -> Column:
    return F.coalesce(F.get_json_object(obj, "$.tool"), F.get_json_object(obj, "$.name"), F.get_json_object(obj, "$.action"))


def _nonempty(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def parse_json_output(text: Column) -> Column:
    """The whole text, else the first flat object in it, else from the first brace to the last; null if none parses."""
    whole = F.when(F.try_parse_json(text).isNotNull(), text)
    flat = _nonempty(F.regexp_extract(text, r"\{[^{}]*\}", 0))
    greedy = _nonempty(F.regexp_extract(text, r"(?s)\{.*\}", 0))
    ok = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(whole, ok(flat), ok(greedy))


def parse_decision(text: Column) -> Column:
    """STRUCT<tool, args, source>: an object with a tool (or name, or action), a tool_call tag, a tool's name on a line of its own, or a gt command; null if none."""
    # bound to a variable, so that a long expression for the text is worked out once
    return F.transform(F.array(text), _decision)[0]


def _decision(text: Column) -> Column:
    def from_object(candidate: Column, needs_tool: bool, source: str) -> Column:
        obj = _json_object(candidate)
        tool = F.get_json_object(obj, "$.tool") if needs_tool else _tool_of(obj)
        return F.when(tool.isNotNull(), F.struct(tool.alias("tool"), F.coalesce(F.get_json_object(obj, "$.args"), F.lit("{}")).alias("args"), F.lit(source).alias("source")))

    direct = from_object(text, True, "json")
    inner = [from_object(_nonempty(F.regexp_extract(text, p, 0)), False, "json") for p in (r'(?s)\{"tool"[^}]*\}', r"(?s)\{[^{}]*\}", r"(?s)\{.*?\}", r"(?s)\{.*\}")]
    tag = r"""(?s)<tool_call\s+name=["']([^"']+)["']>(.*?)</tool_call>"""
    name, body = F.lower(_nonempty(F.regexp_extract(text, tag, 1))), F.regexp_replace(F.regexp_extract(text, tag, 2), r"^\s+|\s+$", "")
    verb = lambda x: F.concat(F.lit("gt_"), F.lower(_nonempty(F.regexp_extract(x, r"(?U)\bgt\s+(\w+)", 1))))
    inside = verb(F.coalesce(F.get_json_object(body, "$.command"), F.lit("")))
    mapped = F.when(name.isin(*TOOLS) & ~name.isin("bash"), name).when(name.isin("bash"), name).when(name == "computer", F.when(inside.isin(*TOOLS), inside).otherwise("bash")).otherwise(name)
    xml = F.when(name.isNotNull(), F.struct(mapped.alias("tool"), F.when(F.try_parse_json(body).isNotNull(), body).otherwise(F.to_json(F.struct(body.alias("raw")))).alias("args"), F.lit("xml").alias("source")))
    lines = F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.replace(F.lower(F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), F.lit("-"), F.lit("_")))
    alone = F.try_element_at(F.filter(lines, lambda x: x.isin(*TOOLS)), F.lit(1))
    plain = F.when(alone.isNotNull(), F.struct(alone.alias("tool"), F.lit("{}").alias("args"), F.lit("plain").alias("source")))
    command = verb(text)
    spoken = F.when(command.isin(*TOOLS), F.struct(command.alias("tool"), F.lit("{}").alias("args"), F.lit("gt_cmd").alias("source")))
    return F.coalesce(direct, *inner, xml, plain, spoken)


def decision_checks(parsed: Column, expected: Column) -> Column:
    """STRUCT<valid_json, valid_tool, correct_tool, has_args>."""
    no = F.lit(False)
    return F.struct(parsed.isNotNull().alias("valid_json"), F.coalesce(parsed.tool.isin(*TOOLS), no).alias("valid_tool"), F.coalesce(F.array_contains(expected, parsed.tool), no).alias("correct_tool"), F.coalesce(_json_object(parsed.args).isNotNull(), no).alias("has_args"))


def response_assertions(output: Column, allowed: Column, cost: Column, latency: Column, max_cost: float = 0.10, max_latency: int = 15_000) -> Column:
    """STRUCT of booleans: is JSON, has an action and a reason, an allowed action, cheap and quick enough."""
    obj, no = _json_object(output), F.lit(False)
    action, reason = F.get_json_object(obj, "$.action"), F.get_json_object(obj, "$.reason")
    return F.struct(obj.isNotNull().alias("is_json"), F.coalesce(action != "", no).alias("has_action"), F.coalesce(reason != "", no).alias("has_reason"), F.coalesce(F.array_contains(allowed, action), no).alias("is_allowed"), F.coalesce(cost <= max_cost, F.lit(True)).alias("is_cheap"), F.coalesce(latency <= max_latency, F.lit(True)).alias("is_quick"))


def scenario_summary(results: DataFrame) -> DataFrame:
    """Rates of checks, mean, median and 95th place of latency, over rows of checks and latency_ms."""
    rate = lambda c: F.avg(F.col(f"checks.{c}").cast("double")).alias(f"{c}_rate")
    means = results.agg(F.count("*").alias("n"), *(rate(c) for c in ("valid_json", "valid_tool", "correct_tool", "has_args")), F.avg("latency_ms").alias("mean_latency_ms"))
    places = values_at_ranks(results, "latency_ms", {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95})
    return means.withColumns({name: places.select(name).scalar() for name in places.columns})


def parse_sources(parsed: DataFrame, source: str = "source") -> DataFrame:
    """How decisions were found: (source, n), none for those that were not."""
    return parsed.groupBy(F.coalesce(F.col(source), F.lit("none")).alias("source")).agg(F.count("*").alias("n"))


def first_assistant(messages: DataFrame, conversation: str, position: str) -> DataFrame:
    """The first assistant message of each conversation."""
    first = F.min(F.when(F.col("role") == "assistant", F.struct(position, "text")))
    return messages.groupBy(conversation).agg(first.alias("m")).where("m is not null").select(conversation, F.col(f"m.{position}").alias(position), F.col("m.text").alias("text"))


def provider_summary(results: DataFrame) -> DataFrame:
    """Per provider: total, passed, failed, mean cost (3 places), mean latency, percent passed."""
    from ..functions.text import floor_round

    return results.groupBy("provider").agg(F.count("*").alias("total"), F.count_if("success").alias("passed"), F.count_if(~F.col("success")).alias("failed"), floor_round(F.avg("cost"), 3).alias("avg_cost"), F.floor(F.avg("latency_ms")).alias("avg_latency_ms"), F.floor(F.count_if("success") * 100 / F.count("*")).alias("pass_pct"))


def suite_breakdown(results: DataFrame, providers: list[str] | None = None) -> DataFrame:
    """Passed of total for each suite and provider, providers as columns."""
    cell = F.concat_ws("/", F.count_if("success"), F.count(F.lit(1)))
    grouped = results.groupBy("suite")
    return (grouped.pivot("provider", providers) if providers else grouped.pivot("provider")).agg(cell)


def failures(results: DataFrame, k: int = 20) -> DataFrame:
    """The first k descriptions with failures and the providers that failed."""
    return results.where(~F.col("success")).groupBy("description").agg(F.array_sort(F.collect_set("provider")).alias("providers"), F.count("*").alias("n")).orderBy("description").limit(k)


def prefer(rich: DataFrame, legacy: DataFrame, key: str = "name") -> DataFrame:
    """All rich rows and the legacy ones whose key no rich row has."""
    return rich.unionByName(legacy.join(rich.select(key), key, "left_anti"), allowMissingColumns=True)


def compare(old: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """Rows of both by key: old and new correctness, and whether it regressed."""
    both = old.select(key, F.col("correct").alias("old_correct")).join(new.select(key, F.col("correct").alias("new_correct")), key)
    return both.withColumn("regressed", F.col("old_correct") & ~F.col("new_correct"))


def calibration(pairs: DataFrame, a: str, b: str, gap: float = 0.4) -> DataFrame:
    """Correlation, mean absolute error and rows apart by over ``gap`` of two scores, with the gates' verdict (described only)."""
    out = pairs.agg(F.corr(a, b).alias("corr"), F.avg(F.abs(F.col(a) - F.col(b))).alias("mae"), F.count_if(F.abs(F.col(a) - F.col(b)) > gap).alias("disagreements"))
    return out.withColumn("verdict", F.when((F.col("corr") < 0.7) | (F.col("mae") > 0.2), "warn").when(F.col("corr") > 0.85, "trust").otherwise("ok"))
