"""Outcome scores of a session at the level of turns, of steps and of the whole formula, and their weighted sum.

``signals`` is STRUCT<exit_type, status, duration_ms BIGINT, ...> or null; a struct of nulls only counts as none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.fixed import ARTIFACT_WORDS, DEFAULT_MEDIAN_MS, DEFAULT_TARGET_TURNS, ESCALATION_WORDS, MEDIAN_MS, TARGET_TURNS, WEIGHTS
from ..functions.text import clamp01, contains_any, count_present


def _is(msg: Column, side: str) -> Column:
    return F.coalesce(msg["from"] == side, F.lit(False))


def turn_score(msgs: Column) -> Column:
    """Tool calls that went well, and recoveries after those that did not, over all messages; 0.5 without messages."""
    n = F.size(msgs)
    at = lambda i: F.try_element_at(msgs, i + 1)
    text = lambda i: F.lower(F.coalesce(at(i).value, F.lit("")))
    calls = lambda i: _is(at(i), "gpt") & contains_any(F.coalesce(at(i).value, F.lit("")), ("tool_result", "tool_use_id")) & _is(at(i + 1), "human")
    failed = lambda i: contains_any(text(i + 1), ("error", "failed"))
    retried = lambda i: sum((F.when(_is(at(i + k), "gpt") & contains_any(text(i + k), ("retry", "attempt")), 1).otherwise(0) for k in (2, 3, 4)), F.lit(0)) > 0
    places = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    good = F.size(F.filter(places, lambda i: calls(i) & ~failed(i)))
    recovered = F.size(F.filter(places, lambda i: calls(i) & failed(i) & retried(i)))
    return F.when(n > 0, clamp01(F.lit(0.7) * (good / n) + F.lit(0.3) * (recovered / n))).otherwise(0.5)


def has_signals(signals: Column, fields: tuple[str, ...] = ("exit_type", "status", "topic", "duration_ms", "fallback_source", "role", "actor")) -> Column:
    """Whether any field is set."""
    return F.coalesce(*(signals[f].cast("string") for f in fields)).isNotNull()


def _completion(signals: Column, escalated: float) -> Column:
    kind = signals.exit_type
    done = F.when(F.coalesce(signals.status, F.lit("")) == "error", 0.7).otherwise(1.0)
    return F.when(kind == "COMPLETED", done).when(kind == "ESCALATED", escalated).when(kind == "DEFERRED", 0.3).otherwise(0.5)


def step_score(msgs: Column, signals: Column, present: Column) -> Column:
    text = F.lower(F.array_join(F.transform(msgs, lambda m: F.concat(F.coalesce(m.value, F.lit("")), F.lit(" "))), ""))
    artifacts = F.least(count_present(text, ARTIFACT_WORDS) / F.lit(3.0), F.lit(1.0))
    escalations = F.least(count_present(text, ESCALATION_WORDS) / F.lit(5.0), F.lit(1.0))
    return clamp01(F.when(present, _completion(signals, 0.6)).otherwise(artifacts * (F.lit(1.0) - escalations * F.lit(0.5))))


def _by_role(role: Column, table: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(role == name, value).otherwise(out)
    return out


def formula_score(msgs: Column, role: Column, signals: Column, present: Column) -> Column:
    """From completion and duration against the role's median (no duration: the best); else from the last message and the length."""
    median = _by_role(role, MEDIAN_MS, DEFAULT_MEDIAN_MS)
    took = F.coalesce(signals.duration_ms, F.lit(0).cast("long"))
    speed = F.when(took <= median, F.lit(1.0) - took / (F.lit(2) * median)).otherwise(F.lit(0.5) - F.least((took - median) / (F.lit(2) * median), F.lit(0.5)))
    n, target = F.size(msgs), _by_role(role, TARGET_TURNS, DEFAULT_TARGET_TURNS)
    length = F.when(n <= target, n / target).otherwise(F.lit(1.0) - F.least((n - target) / target, F.lit(0.5)))
    last = F.try_element_at(msgs, F.lit(-1))
    text = F.coalesce(last.value, F.lit(""))
    ends = F.when(text.contains("gt done") | F.lower(text).contains("completed"), 1.0).when(contains_any(F.lower(text), ("escalate", "help")), 0.6).otherwise(0.5)
    content = F.when(_is(last, "gpt"), ends).otherwise(0.5)
    return clamp01(F.when(present, F.lit(0.6) * _completion(signals, 0.7) + F.lit(0.4) * speed).otherwise(F.lit(0.7) * content + F.lit(0.3) * length))


def quality_score(msgs: Column, role: Column, signals: Column, weights: tuple[float, float, float] = WEIGHTS, present: Column | None = None) -> Column:
    present = has_signals(signals) if present is None else present
    parts = (turn_score(msgs), step_score(msgs, signals, present), formula_score(msgs, role, signals, present))
    return clamp01(sum((F.lit(w) * p for w, p in zip(weights[1:], parts[1:])), F.lit(weights[0]) * parts[0]))


def rubric(signals: dict[str, Column], weights: dict[str, float]) -> Column:
    """A weighted sum of named signals, nulls as 0 (described only; a dot product over any recipe of weights)."""
    return sum((F.lit(w) * F.coalesce(signals[k].cast("double"), F.lit(0.0)) for k, w in weights.items()), F.lit(0.0))


def with_review(score: Column, review: Column) -> Column:
    """Half the score, half an agent's review; the score alone where there is no review (described only)."""
    return F.coalesce((score + review) / 2, score)
