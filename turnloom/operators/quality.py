"""Quality of a list of turns: gates with reasons, and a heuristic score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.fixed import BOILERPLATE, MIN_CHARS, MIN_SUBSTANTIVE, MIN_TURNS
from ..functions.text import first_line, floor_round, strip


def is_boilerplate(content: Column) -> Column:
    line = strip(first_line(content))
    out = F.lit(False)
    for pattern in BOILERPLATE:
        out = out | line.rlike(pattern)
    return out


def is_substantive(turn: Column) -> Column:
    text = strip(turn.content)
    return ((turn.role == "assistant") & ~is_boilerplate(text)) | ((turn.role == "user") & ~is_boilerplate(text) & ~text.startswith("<tool_result"))


def assess(turns: Column, outcome: Column | None = None) -> Column:
    """STRUCT<keep, score, reason, outcome_score>. With an outcome that is not null it is the score; the gates are the same."""
    n = F.size(turns)
    substantive = F.size(F.filter(turns, is_substantive))
    chars = F.aggregate(turns, F.lit(0), lambda a, t: a + F.length(strip(t.content)))
    calls = F.aggregate(turns, F.lit(0), lambda a, t: a + F.when((t.role == "assistant"), F.greatest(F.coalesce(F.size(t.tool_calls), F.lit(0)), F.lit(0))).otherwise(0))
    reason = F.when(n < MIN_TURNS, "too few turns").when(substantive < MIN_SUBSTANTIVE, "too few substantive turns").when(chars < MIN_CHARS, "content too short").otherwise("")
    score = F.when(n < MIN_TURNS, 0.0).when(reason != "", 0.1).otherwise(floor_round(heuristic(n, substantive, chars, calls), 3))
    outcome = F.lit(None).cast("double") if outcome is None else outcome
    return F.struct((reason == "").alias("keep"), F.coalesce(F.when(reason == "", floor_round(outcome, 3)).otherwise(outcome), score).alias("score"), reason.alias("reason"), outcome.alias("outcome_score"))


def heuristic(n: Column, substantive: Column, chars: Column, calls: Column) -> Column:
    """Share of substantive turns, tool calls up to ten, mean length up to 500 and turns up to twenty, as one number from 0 to 1."""
    least = lambda x: F.least(x, F.lit(1.0))
    n = F.greatest(n, F.lit(1))
    return F.lit(0.3) * least(substantive / n) + F.lit(0.3) * least(calls / F.lit(10)) + F.lit(0.2) * least(chars / n / F.lit(500)) + F.lit(0.2) * least(n / F.lit(20))


def is_error_loop(turns: Column) -> Column:
    """The last three stripped contents are one and the same text, not empty."""
    last = F.transform(F.slice(turns, -3, 3), lambda t: strip(t.content))
    return F.when(F.size(turns) >= 3, (F.size(F.array_distinct(last)) == 1) & (last[0] != "")).otherwise(False)


def fits_long_context(turns: Column, max_tokens: int = 50_000) -> Column:
    """Turns are there, are no error loop, and have at most so many tokens of four characters."""
    chars = F.aggregate(turns, F.lit(0).cast("long"), lambda a, t: a + F.length(t.content))
    return (F.size(turns) > 0) & (F.floor(chars / 4) <= max_tokens) & ~is_error_loop(turns)
