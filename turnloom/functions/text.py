"""Text and number expressions with the semantics the operators need, all in built-in functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Unicode white space off both ends (``trim`` takes spaces only)."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+", ""), r"(?U)[\s\x1c-\x1f]+\z", "")


def first_line(text: Column) -> Column:
    return F.split(text, "\n", 2)[0]


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | text.contains(n)
    return out


def starts_any(text: Column, starts: Iterable[str]) -> Column:
    out = F.lit(False)
    for s in starts:
        out = out | text.startswith(s)
    return out


def hash_uniform(*parts: Column) -> Column:
    """From 0 to under 1: the first 32 bits of the SHA-256 of the parts, joined by colons. The same in any engine."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", *(p.cast("string") for p in parts)), 256), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def values_at_ranks(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row: for each name sorted[int(share x n)] of the non-null values, by counting equal values first.

    Only the distinct values are put in order, each with how many rows lie below it; none of the rows is collected.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    upto = counts.withColumn("_to", F.sum("_n").over(Window.orderBy("_v"))).withColumn("_all", F.sum("_n").over(Window.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    at = lambda share: F.min(F.when(F.col("_to") > F.least(F.floor(F.col("_all") * F.lit(share)), F.col("_all") - 1), F.col("_v")))
    return upto.agg(*(at(share).alias(name) for name, share in shares.items()))


def count_present(text: Column, needles: Iterable[str]) -> Column:
    """How many of the needles occur in the text at all."""
    return sum((F.when(text.contains(n), 1).otherwise(0) for n in needles), F.lit(0))


def floor_round(x: Column, places: int) -> Column:
    """Half-up rounding by floor, which engines agree on bit for bit."""
    scale = float(10**places)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def first_match(text: Column, rules: Iterable[tuple[str, str]], default: Column | None = None) -> Column:
    """The value of the first rule whose pattern is found; null or ``default`` if none is."""
    out = F.lit(None).cast("string") if default is None else default
    for pattern, value in reversed(list(rules)):
        out = F.when(text.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def literal_pattern(text: str) -> str:
    """A pattern that matches the text itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def names_where(pairs: Iterable[tuple[str, Column]]) -> Column:
    """The names whose condition holds, in order."""
    return F.filter(F.array(*(F.when(cond, F.lit(name)) for name, cond in pairs)), lambda x: x.isNotNull())
