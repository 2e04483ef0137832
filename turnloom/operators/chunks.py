"""Overlapping windows of turns that do not part a tool call from its result and keep to a character budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import STRIDE, WINDOW, WINDOW_CHARS


def _trimmed(part: Column, max_chars: int) -> Column:
    """Turns off the end while over budget, two stay."""
    sizes = F.transform(part, lambda t: F.length(t.content))
    fits = F.filter(F.sequence(F.lit(2), F.greatest(F.size(part), F.lit(2))), lambda n: F.aggregate(F.slice(sizes, 1, n), F.lit(0), lambda a, x: a + x) <= max_chars)
    return F.slice(part, 1, F.greatest(F.coalesce(F.array_max(fits), F.lit(2)), F.lit(2)))


def chunks_of(turns: Column, window: int = WINDOW, stride: int = STRIDE, max_chars: int = WINDOW_CHARS) -> Column:
    """Array of arrays of turns. At most ``window`` turns are one chunk, as they are."""
    n = F.size(turns)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(stride)), lambda s: (s == 0) | (n - s >= 2))

    def cut(start: Column) -> Column:
        end = F.least(start + window, n)
        last, after = F.try_element_at(turns, end), F.try_element_at(turns, end + 1)
        parts = (last.role == "assistant") & (F.size(last.tool_calls) > 0) & (after.role == "user") & (F.size(after.tool_results) > 0)
        end = F.when((end < n) & F.coalesce(parts, F.lit(False)), end + 1).otherwise(end)
        return _trimmed(F.slice(turns, start + 1, end - start), max_chars)

    many = F.filter(F.transform(starts, cut), lambda c: F.size(c) >= 2)
    return F.when(n <= window, F.array(turns)).otherwise(many)


def chunk_turns(df: DataFrame, window: int = WINDOW, stride: int = STRIDE, max_chars: int = WINDOW_CHARS) -> DataFrame:
    """A row for each chunk, with chunk_index (from 0) and total_chunks; the other columns are repeated."""
    others = [c for c in df.columns if c != "turns"]
    cut = df.withColumn("_chunks", chunks_of(F.col("turns"), window, stride, max_chars))
    return cut.select(*others, F.size("_chunks").alias("total_chunks"), F.posexplode("_chunks").alias("chunk_index", "turns"))


def row_chunks(rows: DataFrame, key: str, position: str, window: int, stride: int) -> DataFrame:
    """The same windows over rows in place of arrays: (key, chunk_index, position), by a window function and an equi-free explode.

    ``position`` counts from 0 in each key.
    """
    n = F.count("*").over(Window.partitionBy(key))
    low = F.greatest(F.lit(0), F.ceil((F.col(position) - (window - 1)) / stride).cast("int"))
    high = F.floor(F.col(position) / stride).cast("int")
    last = F.when(F.col("_n") <= window, 0).otherwise(F.floor((F.col("_n") - 2) / stride).cast("int"))
    numbered = rows.withColumn("_n", n)
    spread = numbered.withColumn("chunk_index", F.explode(F.when(F.least(high, last) >= low, F.sequence(low, F.least(high, last))).otherwise(F.array().cast("array<int>"))))
    return spread.drop("_n")
