"""Choosing samples: keep-first deduplication, head split, seeded order and mixing, top k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEPARATOR = "\n---\n"


def answer_hash(msgs: Column) -> Column:
    """16 hex digits over the gpt values in order; all samples without any share one."""
    values = F.transform(F.filter(msgs, lambda m: m["from"] == "gpt"), lambda m: m.value)
    return F.substring(F.sha2(F.array_join(values, _SEPARATOR), 256), 1, 16)


def keep_first(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """The first row of each key by ``order``.

    A struct minimum per key, combined before the shuffle, finds the survivors; no window holds a key's rows together.
    """
    keyed = df.withColumn("_key", key)
    packed = F.struct(*order, *(c for c in df.columns if c not in order))
    return keyed.groupBy("_key").agg(F.min(packed).alias("_row")).select(*(F.col(f"_row.`{c}`") for c in df.columns))


def keep_first_wide(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """The same where rows hold columns that cannot be compared (maps): by rank in the key; the plan keeps one row a key and task before the shuffle."""
    keyed = df.withColumn("_key", key)
    return keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).where("_rank = 1").drop("_key", "_rank")


def with_ordinal(df: DataFrame, group: str, *order: str) -> DataFrame:
    """``ordinal`` from 0 over all rows in order of ``group``, then ``order``, without one task holding all rows.

    Rows are numbered in their group; counts a group, summed up in order of groups, are added. The groups' counts are
    one row a group.
    """
    counts = df.groupBy(group).count()
    below = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_group"), F.coalesce(F.sum("count").over(below), F.lit(0)).alias("_start"))
    inside = df.withColumn("_place", F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1)
    return inside.join(starts, F.col(group).eqNullSafe(F.col("_group"))).withColumn("ordinal", F.col("_start") + F.col("_place")).drop("_group", "_start", "_place")


def head_split(df: DataFrame, share: int = 20) -> DataFrame:
    """``split`` = val for the first max(1, n div share) rows by ``ordinal``, train for the rest; no random choice."""
    n = df.count()
    return df.withColumn("split", F.when(F.col("ordinal") < max(1, n // share), "val").otherwise("train"))


def session_split(df: DataFrame, session: str, share: int = 20) -> DataFrame:
    """``split`` by a hash of the session, so that overlapping chunks never straddle it (ours; an alternative to head_split)."""
    return df.withColumn("split", F.when(F.pmod(F.xxhash64(F.col(session)), F.lit(share)) == 0, "val").otherwise("train"))


def seeded_key(id_column: Column, seed: int) -> Column:
    """Rows ordered by this are shuffled, the same each time."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), id_column.cast("string")), 256)


def mix(rejected: DataFrame, general: DataFrame, id_column: str, ratio: float = 0.9, seed: int = 42) -> DataFrame:
    """All rejected rows and so many general ones, without replacement, that the rejected make up ``ratio``; all general ones if they are fewer.

    One side empty: the other as it is. Membership follows a seeded hash.
    """
    n, m = rejected.count(), general.count()
    if not n or not m:
        return general if not n else rejected
    wanted = int(n * (1 - ratio) / ratio)
    chosen = general.withColumn("_order", seeded_key(F.col(id_column), seed)).orderBy("_order").limit(wanted).drop("_order") if wanted < m else general
    return rejected.unionByName(chosen)


def top_counts(df: DataFrame, column: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values; ties by value."""
    return df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), column).limit(k)
