"""Rules that are described but not coded anywhere: what to do with scores, which sessions to take, how to weigh and review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .select import seeded_key

# Scores of a leg by how it ended
LEG_SCORES = {"merged": 0.8, "abandoned": 0.3, "reworked": 0.6, "first_try": 0.9}


def apply_policy(df: DataFrame, policy: str, threshold: float = 0.3, quality: str = "quality_score", outcome: str = "outcome_score") -> DataFrame:
    """``score_only`` leaves rows as they are, ``exclude_below`` drops outcomes under the threshold (null ones stay), ``downweight`` multiplies quality by outcome."""
    if policy == "score_only":
        return df
    if policy == "exclude_below":
        return df.where(F.col(outcome).isNull() | (F.col(outcome) >= threshold))
    if policy == "downweight":
        return df.withColumn(quality, F.col(quality) * F.coalesce(F.col(outcome), F.lit(1.0)))
    raise ValueError(f"unknown policy: {policy}")


def in_scope(scope: str, value: str | None = None, days: int = 7) -> Column:
    """A filter over role, convoy_id, ended_at, outcome_score: all, role, convoy, recent (days before now) or unscored."""
    filters = {
        "all": F.lit(True), "role": F.col("role") == value, "convoy": F.col("convoy_id") == value,
        "recent": F.col("ended_at") >= F.current_timestamp() - F.make_interval(days=F.lit(days)), "unscored": F.col("outcome_score").isNull(),
    } if scope in ("all", "role", "convoy", "recent", "unscored") else {}
    if not filters:
        raise ValueError(f"unknown scope: {scope}")
    return F.coalesce(filters[scope], F.lit(False))


def apply_scores(samples: DataFrame, scores: DataFrame, key: str = "session_id") -> DataFrame:
    """Outcome scores by session; sessions without one keep null."""
    return samples.drop("outcome_score").join(scores.select(key, "outcome_score"), key, "left")


def legs_of(convoys: DataFrame, sessions: DataFrame) -> DataFrame:
    """Each convoy's legs (array of leg ids) with the sessions that worked on them and the score of how they ended."""
    table = F.create_map(*(F.lit(x) for pair in LEG_SCORES.items() for x in pair))
    legs = convoys.select("convoy_id", F.explode("legs").alias("leg_id"))
    return legs.join(sessions, "leg_id", "left").withColumn("leg_score", F.try_element_at(table, F.col("ending")))


def scenario_score(required: Column, bonus: Column, efficiency: Column, no_forbidden: Column) -> Column:
    """0.6 required + 0.2 bonus + 0.1 efficiency + 0.1 if nothing forbidden was done; parts from 0 to 1."""
    return F.lit(0.6) * required + F.lit(0.2) * bonus + F.lit(0.1) * efficiency + F.lit(0.1) * F.when(no_forbidden, 1.0).otherwise(0.0)


def distinct_pairs(pairs: DataFrame, prompt: str = "prompt", order: str = "id", val_share: int = 10, seed: int = 42) -> DataFrame:
    """One pair a prompt, the first by ``order``, with a split of one in ``val_share`` by a seeded hash of the prompt."""
    packed = F.struct(order, *(c for c in pairs.columns if c not in (order, prompt)))
    first = pairs.groupBy(prompt).agg(F.min(packed).alias("_r")).select(prompt, "_r.*")
    return first.withColumn("split", F.when(F.conv(F.substring(seeded_key(F.col(prompt), seed), 1, 8), 16, 10).cast("long") % val_share == 0, "val").otherwise("train"))


def review_batch(scored: DataFrame, id_column: str, score: str, n: int = 50, calibration: int = 10, seed: int = 42) -> DataFrame:
    """The n lowest scores (ties by id) and, of the others, a seeded draw for calibration; ``kind`` says which."""
    low = scored.orderBy(score, id_column).limit(n).withColumn("kind", F.lit("review"))
    rest = scored.join(low.select(id_column), id_column, "left_anti")
    return low.unionByName(rest.withColumn("_o", seeded_key(F.col(id_column), seed)).orderBy("_o").limit(calibration).drop("_o").withColumn("kind", F.lit("calibration")))


def against_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Adds the group's median and the ratio to it (ours; the scorer uses constants)."""
    medians = df.groupBy(group).agg(F.percentile(value, F.lit(0.5)).alias("median"))
    return df.join(medians, group).withColumn("ratio", F.col(value) / F.col("median"))


def running_share(df: DataFrame, order: str, flag: Column) -> DataFrame:
    """Share of flagged rows up to each row of a day, by day: what a retraining trigger looks at."""
    w = Window.partitionBy(F.to_date(order)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("share", F.avg(F.when(flag, 1.0).otherwise(0.0)).over(w))
