"""Rejected drafts as training samples: the target's answer in place of the draft, with the divergence of soft labels; and preference pairs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import SOFT_LABEL_WEIGHT, TRAINING_CONFIG
from .select import mix


def kl_divergence(draft: Column, target: Column) -> Column:
    """Sum of exp(t) * (t - d) over the shorter length, terms whose exp(t) is 0 left out, at least 0; 0 if one is null or empty."""
    n = F.least(F.size(draft), F.size(target))
    pairs = F.zip_with(F.slice(draft, 1, F.greatest(n, F.lit(0))), F.slice(target, 1, F.greatest(n, F.lit(0))), lambda d, t: F.when(F.exp(t) > 0, F.exp(t) * (t - d)).otherwise(0.0))
    total = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.greatest(total, F.lit(0.0))).otherwise(0.0)


def rejection_samples(rejections: DataFrame, prompts: DataFrame | None = None, default_prompt: str = "") -> DataFrame:
    """conversations and metadata of rejection rows; has_soft_labels where both log-probability lists are there."""
    from .chat import with_prompts

    rows = with_prompts(rejections.withColumnRenamed("prompt", "_question"), prompts, default_prompt) if prompts is not None else rejections.withColumnRenamed("prompt", "_question").withColumn("prompt", F.lit(default_prompt))
    say = lambda side, value: F.struct(F.lit(side).alias("from"), value.alias("value"))
    soft = (F.coalesce(F.size("draft_logprobs"), F.lit(0)) > 0) & (F.coalesce(F.size("target_logprobs"), F.lit(0)) > 0)
    msgs = F.filter(F.array(say("system", F.col("prompt")), say("human", F.col("_question")), say("gpt", F.col("target_response"))), lambda m: m.value.isNotNull())
    meta = F.struct("role", "session_id", F.lit("rejection").alias("source"), "rejection_reason", "acceptance_score", soft.alias("has_soft_labels"), F.when(soft, kl_divergence(F.col("draft_logprobs"), F.col("target_logprobs"))).alias("kl_divergence"))
    return rows.select(msgs.alias("conversations"), meta.alias("metadata"))


def role_summary(rejection: DataFrame, general: DataFrame) -> DataFrame:
    """Per role the counts of both sides and whether any sample has soft labels."""
    a = rejection.groupBy(F.col("metadata.role").alias("role")).agg(F.count("*").alias("n_rejection"), F.bool_or("metadata.has_soft_labels").alias("soft_labels"))
    b = general.groupBy(F.col("metadata.role").alias("role")).agg(F.count("*").alias("n_general"))
    return a.join(b, "role", "full_outer").select("role", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rejection", "n_general")), F.coalesce("soft_labels", F.lit(False)).alias("soft_labels"))


def mix_by_role(rejection: DataFrame, general: DataFrame, id_column: str, ratio: float = 0.9, seed: int = 42) -> DataFrame:
    """``mix`` within each role in one plan: general rows are ranked by seeded hash in their role, and as many stay as the ratio asks for."""
    from .select import seeded_key

    n = rejection.groupBy("role").agg(F.count("*").alias("_n"))
    ranked = general.withColumn("_rank", F.row_number().over(Window.partitionBy("role").orderBy(seeded_key(F.col(id_column), seed))))
    wanted = F.floor(F.col("_n") * F.lit((1 - ratio)) / F.lit(ratio))
    chosen = ranked.join(n, "role", "left").where(F.col("_n").isNull() | (F.col("_rank") <= wanted)).drop("_rank", "_n")
    return rejection.unionByName(chosen)


def preference_pairs(attempts: DataFrame, key: str, order: str, good: Column, prompt: str, answer: str) -> DataFrame:
    """(prompt, chosen, rejected): for each failed attempt at a key the first later one that went well (described only).

    One window a key, no self join: looking back from the end, the next success is known at every row.
    """
    ahead = Window.partitionBy(key).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    later = attempts.withColumn("_good", good).withColumn("_chosen", F.first(F.when(F.col("_good"), F.col(answer)), ignorenulls=True).over(ahead))
    return later.where(~F.col("_good") & F.col("_chosen").isNotNull()).select(key, order, F.col(prompt).alias("prompt"), F.col("_chosen").alias("chosen"), F.col(answer).alias("rejected"))


def training_config(role: str, data_path: str, output: str, soft_labels: bool, base_model: str = "base") -> dict:
    """A configuration for an adapter's training; divergence only weighs in with soft labels."""
    own = {"base_model": base_model, "datasets": [{"path": data_path, "type": "sharegpt", "conversation": "chatml"}], "dataset_prepared_path": f"{output}/prepared_{role}_rejection", "output_dir": f"{output}/{role}-rejection-v1"}
    return own | TRAINING_CONFIG | ({"kl_divergence_weight": SOFT_LABEL_WEIGHT} if soft_labels else {})


def write_config(config: dict, path: str) -> None:
    """One small YAML file for a tool outside Spark, written by the driver; JSON, which is YAML too, where no YAML library is there."""
    try:
        import yaml
    except ImportError:
        text = json.dumps(config, indent=2)
    else:
        text = yaml.safe_dump(config, sort_keys=False)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


__all__ = ["kl_divergence", "mix", "mix_by_role", "preference_pairs", "rejection_samples", "role_summary", "training_config", "write_config"]
