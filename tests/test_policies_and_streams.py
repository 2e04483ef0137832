"""Described rules, and streams with event time."""

import pytest
from pyspark.sql import functions as F

from turnloom.operators import policies
from turnloom.streaming import patrol


def test_score_policies(spark):
    df = spark.createDataFrame([(1, 0.8, 0.2), (2, 0.8, 0.5), (3, 0.8, None)], "id int, quality_score double, outcome_score double")
    assert policies.apply_policy(df, "score_only").count() == 3
    assert sorted(r.id for r in policies.apply_policy(df, "exclude_below", 0.3).collect()) == [2, 3]
    assert {r.id: round(r.quality_score, 6) for r in policies.apply_policy(df, "downweight").collect()} == {1: 0.16, 2: 0.4, 3: 0.8}
    with pytest.raises(ValueError):
        policies.apply_policy(df, "other")


def test_scopes(spark):
    df = spark.sql("select * from values (1, 'crew', 'c1', current_timestamp(), 0.5D), (2, 'mayor', null, timestamp'2001-01-01', null) as t(id, role, convoy_id, ended_at, outcome_score)")
    ids = lambda *a: sorted(r.id for r in df.where(policies.in_scope(*a)).collect())
    assert ids("all") == [1, 2] and ids("role", "crew") == [1] and ids("convoy", "c1") == [1] and ids("recent") == [1] and ids("unscored") == [2]
    with pytest.raises(ValueError):
        policies.in_scope("other")


def test_legs_and_scenarios(spark):
    convoys = spark.createDataFrame([("c", ["l1", "l2"])], "convoy_id string, legs array<string>")
    sessions = spark.createDataFrame([("l1", "s1", "merged"), ("l3", "s2", "abandoned")], "leg_id string, session_id string, ending string")
    assert sorted((r.leg_id, r.session_id, r.leg_score) for r in policies.legs_of(convoys, sessions).collect()) == [("l1", "s1", 0.8), ("l2", None, None)]
    one = spark.range(1).select(policies.scenario_score(F.lit(1.0), F.lit(0.5), F.lit(1.0), F.lit(True)).alias("s")).first().s
    assert one == pytest.approx(0.9)


def test_review_batch_and_shares(spark):
    df = spark.range(100).withColumn("score", F.col("id") % 10)
    got = policies.review_batch(df, "id", "score", 12, 5).collect()
    assert sorted(r.id for r in got if r.kind == "review") == [0, 1, 10, 11, *range(20, 100, 10)] and sum(r.kind == "calibration" for r in got) == 5 and len({r.id for r in got}) == 17
    pairs = policies.distinct_pairs(df.select("id", (F.col("id") % 7).cast("string").alias("prompt")))
    assert sorted(r.id for r in pairs.collect()) == list(range(7))


def test_event_time_windows_and_deduplication(spark, tmp_path):
    rows = spark.sql("select * from values (timestamp'2024-01-01 00:01:00', 'a', 'h1'), (timestamp'2024-01-01 00:04:00', 'a', 'h1'), (timestamp'2024-01-01 00:11:00', 'b', 'h2') as t(ts, kind, hash)")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

    def run(df, name, mode):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name).collect()

    assert sorted((r.kind, r.n) for r in run(patrol.windowed_counts(source(), "ts", "10 minutes", None, "1 hour", "kind"), "counts", "complete")) == [("a", 2), ("b", 1)]
    assert sorted(r.hash for r in run(patrol.deduplicated_stream(source(), "hash", "ts"), "unique", "append")) == ["h1", "h2"]
