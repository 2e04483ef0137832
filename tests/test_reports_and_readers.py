"""Readers of further formats, sinks, reports in their forms, the command line and the stream that asks for training."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from turnloom.functions.text import values_at_ranks
from turnloom.operators import audit, chat, evals, preference, roles, score, snapshot, stats, synth, validate
from turnloom.plans import audit_cli, curation
from turnloom.sources import lines, tables, transcripts
from turnloom.streaming import patrol


def test_values_at_ranks_match_sorted_lists(spark):
    for values in ([5], [1, 2], [3, 3, 1], list(range(100)), [7] * 20 + [1], []):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
        got = values_at_ranks(df, "v", {"p50": 0.5, "p95": 0.95, "first": 0.0}).first()
        s = sorted(values)
        assert tuple(got) == (tuple(s[int(q * len(s))] for q in (0.5, 0.95, 0.0)) if s else (None,) * 3)


def test_the_newest_files_and_missing_ones(spark, tmp_path):
    folder = tmp_path / "-x-crew-a"
    folder.mkdir()
    for k, name in enumerate(("a", "b", "c", "sessions-index")):
        (folder / f"{name}.jsonl").write_text('{"type": "user"}\n\nnot json\n')
        import os

        os.utime(folder / f"{name}.jsonl", (1000 + k, 1000 + k))
    found = lines.discover(lines.read_lines(spark, f"{tmp_path}/*/*.jsonl"), most=2)
    assert {(r.file_name, r.file_rank) for r in found.collect()} == {("c.jsonl", 1), ("b.jsonl", 2)}
    assert {r.line_no for r in found.collect()} == {0, 2}
    assert lines.read_existing(spark, str(tmp_path / "nowhere"), "a int").count() == 0
    with pytest.raises(AnalysisException):
        lines.read_json(spark, str(tmp_path / "nowhere"), "a int").count()


def test_metrics(spark, tmp_path):
    (tmp_path / "m.json").write_text("\n".join([
        json.dumps({"status": "success", "data": {"resultType": "vector", "result": [{"metric": {"__name__": "up", "job": "a"}, "value": [1700000000, "1"]}]}}),
        json.dumps({"status": "success", "data": {"resultType": "matrix", "result": [{"metric": {"job": "b"}, "values": [[1700000000, "2.5"], [1700000060, "NaN?"]]}]}}),
        json.dumps({"status": "error", "error": "no"}), "not json",
    ]))
    got = sorted((r.labels["job"], r.name, r.value, r.time.timestamp() % 100) for r in tables.metrics(spark, str(tmp_path / "m.json")).collect() if r.value is not None)
    assert [x[:3] for x in got] == [("a", "up", 1.0), ("b", None, 2.5)] and tables.metrics(spark, str(tmp_path / "m.json")).count() == 3


def test_both_transcript_formats_are_one_union(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "s.jsonl").write_text("\n".join(json.dumps(x) for x in [
        {"type": "session", "id": "S", "cwd": "/a/witness", "version": 3}, {"type": "message", "id": "1", "timestamp": "t1", "message": {"role": "user", "content": "hello"}},
        {"type": "message", "id": "2", "message": {"role": "assistant", "content": [{"type": "text", "text": "I look\n"}, {"type": "toolCall", "id": "c", "name": "bash", "arguments": {"command": "ls"}}]}},
        {"type": "model_change", "id": "3"}, {"type": "message", "id": "4", "message": {"role": "toolResult", "toolCallId": "c", "content": [{"type": "text", "text": "a b"}], "isError": True}},
        {"type": "message", "id": "5", "message": {"role": "user", "content": "  "}},
    ]))
    rows = lines.discover(lines.read_lines(spark, f"{tmp_path}/*/*.jsonl"))
    s = transcripts.event_sessions(rows).first()
    assert (s.session_id, s.cwd, s.total_records, s.conversation_records) == ("S", "/a/witness", 6, 4)
    assert [(t.role, t.content) for t in s.turns] == [("user", "hello"), ("assistant", 'I look\n<tool_call name="bash" source="standard">\n{"command":"ls"}\n</tool_call>'), ("user", '<tool_result tool_use_id="c">\na b\n</tool_result>')]
    assert s.turns[1].tool_calls[0].name == "bash" and s.turns[2].tool_results[0].is_error
    both = transcripts.sessions(transcripts.records(rows)).unionByName(transcripts.event_sessions(rows))
    assert both.count() == 1 and spark.createDataFrame([("/a/crew/x",), ("/a",)], "c string").select(roles.role_from_cwd(F.col("c"))).collect() == [("crew",), (None,)]


def test_score_only_reads_what_a_run_left(spark, tmp_path):
    raw = spark.createDataFrame([("a", "/x", 3, "claudecode", [], "crew", ("COMPLETED", "", None, 0, None, None, None)), ("b", "/y", 1, "claudecode", [], None, None)], curation.RAW)
    lines.write_json(raw, f"{tmp_path}/raw_sessions")
    curation.score_only(spark, str(tmp_path))
    got = {r.session_id: round(r.outcome_score, 6) for r in lines.read_json(spark, f"{tmp_path}/raw_sessions_scored", curation.RAW + ", outcome_score double").collect()}
    assert got["a"] == 0.85 and 0 <= got["b"] < 0.5
    with pytest.raises(AnalysisException):
        curation.score_only(spark, str(tmp_path / "none"))


TOML = 'formula = "f"\ntype = "workflow"\nversion = 1\ndescription = "d"\n[[steps]]\nid = "a"\ntitle = ""\nacceptance = "done"\nneeds = ["z"]\n'


def test_audit_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "f.toml").write_text(TOML)
    (tmp_path / "broken.toml").write_text("a = [")
    assert audit_cli.main(["validate", str(tmp_path / "f.toml")], spark) == 1
    said = capsys.readouterr().out
    assert "[MEDIUM] f step:a: step references unknown dependency: z\n  name a step that comes before" in said and "[LOW] f step:a: step missing title" in said
    assert audit_cli.main(["report", str(tmp_path), "-f", "json", "-o", str(tmp_path / "out")], spark) == 0
    made = json.loads((tmp_path / "out" / "audit.json").read_text())
    assert made["summary"] == {"critical": 1, "high": 0, "medium": 1, "low": 1, "info": 0} and all(f["recommendation"] for f in made["findings"])
    assert audit_cli.main(["run", str(tmp_path)], spark) == 1 and "- critical: 1" in capsys.readouterr().out
    (tmp_path / "f.toml").write_text(TOML.replace('title = ""', 'title = "t"').replace('needs = ["z"]', ""))
    assert audit_cli.main(["validate", str(tmp_path / "f.toml")], spark) == 0 and "no findings" in capsys.readouterr().out


def test_reports_in_all_forms(spark):
    msgs = "array<struct<from:string,value:string>>"
    sample = ([("system", "s"), ("human", "gt hook please"), ("gpt", "<tool_call name='x'>")], ("crew", 0.4, "chat"))
    df = spark.createDataFrame([sample, sample], f"conversations {msgs}, metadata struct<role:string,quality_score:double,source:string>")
    found = stats.report(df, ["one issue"])
    assert json.loads(stats.to_json(found))["stats"]["total_samples"] == 2 and found["stats"]["median_quality"] == 0.4
    text = stats.to_console(found)
    assert "role crew: 2" in text and "advice: crew dominates the dataset (100.0%)" in text and "advice: 1 data quality issues" in text
    assert "## recommendations" in stats.to_markdown(found)


def test_balance(spark):
    df = spark.createDataFrame([("a", 1)] * 30 + [("b", 2)] * 18 + [("c", 1)], "x string, y int")
    assert {(r.kind, r.name): r.advice for r in stats.balance(df, "x").collect()} == {("x", "a"): "dominates", ("x", "b"): "balanced", ("x", "c"): "collect more"}


def test_training_configuration(tmp_path):
    plain, soft = (preference.training_config("crew", "d.jsonl", "/out", x) for x in (False, True))
    assert "kl_divergence_weight" not in plain and soft["kl_divergence_weight"] == 0.5 and soft["lora_r"] == 64 and soft["output_dir"] == "/out/crew-rejection-v1"
    preference.write_config(soft, str(tmp_path / "c.yaml"))
    text = (tmp_path / "c.yaml").read_text()
    assert "kl_divergence_weight" in text and "d.jsonl" in text


def test_samples_that_name_commands_that_do_not_exist(spark):
    msgs = "array<struct<from:string,value:string>>"
    df = spark.createDataFrame([([("human", "gt tool now and gt hook"), ("gpt", "git push origin main")], "polecat"), ([("human", "hi"), ("gpt", "ok")], "crew")], f"m {msgs}, role string")
    got = [r.c for r in df.select(validate.check_sample(F.col("m"), F.col("role"), True).alias("c")).collect()]
    assert "possibly hallucinated command: gt tool" in got[0].warnings and got[0].errors == ["anti-pattern detected: wrong_git_workflow"] and not got[0].is_valid
    assert got[1].is_valid and got[1].warnings == []


def test_flat_messages_rubric_and_review(spark):
    df = spark.createDataFrame([([("system", "s"), ("user", "u"), ("assistant", "a"), ("tool", "t")], 0.4, 0.8, None)], "m array<struct<role:string,content:string>>, x double, r double, z double")
    r = df.select(chat.flat_to_messages(F.col("m"), F.lit("new")).alias("m"), score.with_review(F.col("x"), F.col("r")).alias("both"), score.with_review(F.col("x"), F.col("z")).alias("one"), score.rubric({"a": F.col("x"), "b": F.col("z")}, {"a": 0.5, "b": 0.5}).alias("rubric")).first()
    assert [tuple(x) for x in r.m] == [("system", "new"), ("human", "u"), ("gpt", "a"), ("tool", "t")]
    assert (round(r.both, 6), r.one, r.rubric) == (0.6, 0.4, 0.2)


def test_commands_of_a_patrol(spark):
    rows = spark.createDataFrame([("gt peek a",), ("gt nudge b",), ("bd list --label cleanup",), ("ls",)], "c string")
    got = [tuple(r) for r in rows.select(snapshot.is_gather(F.col("c")), snapshot.is_action(F.col("c")), snapshot.gather_section(F.col("c"))).collect()]
    assert got == [(True, False, "Polecats"), (False, True, None), (True, False, "Cleanup Wisps"), (False, False, None)]


def test_synthetic_samples_hold_prompts_and_answers(spark):
    made = synth.generate(spark, 3000).cache()
    rows = made.collect()
    assert {r.template for r in rows} == {t[0] for t in synth.TEMPLATES} and not any("{rig}" in r.prompt + r.answer for r in rows)
    kinds = {t[0]: t[1] for t in synth.TEMPLATES}
    for r in rows:
        assert json.loads(r.answer)["tool"] == r.tool and (kinds[r.template] == "legacy" or r.prompt.startswith("## Polecats\n")) and (synth.FAULT in r.prompt) == r.corrupted
    checked = synth.samples(made).select(F.size(validate.structure_errors(F.col("conversations"))).alias("n")).agg(F.max("n")).first()[0]
    parsed = made.select("tool", evals.parse_decision(F.col("answer")).alias("d")).where("d.tool != tool").count()
    assert checked == 0 and parsed == 0


def test_stream_asks_for_training(spark, tmp_path):
    (tmp_path / "in").mkdir()
    known = spark.createDataFrame([("crew", 20), ("mayor", 500)], "role string, known long")
    (tmp_path / "in" / "a.json").write_text("\n".join(['{"role": "crew"}'] * 2 + ['{"role": "mayor"}'] * 3 + ['{"role": "new"}']))
    stream = patrol.retrain_stream(spark.readStream.schema("role string").json(str(tmp_path / "in")), known)
    q = stream.writeStream.format("memory").queryName("due").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.role: (r.new, r.due) for r in spark.table("due").collect()} == {"crew": (2, True), "mayor": (3, False), "new": (1, True)}


def test_audit_findings_name_what_to_do(spark):
    findings = spark.createDataFrame([("f", "low", "c", "l", "step missing title", "x")], "formula string, severity string, category string, location string, issue string, recommendation string")
    assert "x" in audit.findings_markdown(findings) and json.loads(audit.findings_json(findings))["summary"]["low"] == 1
