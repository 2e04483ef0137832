"""Readers, and the whole curation plan over transcripts on disk."""

import json

import pytest
from pyspark.sql import functions as F

from turnloom.plans import curation
from turnloom.sources import lines, tables, transcripts


def record(kind, content=None, **more):
    return json.dumps({"type": kind, **({"message": {"content": content}} if content is not None else {}), **more})


@pytest.fixture
def base(tmp_path):
    folder = tmp_path / "-home-x-crew-amy"
    folder.mkdir()
    long = "some words about the work that was done here " * 4
    rows = [
        record("summary"), record("user", "   ", uuid="u0"), record("user", long, uuid="u1", sessionId="s1", cwd="/w"), "junk", "",
        json.dumps({"type": "assistant", "requestId": "r1", "uuid": "a1", "timestamp": "t1", "message": {"content": [{"type": "thinking", "thinking": "hidden"}, {"type": "text", "text": f" {long} "}]}}),
        json.dumps({"type": "user", "uuid": "u2", "message": {"content": ["loose", {"type": "tool_result", "tool_use_id": "1", "content": "fine", "is_error": True}, {"type": "text", "text": "see"}]}}),
        json.dumps({"type": "assistant", "requestId": "r1", "message": {"content": [{"type": "tool_use", "id": "1", "name": "mcp__prism-nvim__open", "input": {"path": "a", "content": "é"}}]}}),
        json.dumps({"type": "progress", "data": {"type": "mcp_progress", "serverName": "prism-nvim"}}), record("user", "first", uuid="u3"), record("user", "second", uuid="u3"),
        json.dumps({"type": "assistant", "uuid": "a9", "message": {"id": "m1", "content": [{"type": "text", "text": "gt done"}]}}),
    ]
    (folder / "one.jsonl").write_text("\n".join(rows))
    (folder / "sessions-index.jsonl").write_text(record("user", "no", uuid="x"))
    (folder / "empty.jsonl").write_text(record("progress"))
    return tmp_path


def test_sessions(spark, base):
    got = transcripts.read_sessions(spark, str(base)).collect()
    assert len(got) == 1
    s = got[0]
    assert (s.session_id, s.cwd, s.runtime_type, s.mcp_servers, s.total_records, s.conversation_records) == ("s1", "/w", "claudecode-nvim", ["prism-nvim"], 10, 8)
    assert [t.role for t in s.turns] == ["user", "assistant", "user", "user", "assistant"]
    assert s.turns[1].content.endswith('<tool_call name="mcp__prism-nvim__open" source="mcp" mcp_server="prism-nvim">\n{"path":"a","content":"é"}\n</tool_call>') and "hidden" not in s.turns[1].content
    assert s.turns[1].tool_calls[0].mcp_server == "prism-nvim" and s.turns[1].timestamp == "t1"
    assert s.turns[2].content == 'see\n<tool_result tool_use_id="1">\nfine\n</tool_result>' and s.turns[2].tool_results[0].is_error
    assert s.turns[3].content == "second" and s.turns[4].content == "gt done"


def test_curation(spark, base, tmp_path):
    prompts = spark.createDataFrame([("crew", "You are crew.")], "role string, prompt string")
    made = curation.samples(transcripts.read_sessions(spark, str(base)), prompts)
    final = curation.dataset(made)
    row = final.collect()[0]
    assert row.split == "val" and row.role == "crew" and [m["from"] for m in row.conversations] == ["system", "human", "gpt", "human", "gpt"] and row.conversations[0].value == "You are crew."
    assert 0 < row.metadata.quality_score <= 1 and row.metadata.outcome_score == pytest.approx(row.metadata.quality_score, abs=1e-3)
    curation.write(final, str(tmp_path / "out"))
    assert tables.general_samples(spark, str(tmp_path / "out" / "split=val" / "role=crew"), "crew").count() == 1
    assert {(r.stage, r.role): r.n for r in curation.stats(made, final).collect()} == {("before", "crew"): 1, ("val", "crew"): 1}


def test_evaluation_rows_get_defaults(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"input_ids": [1], "target_token_ids": [2]}\n\n{"input_ids": [1], "target_token_ids": [], "role": "r"}\nbad\n')
    got = sorted(tables.evaluation(spark, str(tmp_path / "e.jsonl")).collect(), key=lambda r: r.sample_id)
    assert [(r.sample_id, r.role, r.input_ids) for r in got] == [("sample_0000", "unknown", [1]), ("sample_0002", "r", [1])]


def test_formulas(spark, tmp_path):
    (tmp_path / "a.toml").write_text('formula = "f"\ntype = "workflow"\n[[steps]]\nid = "x"\nneeds = ["y"]\n[vars.v]\nrequired = true\ndefault = 1\n')
    (tmp_path / "b.toml").write_text("= broken")
    got = {r.formula: r for r in tables.formulas(spark, str(tmp_path / "*.toml")).collect()}
    assert got["f"].version == 0 and got["f"].steps[0].needs == ["y"] and got["f"].vars["v"].has_default and got["b.toml"].error


def test_rejections_push_the_role_down(spark, tmp_path):
    spark.createDataFrame([("s", "crew"), ("t", "mayor")], "session_id string, role string").write.parquet(str(tmp_path / "r"))
    got = tables.rejections(spark, str(tmp_path / "r"), "crew")
    assert [(r.session_id, r.target_logprobs) for r in got.collect()] == [("s", None)]
    assert "EqualTo(role,crew)" in got._jdf.queryExecution().toString()


def test_telemetry_and_logs(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"_msg": "done", "gt.session": "a", "gt.issue": "it-1", "exit_type": "COMPLETED"}\n')
    assert tables.telemetry(spark, str(tmp_path / "t.jsonl")).select("session_id", "issue").first() == ("a", "it-1")
    (tmp_path / "l.jsonl").write_text('{"session_id": "a", "role": "x"}\nbad\n{"role": "none"}\n')
    assert [tuple(r) for r in tables.local_log(spark, str(tmp_path / "l.jsonl"), "role").collect()] == [("a", 0, "x")]


def test_lines_keep_their_numbers(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n  [1]  \n')
    got = lines.json_lines(lines.read_lines(spark, str(tmp_path / "x.jsonl"))).orderBy("line_no").select("line_no", "is_valid").collect()
    assert [tuple(r) for r in got] == [(0, True), (2, False)]
    lines.write_json(spark.range(2).withColumn("k", F.col("id")), str(tmp_path / "o"), "k")
    assert lines.read_json(spark, str(tmp_path / "o"), "id long").count() == 2
