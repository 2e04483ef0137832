"""Behaviour of single operators on small fixtures, expected values worked out by hand or by plain models."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from turnloom.operators import audit, chat, chunks, evals, link, preference, quality, roles, score, scrub, select, snapshot, stats, synth, tool_text, validate
from turnloom.streaming import patrol

TURN = "role string, content string, tool_calls array<struct<id:string>>, tool_results array<struct<tool_use_id:string>>"
TURNS = f"id int, turns array<struct<{TURN.replace(' string', ':string').replace(' array', ':array')}>>"


def turn(role, content="x", calls=0, results=0):
    return (role, content, [("c",)] * calls, [("r",)] * results)


def column(spark, values, schema, f):
    rows = spark.createDataFrame(list(enumerate(values)), f"id int, x {schema}").select("id", f(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows)]


def test_roles(spark):
    rows = spark.createDataFrame([
        ("-home-x-deacon-dogs-boot", ""), ("-home-x-deacon-dogs-alpha", ""), ("-home-x-deacon", ""), ("-home-x-mayor", ""), ("-home-x-refinery-rig", ""), ("-home-x-crew-amy", ""), ("-home-x-polecats-p", ""),
        ("-home-x", "[SOME TOWN] Witness <- human"), ("-home-x", "[SOME TOWN] nobody <- human"), ("-home-x-witness", "[SOME TOWN] mayor <- human"), ("-home-x", ""),
    ], "folder string, text string")
    got = [r[0] for r in rows.select(roles.tag_role(F.col("folder"), F.col("text"))).collect()]
    assert got == ["boot", "deacon", "deacon", "mayor", "refinery", "crew", "polecat", "witness", "unknown", "witness", "unknown"]
    assert rows.limit(1).select(roles.folder_suffix_role(F.col("folder"), "-home-x-")).first()[0] == "deacon-dogs-boot"


def test_tool_results_are_cleaned_and_cut(spark):
    long = "a" * 3000
    texts = ["plain", '<tool_result tool_use_id="1">\nok\n</tool_result>', f"x<tool_result a>\n{long}\n</tool_result>y<tool_result b>\nShell cwd was reset to /\nkeep $1 \\2\n</tool_result>", "<tool_result>\n</tool_result>"]
    got = column(spark, texts, "string", lambda x: tool_text.normalize(x, 1000))
    assert got[0] == texts[0] and got[1] == texts[1] and got[3] == texts[3]
    assert got[2] == "x<tool_result a>\n" + "a" * 600 + "\n... [truncated] ...\n" + "a" * 380 + "\n</tool_result>y<tool_result b>\nkeep $1 \\2\n</tool_result>"
    assert column(spark, ["abc"], "string", lambda x: tool_text.cut_result(x, 0)) == ["\n... [truncated] ...\n"]


def model_chunks(turns, window, stride, budget):
    if len(turns) <= window:
        return [turns]
    out, k = [], 0
    while k == 0 or len(turns) - k >= 2:
        if k >= len(turns):
            break
        end = min(k + window, len(turns))
        if end < len(turns) and turns[end - 1][0] == "assistant" and turns[end - 1][2] and turns[end][0] == "user" and turns[end][3]:
            end += 1
        part = list(turns[k:end])
        while sum(len(t[1]) for t in part) > budget and len(part) > 2:
            part.pop()
        if len(part) >= 2:
            out.append(part)
        k += stride
    return out


def test_chunks_match_a_plain_model(spark):
    rng, cases = random.Random(1), []
    for _ in range(60):
        cases.append([turn(rng.choice(["user", "assistant"]), "x" * rng.randint(0, 30), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(rng.randint(1, 14))])
    df = spark.createDataFrame(list(enumerate(cases)), TURNS)
    for window, stride, budget in ((4, 2, 60), (2, 1, 10), (5, 3, 10**6)):
        got = {}
        for r in chunks.chunk_turns(df, window, stride, budget).orderBy("id", "chunk_index").collect():
            got.setdefault(r.id, []).append([tuple(t[:2]) for t in r.turns])
        for i, case in enumerate(cases):
            assert got.get(i, []) == [[t[:2] for t in c] for c in model_chunks(case, window, stride, budget)]


def test_row_chunks_agree_with_array_chunks(spark):
    rows = spark.createDataFrame([(k, p) for k, n in ((1, 3), (2, 4), (3, 9), (4, 10)) for p in range(n)], "k int, p int")
    got = {}
    for r in chunks.row_chunks(rows, "k", "p", 4, 2).collect():
        got.setdefault(r.k, {}).setdefault(r.chunk_index, []).append(r.p)
    for k, n in ((1, 3), (2, 4), (3, 9), (4, 10)):
        want = model_chunks([("user", str(p), [], []) for p in range(n)], 4, 2, 10**6)
        assert [sorted(got[k][c]) for c in sorted(got[k])] == [[int(t[1]) for t in c] for c in want]


def model_chat(turns):
    msgs = []
    for role, content, *_ in turns:
        side = {"user": "human", "assistant": "gpt"}.get(role)
        if side and msgs and msgs[-1][0] == side:
            msgs[-1] = (side, msgs[-1][1] + "\n" + content)
        elif side:
            msgs.append((side, content))
    if msgs and msgs[0][0] == "gpt":
        msgs = msgs[1:]
    if msgs and msgs[-1][0] == "human":
        msgs = msgs[:-1]
    return [("system", "p"), *msgs] if msgs else []


def test_conversations_match_a_plain_model(spark):
    rng = random.Random(2)
    cases = [[turn(rng.choice(["user", "assistant", "other"]), str(i)) for i in range(rng.randint(0, 8))] for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(cases)), TURNS)
    got = {r.id: [tuple(m) for m in r.c] for r in df.select("id", chat.conversation(F.col("turns"), F.lit("p")).alias("c")).collect()}
    assert got == {i: model_chat(c) for i, c in enumerate(cases)}


def test_quality_gates_and_scores(spark):
    long = "word " * 60
    cases = [[turn("user")], [turn("user", "Nothing on hook"), turn("assistant", long)], [turn("user", "hi"), turn("assistant", "ho")], [turn("user", long), turn("assistant", long, calls=5)], []]
    df = spark.createDataFrame([(i, c, None) for i, c in enumerate(cases)] + [(9, cases[3], 0.85), (10, cases[0], 0.7)], TURNS + ", outcome double")
    got = {r.id: r.q for r in df.select("id", quality.assess(F.col("turns"), F.col("outcome")).alias("q")).collect()}
    assert [(got[i].keep, got[i].reason, got[i].score) for i in range(3)] == [(False, "too few turns", 0.0), (False, "too few substantive turns", 0.1), (False, "content too short", 0.1)]
    chars = len(long.strip())
    assert got[3].keep and math.isclose(got[3].score, math.floor((0.3 + 0.15 + 0.2 * min(chars / 500, 1) + 0.02) * 1000 + 0.5) / 1000)
    assert got[4].reason == "too few turns" and got[9].keep and got[9].score == 0.85 and not got[10].keep and got[10].score == 0.7
    loops = spark.createDataFrame([(0, [turn("user", "a ")] * 3), (1, [turn("user", "a"), turn("user", "b"), turn("user", "b")]), (2, [turn("user", " ")] * 3)], TURNS)
    assert [r[0] for r in loops.select(quality.is_error_loop(F.col("turns"))).collect()] == [True, False, False]


def test_outcome_scores(spark):
    schema = "id int, m array<struct<from:string,value:string>>, s struct<exit_type:string,status:string,topic:string,duration_ms:bigint,fallback_source:string,role:string,actor:string>"
    none = (None,) * 7
    df = spark.createDataFrame([
        (0, [], none), (1, [], ("COMPLETED", None, None, 300_000, None, None, None)), (2, [], ("COMPLETED", "error", None, None, None, None, None)), (3, [], ("ESCALATED", None, None, 1_200_000, None, None, None)),
        (4, [("gpt", "I wrote and created it; stuck"), ("human", "ok"), ("gpt", "gt done")], none), (5, [("gpt", "tool_result"), ("human", "Error"), ("gpt", "hm"), ("human", "x"), ("gpt", "RETRY")], none),
    ], schema)
    m, s = F.col("m"), F.col("s")
    got = {r.id: r for r in df.select("id", score.turn_score(m).alias("t"), score.step_score(m, s, score.has_signals(s)).alias("st"), score.formula_score(m, F.lit("unknown"), s, score.has_signals(s)).alias("f"), score.quality_score(m, F.lit("unknown"), s).alias("q")).collect()}
    assert math.isclose(got[0].q, 0.3 * 0.5 + 0.3 * 0.35) and math.isclose(got[1].f, 0.6 + 0.4 * 0.75) and got[1].st == 1.0 and got[2].st == 0.7
    assert math.isclose(got[2].f, 0.6 * 0.7 + 0.4) and got[3].st == 0.6 and math.isclose(got[3].f, 0.6 * 0.7 + 0.4 * 0.0)
    assert math.isclose(got[4].st, 2 / 3 * 0.9) and math.isclose(got[4].f, 0.7 + 0.3 * 3 / 15)
    assert math.isclose(got[5].t, 0.3 * 1 / 5)


def test_deduplication_split_and_mix(spark):
    msgs = "id int, c array<struct<from:string,value:string>>"
    df = spark.createDataFrame([(1, [("human", "q"), ("gpt", "A")]), (2, [("gpt", "B")]), (3, [("human", "other"), ("gpt", "A")]), (4, [("human", "x")]), (5, [])], msgs)
    assert sorted(r.id for r in select.keep_first(df, select.answer_hash(F.col("c")), "id").collect()) == [1, 2, 4]
    assert df.where("id = 5").select(select.answer_hash(F.col("c"))).first()[0] == "e3b0c44298fc1c14"
    n = spark.range(45).withColumn("g", F.floor(F.col("id") / 10))
    split = select.head_split(select.with_ordinal(n, "g", "id")).collect()
    assert sorted(r.id for r in split if r.split == "val") == [0, 1] and all(r.ordinal == r.id for r in split)
    a, b = spark.range(90).select(F.col("id"), F.lit("r").alias("s")), spark.range(100, 200).select(F.col("id"), F.lit("g").alias("s"))
    mixed = select.mix(a, b, "id")
    assert mixed.count() == 90 + int(90 * (1 - 0.9) / 0.9) and select.mix(a.limit(0), b, "id").count() == 100 and select.mix(a, b.limit(0), "id").count() == 90
    assert sorted(r.id for r in mixed.collect()) == sorted(r.id for r in select.mix(a, b, "id").collect())


def test_structure_errors(spark):
    s, h, g = ("system", "s"), ("human", "h"), ("gpt", "g")
    cases = [[s, h, g], [h, g], [s, g, h, g], [s, h], [s, h, ("gpt", " ")], [s], None, [s, ("bot", "x"), g]]
    got = column(spark, cases, "array<struct<from:string,value:string>>", lambda x: F.size(validate.structure_errors(x)))
    assert got == [0, 1, 1, 1, 1, 1, 1, 2]


def test_commands_and_samples(spark):
    text = "gt mail send mayor now\nbd show x1 and git commit -m done"
    assert column(spark, [text], "string", validate.commands) == [["gt mail send mayor now\nbd show x1 and git commit", "bd show", "git commit"]]
    assert column(spark, ["gt hook; gt hook bd close a git push"], "string", validate.short_commands) == [sorted(["gt hook", "gt hook bd", "bd close a", "git push"])]
    msgs = [[("system", ""), ("human", "gt hook; bd ready; git status"), ("gpt", "ask for confirmation")], [("human", "x"), ("gpt", "bd show 1")]]
    got = column(spark, msgs, "array<struct<from:string,value:string>>", lambda x: validate.check_sample(x, F.lit("crew")))
    assert not got[0].is_valid and got[0].warnings == ["human message 1 contains many commands"] and got[1].is_valid and got[1].warnings == ["role 'crew' missing required commands"]
    checked = spark.createDataFrame([(m,) for m in msgs], "m array<struct<from:string,value:string>>").select(F.lit("crew").alias("role"), validate.check_sample(F.col("m"), F.lit("crew")).alias("check"))
    assert {(r.kind, r.name): r.n for r in validate.summary(checked).collect()}[("role", "crew")] == 2


def test_upper_median(spark):
    for values in ([1, 2, 3, 4], [5, 1, 3], [2, 2, 9, 9], [7]):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        assert df.agg(stats.median_by_counts("v")).first()[0] == sorted(values)[len(values) // 2]


def test_report(spark):
    meta = ("crew", "s", 0, 0.4, "x", "r", [], None)
    rows = [([("system", "p"), ("human", "gt hook"), ("gpt", "<tool_call a> gt done")], meta), ([("human", "a"), ("gpt", "b")], meta[:3] + (0.0,) + meta[4:])]
    from turnloom.sources.tables import SAMPLE

    got = stats.report(spark.createDataFrame(rows, SAMPLE), ["bad line"])
    assert got["stats"]["total_samples"] == 2 and got["stats"]["tool_call_samples"] == 1 and got["stats"]["median_quality"] == 0.4 and got["top_commands"] == {"gt done": 1, "gt hook": 1}
    assert "crew dominates the dataset (100.0%)" in got["recommendations"] and "# Dataset report" in stats.to_markdown(got)


def test_linking(spark):
    schema = "session_id string, message string, time string, exit_type string, status string, topic string, issue string, stream string, ordinal int"
    events = spark.createDataFrame([
        ("a", "done", None, "", None, None, None, '{gt.issue="it-9",x="y"}', 0), ("a", "done", None, "COMPLETED", "ok", "t", "it-1", "", 1), ("a", "session.start", "2024-01-01T00:00:00Z", None, None, None, None, None, 2),
        ("a", "session.stop", "2024-01-01T00:00:05.250Z", None, None, None, None, None, 3), ("a", "session.stop", "junk", None, None, None, None, None, 4), ("b", "done", None, "DEFERRED", None, None, None, "", 5),
    ], schema)
    costs = spark.createDataFrame([("b", 0, "old"), ("b", 1, "crew"), ("c", 0, "mayor")], "session_id string, line_no int, role string")
    commands = spark.createDataFrame([("c", 0, "me"), ("d", 0, "you")], "session_id string, line_no int, actor string")
    sessions = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "session_id string")
    got = {r.session_id: r for r in link.link(sessions, events, costs, commands).collect()}
    assert got["a"].bead_id == "it-9" and got["a"].otel_signals[:4] == ("COMPLETED", "ok", "t", 5250) and got["a"].otel_signals.fallback_source is None
    assert got["b"].otel_signals.role == "crew" and got["c"].otel_signals[4:] == ("costs.jsonl", "mayor", "me") and got["d"].otel_signals[4:] == ("cmd-usage.jsonl", None, "you") and not any(got["e"].otel_signals)


def test_divergence_and_acceptance(spark):
    pairs = [([-1.0, -2.0], [-1.0, -2.0]), ([-3.0, -1.0], [-1.0]), ([], [-1.0]), (None, [-1.0]), ([-1.0], [-2000.0])]
    df = spark.createDataFrame(pairs, "d array<double>, t array<double>")
    got = [r[0] for r in df.select(preference.kl_divergence(F.col("d"), F.col("t"))).collect()]
    assert got[0] == 0 and math.isclose(got[1], math.exp(-1) * 2) and got[2:] == [0, 0, 0]
    ok = spark.createDataFrame([([1, 2, 3], [1, 9, 3, 4])], "a array<int>, b array<int>").select(evals.greedy_accepted(F.col("a"), F.col("b"))).first()[0]
    assert ok == [True, False, True]
    logits = spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>").select(evals.log_softmax(F.col("x"))).first()[0]
    assert math.isclose(sum(map(math.exp, logits)), 1)
    p = spark.createDataFrame([([0, 5, 1], [[-1.0, -2.0]] * 3, [[-2.0, -1.0], [-1.0, -1.0], [float("-inf")] * 2])], "k array<int>, d array<array<double>>, t array<array<double>>").select(evals.acceptance_probability(F.col("k"), F.col("d"), F.col("t"))).first()[0]
    assert math.isclose(p[0], math.exp(-1)) and p[1] == 0 and p[2] == 0


def test_rejections_and_pairs(spark):
    from turnloom.sources.tables import REJECTION

    df = spark.createDataFrame([("s", "crew", "q", "draft", "target", "why", 0.2, [-1.0], [-2.0]), ("s2", "x", "q", "draft", "target", "why", 0.2, None, None)], REJECTION)
    got = sorted(preference.rejection_samples(df, default_prompt="p").collect(), key=lambda r: r.metadata.session_id)
    assert [m.value for m in got[0].conversations] == ["p", "q", "target"] and got[0].metadata.has_soft_labels and got[1].metadata.kl_divergence is None
    general = spark.createDataFrame([("crew", i) for i in range(50)] + [("lone", 1)], "role string, id int")
    rejected = spark.createDataFrame([("crew", 1000 + i) for i in range(90)], "role string, id int")
    mixed = preference.mix_by_role(rejected, general, "id")
    assert mixed.where("role = 'crew'").count() == 90 + 9 and mixed.where("role = 'lone'").count() == 1


def test_decisions(spark):
    said = ['{"tool": "none"}', 'so {"action": "gt_peek", "args": {"a": 1}} then', "<tool_call name='Bash'>{\"command\": \"ls\"}</tool_call>", "x\nBD-SHOW\n", "I run gt nudge", "nothing", '{"x": 1}']
    got = column(spark, said, "string", evals.parse_decision)
    assert [g and (g.tool, g.source) for g in got] == [("none", "json"), ("gt_peek", "json"), ("bash", "xml"), ("bd_show", "plain"), ("gt_nudge", "gt_cmd"), None, None]
    assert json.loads(got[1].args) == {"a": 1}
    ok = column(spark, ['{"action": "wait", "reason": "r"}', "no"], "string", lambda x: evals.response_assertions(x, F.array(F.lit("wait")), F.lit(0.05), F.lit(20_000)))
    assert tuple(ok[0]) == (True, True, True, True, True, False) and not ok[1].is_json


def test_scenarios(spark):
    rows = spark.createDataFrame([("a", "s1", "I ran GT HOOK.\nfine", ["Runs gt hook", "reads mail soon today"]), ("a", "s2", "", []), ("b", "s3", "reads the mail soon", ["reads mail soon today"])], "role string, scenario string, response string, expected_behaviors array<string>")
    scores = evals.behaviour_scores(rows)
    assert {r.scenario: (r.matched, r.total, r.score) for r in scores.collect()} == {"s1": (1, 2, 0.5), "s2": (0, 0, 0.0), "s3": (1, 1, 1.0)}
    assert {r.role: r.average for r in evals.behaviour_report(scores).collect()} == {None: 0.5, "a": 0.25, "b": 1.0}
    old, new = (spark.createDataFrame(x, "name string, correct boolean") for x in ([("a", True), ("b", True)], [("a", False), ("c", True)]))
    assert [tuple(r) for r in evals.compare(old, new).collect()] == [("a", True, False, True)]
    assert sorted(r.name for r in evals.prefer(new, old).collect()) == ["a", "b", "c"]


def test_audit_of_prompts_and_broken_files(spark):
    from turnloom.sources.tables import FORMULA

    text = "```json\nprompt: {{x} do it\n```\nand ```\nnone of it\n```"
    step = [("a", "t", text, "ok", [])]
    df = spark.createDataFrame([("p", "f", "workflow", "d", 1, step, {}, None), ("q", "g", None, None, None, None, None, "bad")], FORMULA)
    got = {(r.formula, r.severity, r.issue) for r in audit.audit(df).collect()}
    assert ("g", "critical", "bad") in got and ("f", "medium", "unmatched variable placeholder") in got and ("f", "low", "prompt may lack clear instructions") in got and len(got) == 3
    assert [(r.severity, r.n) for r in audit.severity_counts(audit.audit(df)).collect()] == [("critical", 1), ("high", 0), ("medium", 1), ("low", 1), ("info", 0)]


def test_snapshots(spark):
    assert column(spark, ["abc", "a\nb" + "c" * 20, "12345678\nabcdef"], "string", lambda x: snapshot.truncate_section(x, 10)) == ["abc", "a\nbccccccc\n[... truncated]", "12345678\n[... truncated]"]
    assert column(spark, ["gt peek x", "bd list --label=cleanup", "bd list", "tmux has-session", "ls"], "string", snapshot.gather_section) == ["Polecats", "Cleanup Wisps", "Active Work", "Infrastructure", None]


def test_sections_of_a_snapshot(spark):
    """Missing, null and blank ones are N/A, ends are stripped of any white space; sections as they are stay so, and a null one is not hidden."""
    sections = [{"Polecats": "\xa0p\x1c", "Inbox": " \u3000", "State": None}, {"Inbox": None}]
    text = lambda first, inbox: f"## Polecats\n{first}\n\n## Inbox\n{inbox}" + "".join(f"\n\n## {name}\nN/A" for name in ("Cleanup Wisps", "Infrastructure", "Active Work", "State"))
    assert column(spark, sections, "map<string,string>", snapshot.format_snapshot) == [text("p", "N/A"), text("N/A", "N/A")]
    assert column(spark, sections, "map<string,string>", lambda x: snapshot.format_snapshot(x, ["Inbox"])) == [text("p", " \u3000"), None]


def test_scrubbing(spark):
    got = column(spark, ["token = 'abcdefghijklmnop' and ghp_" + "a" * 36, "clean", None], "string", scrub.scrub)
    assert got[0].n == 2 and got[0].text == "[ASSIGNMENT] and [GITHUB_TOKEN]" and (got[1].text, got[1].n) == ("clean", 0) and got[2].text is None


def test_synthetic_shares(spark):
    n = 20_000
    got = {r.template: r["count"] for r in synth.generate(spark, n, "legacy").groupBy("template").count().collect()}
    assert math.isclose(got["stuck_worker"] / n, 2 / 17.5, abs_tol=0.02) and len(got) == 8
    assert math.isclose(synth.generate(spark, n).where("corrupted").count() / n, 0.1, abs_tol=0.02)


def test_patrol_stream(spark, tmp_path):
    rows = [("p", i, a) for i, a in enumerate(["none", "nudge", "none", "none"])] + [("q", 0, "peek")]
    log = spark.createDataFrame(rows, "patrol_id string, ordinal long, action string")
    batch = {(r.patrol_id, r.patrol_count): (r.idle_cycles, r.last_action) for r in patrol.patrol_state(log, "ordinal").collect()}
    assert batch[("p", 4)] == (2, "nudge") and batch[("p", 1)] == (1, None) and batch[("q", 1)] == (0, "peek")
    log.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = patrol.patrol_stream(spark.readStream.schema(log.schema).parquet(str(tmp_path / "in")))
    job = stream.writeStream.format("memory").queryName("patrol").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    job.awaitTermination()
    assert {tuple(r) for r in spark.table("patrol").collect()} == {("p", 4, 2, "nudge"), ("q", 1, 0, "peek")}


@pytest.mark.parametrize("new, known, due", [(1, 0, True), (1, 10, True), (1, 11, False)])
def test_retrain_trigger(new, known, due):
    assert patrol.retrain_due(new, known) is due
