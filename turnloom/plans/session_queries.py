"""Further registered queries: what sessions, logs, samples and reports look like at their edges, each through the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import floor_round
from ..operators import audit, chat, evals, link, preference, quality, roles, score, synth, validate
from ..sources import transcripts
from . import curation
from .queries import _ERRORS, _FORMULA_FAULTS, _formulas, _table, _turns, _with_system, query

_STRIPPED = "trim(text, ' ' || chr(9) || chr(10) || chr(13))"


@query("""
    WITH c AS (SELECT conv_id, conv_id % 11 AS k FROM conversations GROUP BY conv_id)
    SELECT conv_id, CASE k WHEN 0 THEN 'boot' WHEN 1 THEN 'deacon' WHEN 2 THEN 'deacon' WHEN 3 THEN 'mayor' WHEN 4 THEN 'witness' WHEN 5 THEN 'refinery' WHEN 6 THEN 'crew' WHEN 7 THEN 'polecat' WHEN 8 THEN 'witness' ELSE 'unknown' END AS role,
           CASE WHEN k IN (8, 10) THEN 'witness' END AS any_banner, CASE k WHEN 0 THEN 'boot' WHEN 1 THEN 'deacon' WHEN 2 THEN 'crew' WHEN 3 THEN 'mayor' WHEN 4 THEN 'witness' WHEN 5 THEN 'refinery' WHEN 6 THEN 'polecat' END AS cwd_role,
           CASE k WHEN 3 THEN 'a-mayor' ELSE 'x' END AS suffix
    FROM c
""")
def q43_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of every form, banners known, of another name and of an unknown role, and working directories."""
    k = F.col("conv_id") % 11
    pick = lambda values: F.get(F.array(*map(F.lit, values)), k.cast("int"))
    folder = pick(["-a-deacon-dogs-boot", "-a-deacon-dogs-alpha", "-a-deacon", "-a-mayor", "-a-witness", "-a-refinery-rig", "-a-crew-x", "-a-polecats-y", "-home", "-home", "-home"])
    cwd = pick(["/a/deacon/dogs/boot", "/a/deacon", "/a/crew/joe", "/a/mayor/rig", "/a/witness", "/a/refinery/rig", "/a/polecats/amber/src", "/a/crew", "/a/mayor", "/a", ""])
    text = pick(["", "", "", "[OLD TOWN] crew <- me", "", "", "", "", "hello [OLD TOWN] Witness <- me", "[OLD TOWN] king <- me", "[NEW TOWN] witness <- me"])
    rows = _table(spark, sf_dir, "conversations").select("conv_id").distinct()
    raw = F.when(k == 3, "-p-a-mayor").otherwise("-p-x")
    return rows.select("conv_id", roles.tag_role(folder, text, "OLD TOWN").alias("role"), F.when(k >= 8, roles.role_from_text(text)).alias("any_banner"), roles.role_from_cwd(cwd).alias("cwd_role"), roles.folder_suffix_role(raw, "-p-").alias("suffix"))


_SAID = "text || CASE turn % 5 WHEN 1 THEN ' tool_use_id created it' WHEN 2 THEN ' it failed' WHEN 3 THEN ' I retry and wrote it, then escalate' ELSE ' gt done' END"


@query(f"""
    WITH m AS (SELECT conv_id, turn, role, {_SAID} AS value, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role <> 'system' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    a AS (SELECT *, lower(lead(value, 1) OVER w) AS v1, lead(role, 1) OVER w AS r1, lower(lead(value, 2) OVER w) AS v2, lead(role, 2) OVER w AS r2, lower(lead(value, 3) OVER w) AS v3, lead(role, 3) OVER w AS r3,
                 lower(lead(value, 4) OVER w) AS v4, lead(role, 4) OVER w AS r4 FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    t AS (SELECT *, role = 'assistant' AND (contains(value, 'tool_result') OR contains(value, 'tool_use_id')) AND r1 = 'user' AS calls, contains(v1, 'error') OR contains(v1, 'failed') AS failed,
                 coalesce(r2 = 'assistant' AND (contains(v2, 'retry') OR contains(v2, 'attempt')), false) OR coalesce(r3 = 'assistant' AND (contains(v3, 'retry') OR contains(v3, 'attempt')), false)
                 OR coalesce(r4 = 'assistant' AND (contains(v4, 'retry') OR contains(v4, 'attempt')), false) AS again FROM a),
    c AS (SELECT conv_id, count(*) AS n, count(*) FILTER (calls AND NOT failed) AS good, count(*) FILTER (calls AND failed AND again) AS recovered, lower(string_agg(value || ' ', '' ORDER BY turn)) AS whole,
                 arg_max(role, turn) AS last_role, arg_max(value, turn) AS last_value FROM t GROUP BY conv_id),
    s AS (SELECT *, 0.7::DOUBLE * (good / n) + 0.3::DOUBLE * (recovered / n) AS turns,
                 least(len(list_filter(['created', 'generated', 'produced', 'wrote', 'implemented'], lambda x: contains(whole, x))) / 3, 1.0::DOUBLE) AS made,
                 least(len(list_filter(['escalate', 'help', 'stuck', 'blocked', 'witness', 'mayor'], lambda x: contains(whole, x))) / 5, 1.0::DOUBLE) AS asked,
                 CASE WHEN conv_id % 2 = 0 THEN 10 ELSE 15 END AS target,
                 CASE WHEN last_role <> 'assistant' THEN 0.5::DOUBLE WHEN contains(last_value, 'gt done') OR contains(lower(last_value), 'completed') THEN 1.0::DOUBLE
                      WHEN contains(lower(last_value), 'escalate') OR contains(lower(last_value), 'help') THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END AS ends FROM c)
    SELECT conv_id, floor(turns * 1000000 + 0.5::DOUBLE) / 1000000 AS turn_score, floor(made * (1 - asked * 0.5::DOUBLE) * 1000000 + 0.5::DOUBLE) / 1000000 AS step_score,
           floor((0.7::DOUBLE * ends + 0.3::DOUBLE * CASE WHEN n <= target THEN n / target ELSE 1 - least((n - target) / target, 0.5::DOUBLE) END) * 1000000 + 0.5::DOUBLE) / 1000000 AS formula_score FROM s
""")
def q44_heuristic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions without telemetry: calls that go well or fail, retries, words for results and for calls for help."""
    said = _table(spark, sf_dir, "conversations").withColumn("text", F.expr(_SAID))
    listed = said.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("turns")).withColumn("msgs", chat.messages(F.col("turns"))).where(F.size("msgs") > 0)
    none, no = F.lit(None).cast("struct<exit_type:string,status:string,topic:string,duration_ms:bigint,fallback_source:string,role:string,actor:string>"), F.lit(False)
    role, m = F.when(F.col("conv_id") % 2 == 0, "crew").otherwise("unknown"), F.col("msgs")
    return listed.select("conv_id", floor_round(score.turn_score(m), 6).alias("turn_score"), floor_round(score.step_score(m, none, no), 6).alias("step_score"), floor_round(score.formula_score(m, role, none, no), 6).alias("formula_score"))


@query(f"""
    WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'user' AND turn % 2 = 0 THEN text WHEN role = 'user' THEN text || chr(10) || '<tool_result tool_use_id="' || turn || '">' || chr(10) || 'done ' || turn || chr(10) || '</tool_result>' ELSE {_STRIPPED} END AS content
               FROM conversations WHERE role <> 'system' AND trim(text) <> ''),
    f AS (SELECT conv_id, count(*) FILTER (role = 'user') * 2 + count(*) FILTER (role = 'assistant') AS talk, count(*) FILTER (role <> 'system') AS own FROM conversations GROUP BY conv_id)
    SELECT 's' || t.conv_id AS session_id, CASE t.conv_id % 3 WHEN 0 THEN 'claudecode' WHEN 1 THEN 'claudecode-nvim' ELSE 'claudecode-mcp' END AS runtime_type, CASE t.conv_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'box,prism-nvim' ELSE 'box' END AS servers,
           CAST(any_value(talk) AS BIGINT) AS conversation_records, CAST(any_value(talk) + CASE t.conv_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END * any_value(own) AS BIGINT) AS total_records, CAST(count(*) AS INTEGER) AS n_turns, sha256(string_agg(content, '|' ORDER BY turn)) AS hash
    FROM t JOIN f ON f.conv_id = t.conv_id GROUP BY t.conv_id
""")
def q45_session_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' records come twice under one uuid, the first blank; every other one is a list of text and result; servers show in progress records."""
    c = _table(spark, sf_dir, "conversations").where("role <> 'system'")
    session, at, k = F.concat(F.lit("s"), F.col("conv_id")), F.col("turn").cast("string"), F.col("conv_id") % 3
    uuid = F.concat(session, F.lit("-"), at)
    record = lambda kind, content: F.to_json(F.struct(F.lit(kind).alias("type"), session.alias("sessionId"), uuid.alias("uuid"), F.struct(content.alias("content")).alias("message")))
    text = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("string").alias("tool_use_id"), F.lit(None).cast("string").alias("content"))
    result = F.struct(F.lit("tool_result").alias("type"), F.lit(None).cast("string").alias("text"), at.alias("tool_use_id"), F.concat(F.lit("done "), at).alias("content"))
    progress = lambda server: F.to_json(F.struct(F.lit("progress").alias("type"), F.struct(F.lit("mcp_progress").alias("type"), F.lit(server).alias("serverName")).alias("data")))
    user = F.array(record("user", F.lit(" ")), F.when(F.col("turn") % 2 == 0, record("user", F.col("text"))).otherwise(record("user", F.array(text, result))))
    seen = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(progress("prism-nvim"), progress("box"))).otherwise(F.array(progress("box")))
    said = F.when(F.col("role") == "user", user).otherwise(F.array(record("assistant", F.array(text))))
    lines = c.select(F.concat(F.lit("/x/"), session).alias("source_path"), F.lit("-x").alias("folder"), "turn", F.posexplode(F.concat(said, seen)).alias("k", "line")).select("source_path", "folder", (F.col("turn") * 8 + F.col("k")).cast("int").alias("line_no"), "line")
    found = transcripts.sessions(transcripts.records(lines))
    return found.select("session_id", "runtime_type", F.array_join("mcp_servers", ",").alias("servers"), "conversation_records", "total_records", F.size("turns").alias("n_turns"), F.sha2(F.array_join(F.transform("turns", lambda t: t.content), "|"), 256).alias("hash"))


@query("""
    WITH t AS (SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 AND turn >= 1 THEN ' again ' ELSE text END AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations),
    c AS (SELECT conv_id, sum(length(text)) AS chars, count(*) AS n, count(DISTINCT trim(text)) FILTER (back <= 3) AS last FROM t GROUP BY conv_id)
    SELECT conv_id, n >= 3 AND last = 1 AS is_loop, chars // 4 <= 300 AND NOT (n >= 3 AND last = 1) AS fits FROM c
""")
def q46_long_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that end in one text over and over, and those with too many tokens."""
    again = _table(spark, sf_dir, "conversations").withColumn("content", F.when((F.col("conv_id") % 4 == 0) & (F.col("turn") >= 1), " again ").otherwise(F.col("text")))
    listed = again.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "content"))).alias("turns"))
    return listed.select("conv_id", quality.is_error_loop(F.col("turns")).alias("is_loop"), quality.fits_long_context(F.col("turns"), 300).alias("fits"))


def _sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as lines of three files, every fourth of them cut off."""
    text = F.to_json(F.struct(_with_system(F.col("turns")).alias("conversations")))
    line = F.when(F.col("conv_id") % 4 == 0, F.substring(text, 1, 30)).otherwise(text)
    return _turns(spark, sf_dir).select(F.concat(F.lit("/x/"), F.col("conv_id") % 3).alias("source_path"), F.col("conv_id").cast("int").alias("line_no"), line.alias("line"))


@query(f"""
    WITH {_ERRORS}, x AS (SELECT conv_id, error FROM e WHERE conv_id % 4 <> 0 UNION ALL SELECT DISTINCT conv_id, 'invalid JSON' FROM conversations WHERE conv_id % 4 = 0)
    SELECT '/x/' || conv_id % 3 AS source_path, CAST(conv_id + 1 AS INTEGER) AS line_no, error FROM x
""")
def q47_numbered_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.numbered_errors(_sample_lines(spark, sf_dir))


@query(f"""
    WITH {_ERRORS}, x AS (SELECT conv_id, error FROM e WHERE conv_id % 4 <> 0 UNION ALL SELECT DISTINCT conv_id, 'invalid JSON' FROM conversations WHERE conv_id % 4 = 0),
    b AS (SELECT conv_id % 3 AS k, count(DISTINCT conv_id) AS bad, count(*) AS errors FROM x GROUP BY 1)
    SELECT '/x/' || k AS source_path, count(DISTINCT conv_id) AS total, count(DISTINCT conv_id) - coalesce(any_value(bad), 0) AS valid, coalesce(any_value(errors), 0) AS errors FROM (SELECT conv_id, conv_id % 3 AS k FROM conversations) LEFT JOIN b USING (k) GROUP BY k
""")
def q47b_file_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.file_totals(_sample_lines(spark, sf_dir))


@query("""
    WITH u AS (SELECT user_id AS i, min(event_id) FILTER (event_type = 'click' AND user_id % 3 <> 0) AS first FROM events GROUP BY user_id)
    SELECT 's' || i AS session_id, CASE WHEN first % 2 = 0 THEN 'it-' || first END AS bead_id, CASE WHEN first IS NOT NULL THEN 'DEFERRED' END AS exit_type,
           CASE WHEN first % 2 = 0 THEN NULL WHEN i % 5 = 0 THEN 'costs.jsonl' WHEN i % 4 = 0 THEN 'cmd-usage.jsonl' END AS fallback_source,
           CASE WHEN coalesce(first % 2, 1) = 1 AND i % 5 = 0 THEN 'r2' END AS role, CASE WHEN coalesce(first % 2, 1) = 1 AND i % 4 = 0 THEN 'a' || i END AS actor FROM u
""")
def q48_fallback_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry knows every other session by another name; local logs count where no work item is known, the last line of each."""
    e = _table(spark, sf_dir, "events")
    key = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("g"), F.col("user_id"))).otherwise(F.concat(F.lit("s"), F.col("user_id")))
    users = e.select("user_id").distinct()
    sessions = users.select(F.concat(F.lit("s"), F.col("user_id")).alias("session_id"), F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("g"), F.col("user_id"))).otherwise("").alias("gt_session"))
    firsts = e.where("event_type = 'click' and user_id % 3 <> 0").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    none = F.lit("")
    done = firsts.select(key.alias("session_id"), F.lit("done").alias("message"), F.lit("2024-01-01T00:00:00Z").alias("time"), F.lit("DEFERRED").alias("exit_type"), none.alias("status"), none.alias("topic"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("it-"), F.col("event_id"))).otherwise("").alias("issue"), none.alias("stream"), F.col("event_id").alias("ordinal"))
    costs = users.where("user_id % 5 = 0").select(key.alias("session_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("line_no")).withColumn("role", F.concat(F.lit("r"), F.col("line_no")))
    commands = users.where("user_id % 4 = 0").select(key.alias("session_id"), F.lit(1).alias("line_no"), F.concat(F.lit("a"), F.col("user_id")).alias("actor"))
    return link.link_by(sessions, done, costs, commands).select("session_id", "bead_id", "otel_signals.exit_type", "otel_signals.fallback_source", "otel_signals.role", "otel_signals.actor")


@query("""
    WITH v AS (SELECT vec_id, list_transform(embedding[1:6], lambda x: -abs(x::DOUBLE)) AS e FROM embeddings),
    p AS (SELECT vec_id, unnest([0, 1, 2]) AS i, unnest([e[2] - e[1], e[4] - e[3], e[6] - e[5]]) AS ratio FROM v),
    d AS (SELECT vec_id, least(1.0::DOUBLE, exp(ratio)) AS p, CAST('0x' || sha256('42:' || vec_id || ':' || i)[1:8] AS BIGINT) / 4294967296::DOUBLE AS u FROM p)
    SELECT vec_id, CAST(count(*) FILTER (p > u) AS INTEGER) AS n_accepted, floor(sum(p) * 1000000 + 0.5::DOUBLE) / 1000000 AS expected FROM d GROUP BY vec_id
""")
def q49_stochastic_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three draft tokens a vector; the log-probabilities of draft and target are its first components."""
    at = lambda k: F.array(F.lit(-9.0), -F.abs(F.try_element_at("embedding", F.lit(k)).cast("double")))
    tokens, draft, target = F.array(*(F.lit(1) for _ in range(3))), F.array(at(1), at(3), at(5)), F.array(at(2), at(4), at(6))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", evals.acceptance_probability(tokens, draft, target).alias("p"))
    accepted = F.size(F.filter(evals.stochastic_accepted(F.col("p"), F.col("vec_id")), lambda x: x))
    return rows.select("vec_id", accepted.alias("n_accepted"), floor_round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x), 6).alias("expected"))


@query(f"""
    WITH {_FORMULA_FAULTS}, d AS (SELECT unnest(['critical', 'high', 'medium', 'low', 'info']) AS severity)
    SELECT d.severity, count(x.i) AS n FROM d LEFT JOIN x ON x.severity = d.severity GROUP BY d.severity
""")
def q50_severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.severity_counts(audit.audit(_formulas(spark, sf_dir)))


@query("""
    WITH r AS (SELECT doc_id AS i, toxic = 1 AS soft, ['mayor', 'crew', 'deacon'][1 + doc_id % 3] AS role FROM labels)
    SELECT 's' || i AS session_id, role, soft AS has_soft_labels,
           CASE WHEN soft THEN floor(greatest(exp(-0.2::DOUBLE) * (-0.2::DOUBLE + 0.1::DOUBLE) + exp(-0.3::DOUBLE) * (-0.3::DOUBLE + (i % 7) / 10), 0) * 1000000 + 0.5::DOUBLE) / 1000000 END AS kl_divergence,
           'system:' || CASE role WHEN 'mayor' THEN 'Lead.' ELSE 'Work.' END || '|human:ask ' || i || '|gpt:say ' || i AS said FROM r
""")
def q51_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected drafts with the target's answer in their place; soft labels where both lists of log-probabilities are there."""
    i, soft = F.col("doc_id"), F.col("toxic") == 1
    rows = _table(spark, sf_dir, "labels").select(
        F.concat(F.lit("s"), i).alias("session_id"), F.get(F.array(*map(F.lit, ("mayor", "crew", "deacon"))), (i % 3).cast("int")).alias("role"), F.concat(F.lit("ask "), i).alias("prompt"), F.lit("draft").alias("draft_response"), F.concat(F.lit("say "), i).alias("target_response"),
        F.lit("why").alias("rejection_reason"), F.lit(0.5).alias("acceptance_score"), F.when(soft, F.array(F.lit(-0.1), -(i % 7) / 10)).alias("draft_logprobs"), F.when(soft, F.array(F.lit(-0.2), F.lit(-0.3))).alias("target_logprobs"),
    )
    made = preference.rejection_samples(rows, spark.createDataFrame([("mayor", "Lead.")], "role string, prompt string"), "Work.")
    said = F.array_join(F.transform("conversations", lambda m: F.concat(m["from"], F.lit(":"), m.value)), "|")
    return made.select("metadata.session_id", "metadata.role", "metadata.has_soft_labels", floor_round(F.col("metadata.kl_divergence"), 6).alias("kl_divergence"), said.alias("said"))


@query("""
    WITH r AS (SELECT ['mayor', 'crew', 'deacon'][1 + doc_id % 3] AS role, toxic = 1 AS soft, quality = 1 AS general FROM labels)
    SELECT role, count(*) AS n_rejection, count(*) FILTER (general AND role <> 'crew') AS n_general, bool_or(soft) AS soft_labels FROM r GROUP BY role
    UNION ALL SELECT 'boot', 0, count(*), false FROM r WHERE general AND role = 'crew' HAVING count(*) > 0
""")
def q51b_role_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of both sides, one of which has no rejections."""
    rows = _table(spark, sf_dir, "labels").select(F.get(F.array(*map(F.lit, ("mayor", "crew", "deacon"))), (F.col("doc_id") % 3).cast("int")).alias("role"), (F.col("toxic") == 1).alias("soft"), (F.col("quality") == 1).alias("general"))
    rejected = rows.select(F.struct("role", F.col("soft").alias("has_soft_labels")).alias("metadata"))
    general = rows.where("general").select(F.struct(F.when(F.col("role") == "crew", "boot").otherwise(F.col("role")).alias("role")).alias("metadata"))
    return preference.role_summary(rejected, general)


@query("""
    WITH c AS (SELECT conv_id AS i, count(*) AS n FROM conversations GROUP BY conv_id),
    k AS (SELECT * FROM c WHERE i % 5 <> 0)
    SELECT 'total' AS kind, 'sessions' AS name, count(*) AS n FROM c
    UNION ALL SELECT 'total', 'turns', CAST(sum(n) AS BIGINT) FROM c
    UNION ALL SELECT 'total', 'linked', count(*) FROM c WHERE i % 3 = 0
    UNION ALL SELECT 'runtime', CASE WHEN i % 2 = 0 THEN 'claudecode' ELSE 'events' END, count(*) FROM c GROUP BY 2
    UNION ALL SELECT 'total', 'samples', count(*) FROM c
    UNION ALL SELECT 'total', 'secrets', CAST(sum(i % 2) AS BIGINT) FROM c
    UNION ALL SELECT 'role', CASE WHEN i % 4 = 0 THEN 'mayor' ELSE 'unknown' END, count(*) FROM c GROUP BY 2
    UNION ALL SELECT 'total', 'kept', count(*) FROM k
    UNION ALL SELECT 'total', 'train', count(*) FROM k WHERE i % 7 <> 0
    UNION ALL SELECT 'total', 'val', count(*) FROM k WHERE i % 7 = 0
    UNION ALL SELECT 'train role', CASE WHEN i % 4 = 0 THEN 'mayor' ELSE 'unknown' END, count(*) FROM k WHERE i % 7 <> 0 GROUP BY 2
    UNION ALL SELECT 'total', 'duplicates removed', (SELECT count(*) FROM c) - (SELECT count(*) FROM k)
""")
def q52_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("conv_id")
    none = F.lit(None).cast("string")
    fields = {"exit_type": F.when(i % 3 == 0, "COMPLETED"), "status": none, "topic": none, "duration_ms": F.lit(None).cast("long"), "fallback_source": none, "role": none, "actor": none}
    sessions = _turns(spark, sf_dir).withColumns({"runtime_type": F.when(i % 2 == 0, "claudecode").otherwise("events"), "otel_signals": F.struct(*(v.alias(k) for k, v in fields.items()))})
    role = F.when(i % 4 == 0, "mayor")
    made = sessions.select("conv_id", F.struct(role.alias("role")).alias("metadata"), (i % 2).alias("secrets"))
    final = sessions.where(i % 5 != 0).select(F.when(i % 7 == 0, "val").otherwise("train").alias("split"), role.alias("role"))
    return curation.run_stats(sessions, made, final)


@query("""
    WITH e AS (SELECT event_id AS i, event_id % 977 AS latency FROM events), l AS (SELECT list_sort(list(latency)) AS l, count(*) AS n FROM e)
    SELECT count(*) AS n, avg((i % 2)::DOUBLE) AS valid_json_rate, avg((i % 3 = 0)::INT::DOUBLE) AS valid_tool_rate, avg((i % 5 = 0)::INT::DOUBLE) AS correct_tool_rate, avg((i % 7 = 0)::INT::DOUBLE) AS has_args_rate, avg(latency::DOUBLE) AS mean_latency_ms,
           any_value(l.l[l.n // 2 + 1]) AS p50_latency_ms, any_value(l.l[CAST(floor(0.95::DOUBLE * l.n) AS BIGINT) + 1]) AS p95_latency_ms FROM e, l
""")
def q53_evaluation_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    checks = F.struct((i % 2 == 1).alias("valid_json"), (i % 3 == 0).alias("valid_tool"), (i % 5 == 0).alias("correct_tool"), (i % 7 == 0).alias("has_args"))
    return evals.scenario_summary(_table(spark, sf_dir, "events").select(checks.alias("checks"), (i % 977).alias("latency_ms")))


@query("""
    WITH t AS (SELECT event_id % 6 AS form, event_type IN ('click', 'view', 'error') AS known FROM events)
    SELECT CASE WHEN form IN (0, 1) THEN 'json' WHEN form = 2 THEN 'xml' WHEN form = 3 THEN 'plain' WHEN form = 4 AND known THEN 'gt_cmd' ELSE 'none' END AS source, count(*) AS n FROM t GROUP BY 1
""")
def q53b_parse_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import QUERIES

    return evals.parse_sources(QUERIES["q23b_decisions"](spark, sf_dir))


@query("""
    SELECT event_id, event_id % 3 = 0 AS valid_json, event_id % 3 = 0 AND event_type <> 'view' AS valid_tool, event_id % 3 = 0 AND event_type = 'click' AS correct_tool, event_id % 3 = 0 AND event_id % 2 = 0 AS has_args,
           event_id % 3 = 0 AS has_action, event_id % 100 / 500 <= 0.1 AS is_cheap FROM events
""")
def q53c_decision_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that are objects with a known tool, an unknown one, arguments of another kind, or no answers."""
    i, kind = F.col("event_id"), F.col("event_type")
    tool = F.when(kind == "click", "gt_nudge").when(kind == "view", "gt_fly").otherwise("bd_close")
    args = F.when(i % 2 == 0, '{"id": 1}').otherwise("[1]")
    said = F.when(i % 3 == 0, F.concat(F.lit('{"tool": "'), tool, F.lit('", "args": '), args, F.lit(', "action": "x"}'))).otherwise("I can't say")
    checks = evals.decision_checks(evals.parse_decision(said), F.array(F.lit("gt_nudge")))
    held = evals.response_assertions(said, F.array(F.lit("x")), i % 100 / 500, F.lit(1))
    return _table(spark, sf_dir, "events").select("event_id", checks.alias("c"), held.alias("h")).select("event_id", "c.valid_json", "c.valid_tool", "c.correct_tool", "c.has_args", "h.has_action", "h.is_cheap")


@query(f"""
    WITH t AS (SELECT conv_id, turn, unnest(CASE WHEN role = 'user' THEN [text] ELSE [{_STRIPPED} || chr(10) || '<tool_call name="bash" source="standard">' || chr(10) || '{{"place":' || turn || '}}' || chr(10) || '</tool_call>', '<tool_result tool_use_id="c' || turn || '">' || chr(10) || 'ran' || chr(10) || '</tool_result>'] END) AS content,
                      unnest(CASE WHEN role = 'user' THEN [0] ELSE [0, 1] END) AS k FROM conversations WHERE role <> 'system' AND trim(text) <> '')
    SELECT 'v' || conv_id AS session_id, 'crew' AS role, CAST(count(*) AS INTEGER) AS n_turns, sha256(string_agg(content, '|' ORDER BY turn, k)) AS hash FROM t GROUP BY conv_id
""")
def q54_event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written in the second transcript format, with a call and its result after each answer."""
    c = _table(spark, sf_dir, "conversations").where("role <> 'system'")
    session, at = F.concat(F.lit("v"), F.col("conv_id")), F.col("turn").cast("string")
    message = lambda *fields: F.to_json(F.struct(F.lit("message").alias("type"), at.alias("id"), F.struct(*fields).alias("message")))
    kind = lambda name: F.lit(name).alias("type")
    none = F.lit(None).cast("string")
    text = F.struct(kind("text"), F.col("text").alias("text"), none.alias("name"), F.lit(None).cast("struct<place:bigint>").alias("arguments"))
    think = F.struct(kind("thinking"), F.lit("hm").alias("text"), none.alias("name"), F.lit(None).cast("struct<place:bigint>").alias("arguments"))
    call = F.struct(kind("toolCall"), none.alias("text"), F.lit("bash").alias("name"), F.struct(F.col("turn").alias("place")).alias("arguments"))
    user = F.array(message(F.lit("user").alias("role"), F.col("text").alias("content")))
    answer = F.array(
        message(F.lit("assistant").alias("role"), F.array(think, text, call).alias("content")),
        message(F.lit("toolResult").alias("role"), F.concat(F.lit("c"), at).alias("toolCallId"), F.array(F.struct(kind("text"), F.lit("ran").alias("text"))).alias("content"), F.lit(False).alias("isError")),
        F.lit("not json"),
    )
    said = c.select(session.alias("s"), "turn", F.posexplode(F.when(F.col("role") == "user", user).otherwise(answer)).alias("k", "line")).select("s", (F.col("turn") * 4 + F.col("k") + 1).cast("int").alias("line_no"), "line")
    head = F.to_json(F.struct(F.lit("session").alias("type"), F.col("s").alias("id"), F.lit("/a/crew/joe").alias("cwd")))
    heads = said.select("s").distinct().select("s", F.lit(0).alias("line_no"), head.alias("line"))
    lines = said.unionByName(heads).select(F.concat(F.lit("/x/"), "s").alias("source_path"), F.lit("x").alias("folder"), "line_no", "line")
    found = transcripts.event_sessions(lines)
    return found.select("session_id", roles.role_from_cwd(F.col("cwd")).alias("role"), F.size("turns").alias("n_turns"), F.sha2(F.array_join(F.transform("turns", lambda t: t.content), "|"), 256).alias("hash"))


@query("""
    WITH s AS (SELECT user_id AS i, CASE user_id % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'ESCALATED' WHEN 2 THEN 'DEFERRED' END AS e, CASE WHEN user_id % 3 = 0 THEN 'mayor' ELSE 'unknown' END AS role, (user_id % 50) * 60000 AS ms FROM events GROUP BY user_id),
    p AS (SELECT *, CASE WHEN role = 'mayor' THEN 1200000 ELSE 600000 END AS m FROM s),
    q AS (SELECT *, CASE e WHEN 'COMPLETED' THEN 1.0::DOUBLE WHEN 'ESCALATED' THEN 0.6::DOUBLE WHEN 'DEFERRED' THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END AS step, CASE e WHEN 'COMPLETED' THEN 1.0::DOUBLE WHEN 'ESCALATED' THEN 0.7::DOUBLE WHEN 'DEFERRED' THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END AS done,
                 CASE WHEN ms <= m THEN 1 - ms / (2 * m) ELSE 0.5::DOUBLE - least((ms - m) / (2 * m), 0.5::DOUBLE) END AS speed FROM p)
    SELECT 's' || i AS session_id, floor((0.3::DOUBLE * 0.5::DOUBLE + 0.4::DOUBLE * step + 0.3::DOUBLE * (0.6::DOUBLE * done + 0.4::DOUBLE * speed)) * 1000000 + 0.5::DOUBLE) / 1000000 AS outcome_score FROM q
""")
def q55_score_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sessions without turns, scored by their signals."""
    i, none = F.col("user_id"), F.lit(None).cast("string")
    fields = {"exit_type": F.when(i % 4 == 0, "COMPLETED").when(i % 4 == 1, "ESCALATED").when(i % 4 == 2, "DEFERRED"), "status": none, "topic": none, "duration_ms": i % 50 * 60_000, "fallback_source": none, "role": none, "actor": none}
    users = _table(spark, sf_dir, "events").select("user_id").distinct()
    sessions = users.select(F.concat(F.lit("s"), i).alias("session_id"), F.lit("/x").alias("source_path"), F.array().cast("array<string>").alias("turns"), F.lit("claudecode").alias("runtime_type"), F.array().cast("array<string>").alias("mcp_servers"), F.when(i % 3 == 0, "mayor").otherwise("unknown").alias("role"), F.struct(*(v.alias(k) for k, v in fields.items())).alias("otel_signals"))
    return curation.score_raw(curation.raw_sessions(sessions)).select("session_id", floor_round(F.col("outcome_score"), 6).alias("outcome_score"))


def _drawn(stream: str) -> str:
    return f"CAST('0x' || sha256('42:{stream}:' || id)[1:8] AS BIGINT) / 4294967296::DOUBLE"


def _synthetic_sql() -> str:
    """The draws of 10,000 rows; templates and names are read from the operator's tables."""
    import json

    some, so_far, cases = synth.chosen("both"), 0.0, []
    for k, t in enumerate(some):
        so_far += t[2]
        cases.append(f"WHEN u * {sum(x[2] for x in some)}::DOUBLE < {so_far}::DOUBLE THEN {k}" if k + 1 < len(some) else f"ELSE {k}")
    names = ", ".join("[" + ", ".join(f"'{x}'" for x in v) + f"][1 + CAST(floor({_drawn(k)} * {len(v)}) AS INTEGER)] AS {k}" for k, v in synth.NAMES.items())
    answers = []
    for k, t in enumerate(some):
        said = "'" + json.dumps({"tool": t[3], "args": t[4]}) + "'"
        for name in synth.NAMES:
            said = f"replace({said}, '{{{name}}}', {name})"
        answers.append(f"WHEN {k} THEN {said}")
    tools = " ".join(f"WHEN {k} THEN '{t[0]}'" for k, t in enumerate(some))
    return f"""
        WITH r AS (SELECT range AS id FROM range(10000)), d AS (SELECT id, {_drawn("template")} AS u, {_drawn("fault")} < 0.1::DOUBLE AS corrupted, {names} FROM r), k AS (SELECT *, CASE {" ".join(cases)} END AS k FROM d)
        SELECT id, CASE k {tools} END AS template, corrupted, CASE k {" ".join(answers)} END AS answer FROM k
    """


@query(_synthetic_sql())
def q56_synthetic_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.generate(spark, 10_000).select("id", "template", "corrupted", "answer")
