"""Sessions from transcript records: one JSON object a line, assistant messages in fragments, content a text or a list of blocks.

Everything is DataFrame functions: records are grouped by file and turn key once; a session's turns are an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from .lines import discover, json_lines, read_lines

_CALL = "struct<id:string,name:string,input:string,source:string,mcp_server:string>"
_RESULT = "struct<tool_use_id:string,content:string,is_error:boolean>"


def records(lines: DataFrame) -> DataFrame:
    """The fields of each valid record: type, session_id, cwd, timestamp, uuid, request_id, message_id, content (JSON text), is_list, is_text, server."""
    get = lambda path: F.get_json_object("line", path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("line"), "$.message.content", "variant"))
    server = F.when((get("$.type") == "progress") & (get("$.data.type") == "mcp_progress"), F.nullif(get("$.data.serverName"), F.lit("")))
    return json_lines(lines).where("is_valid").select(
        "source_path", "folder", "line_no", *[c for c in ("file_rank",) if c in lines.columns], get("$.type").alias("type"), F.coalesce(get("$.sessionId"), F.lit("")).alias("session_id"), F.coalesce(get("$.cwd"), F.lit("")).alias("cwd"),
        F.coalesce(get("$.timestamp"), F.lit("")).alias("timestamp"), F.coalesce(get("$.uuid"), F.lit("")).alias("uuid"), F.nullif(get("$.requestId"), F.lit("")).alias("request_id"), get("$.message.id").alias("message_id"),
        get("$.message.content").alias("content"), F.coalesce(kind.startswith("ARRAY"), F.lit(False)).alias("is_list"), F.coalesce(kind == "STRING", F.lit(False)).alias("is_text"), server.alias("server"),
    )


def _blocks(content: Column) -> Column:
    """The objects of a list; other elements are left out."""
    return F.filter(F.coalesce(F.from_json(content, "array<string>"), F.array().cast("array<string>")), lambda b: b.startswith("{"))


def _text(block: Column, field: str) -> Column:
    return F.coalesce(F.get_json_object(block, f"$.{field}"), F.lit(""))


def classify_call(block: Column) -> Column:
    """STRUCT<id, name, input, source, mcp_server>: names ``mcp__server__tool`` come from that server."""
    name = _text(block, "name")
    mcp = name.startswith("mcp__")
    server = F.when(mcp, F.coalesce(F.try_element_at(F.split(name, "__", 3), F.lit(2)), F.lit("unknown"))).otherwise("")
    return F.struct(_text(block, "id").alias("id"), name.alias("name"), F.coalesce(F.get_json_object(block, "$.input"), F.lit("{}")).alias("input"), F.when(mcp, "mcp").otherwise("standard").alias("source"), server.alias("mcp_server")).cast(_CALL)


def format_call(call: Column) -> Column:
    """A call as a tag with its input as compact JSON, keys in their own order."""
    server = F.when(call.mcp_server != "", F.concat(F.lit(' mcp_server="'), call.mcp_server, F.lit('"'))).otherwise("")
    return F.concat(F.lit('<tool_call name="'), call["name"], F.lit('" source="'), call.source, F.lit('"'), server, F.lit(">\n"), call.input, F.lit("\n</tool_call>"))


def _user(rec: DataFrame) -> DataFrame:
    """User turns: records of one uuid are one turn, at the place of the first with the content of the last."""
    last = F.max(F.struct("line_no", "content", "is_text", "is_list", "timestamp", "uuid"))
    one = rec.where("type = 'user'").groupBy("source_path", "uuid").agg(F.min("line_no").alias("place"), last.alias("r")).select("source_path", "place", "r.*")
    blocks = F.when(F.col("is_list"), _blocks(F.col("content"))).otherwise(F.array().cast("array<string>"))
    texts = F.transform(F.filter(blocks, lambda b: _text(b, "type") == "text"), lambda b: _text(b, "text"))
    results = F.transform(F.filter(blocks, lambda b: _text(b, "type") == "tool_result"), lambda b: F.struct(_text(b, "tool_use_id").alias("tool_use_id"), _text(b, "content").alias("content"), F.coalesce(F.get_json_object(b, "$.is_error") == "true", F.lit(False)).alias("is_error")).cast(_RESULT))
    shown = F.transform(results, lambda r: F.concat(F.lit('<tool_result tool_use_id="'), r.tool_use_id, F.lit('">\n'), r.content, F.lit("\n</tool_result>")))
    parts = F.concat(texts, shown)
    content = F.when(F.col("is_text") & (strip(F.col("content")) != ""), F.col("content")).when(F.size(parts) > 0, F.array_join(parts, "\n"))
    return one.select("source_path", "place", F.lit("user").alias("role"), content.alias("content"), F.array().cast(f"array<{_CALL}>").alias("tool_calls"), results.alias("tool_results"), "timestamp", "uuid")


def _assistant(rec: DataFrame) -> DataFrame:
    """Assistant turns: fragments of one request are one turn; text blocks and calls in order, thinking left out."""
    key = F.coalesce("request_id", "message_id", "uuid")
    parts = F.array_sort(F.collect_list(F.struct("line_no", "content", "is_list", "timestamp", "uuid")))
    one = rec.where("type = 'assistant'").groupBy("source_path", key.alias("key")).agg(F.min("line_no").alias("place"), parts.alias("parts"))
    blocks = F.flatten(F.transform(F.filter("parts", lambda p: p.is_list), lambda p: _blocks(p.content)))
    one = one.withColumn("blocks", F.filter(blocks, lambda b: _text(b, "type").isin("text", "tool_use")))
    shown = F.transform("blocks", lambda b: F.when(_text(b, "type") == "text", strip(_text(b, "text"))).otherwise(format_call(classify_call(b))))
    shown = F.filter(shown, lambda x: x != "")
    calls = F.transform(F.filter("blocks", lambda b: _text(b, "type") == "tool_use"), classify_call)
    first = lambda f: F.coalesce(F.try_element_at(F.filter("parts", lambda p: p[f] != ""), F.lit(1))[f], F.lit(""))
    content = F.when(F.size(shown) > 0, F.array_join(shown, "\n"))
    return one.select("source_path", "place", F.lit("assistant").alias("role"), content.alias("content"), calls.alias("tool_calls"), F.array().cast(f"array<{_RESULT}>").alias("tool_results"), first("timestamp").alias("timestamp"), first("uuid").alias("uuid"))


def sessions(rec: DataFrame) -> DataFrame:
    """A row for each file with turns: session_id, cwd, turns in order of first occurrence, counts, runtime_type, mcp_servers."""
    talk = F.col("type").isin("user", "assistant")
    first = lambda c: F.coalesce(F.min_by(c, F.when(talk & (F.col(c) != ""), F.col("line_no"))), F.lit(""))
    servers = F.array_sort(F.collect_set("server"))
    ranks = [F.min("file_rank").alias("file_rank")] if "file_rank" in rec.columns else []
    facts = rec.groupBy("source_path", "folder").agg(first("session_id").alias("session_id"), first("cwd").alias("cwd"), F.count("*").alias("total_records"), F.count_if(talk).alias("conversation_records"), servers.alias("mcp_servers"), *ranks)
    runtime = F.when(F.size("mcp_servers") == 0, "claudecode").when(F.array_contains("mcp_servers", "prism-nvim"), "claudecode-nvim").otherwise("claudecode-mcp")
    turns = _user(rec).unionByName(_assistant(rec)).where("content is not null")
    listed = F.array_sort(F.collect_list(F.struct("place", "role", "content", "tool_calls", "tool_results", "timestamp", "uuid")))
    grouped = turns.groupBy("source_path").agg(F.transform(listed, lambda t: t.dropFields("place")).alias("turns"))
    return facts.withColumn("runtime_type", runtime).join(grouped, "source_path").where(F.size("turns") > 0)


def event_sessions(lines: DataFrame) -> DataFrame:
    """Sessions of the second transcript format, where a header line names session and folder and each message is an event:
    the same columns as ``sessions``, so both can be one union.

    Users' content is a text; assistants' a list of text and toolCall blocks, with thinking left out; a toolResult is a user
    turn with one result, wrapped as in the first format.
    """
    get = lambda path: F.get_json_object("line", path)
    rows = json_lines(lines).where("is_valid").select(
        "source_path", "folder", "line_no", *[c for c in ("file_rank",) if c in lines.columns], get("$.type").alias("type"), F.coalesce(get("$.id"), F.lit("")).alias("uuid"), F.coalesce(get("$.timestamp"), F.lit("")).alias("timestamp"), get("$.cwd").alias("cwd"),
        get("$.message.role").alias("side"), get("$.message.content").alias("content"), F.coalesce(get("$.message.toolCallId"), F.lit("")).alias("call_id"), F.coalesce(get("$.message.isError") == "true", F.lit(False)).alias("is_error"),
    )
    blocks = F.when(F.col("content").startswith("["), _blocks(F.col("content"))).otherwise(F.array().cast("array<string>"))
    said = rows.where("type = 'message' and side in ('user', 'assistant', 'toolResult')").withColumn("blocks", blocks)
    call = lambda b: F.struct(_text(b, "id").alias("id"), _text(b, "name").alias("name"), F.coalesce(F.get_json_object(b, "$.arguments"), F.lit("{}")).alias("input"), F.lit("standard").alias("source"), F.lit("").alias("mcp_server")).cast(_CALL)
    texts = F.transform(F.filter("blocks", lambda b: _text(b, "type") == "text"), lambda b: _text(b, "text"))
    body = F.when(F.size("blocks") > 0, F.array_join(texts, "\n")).otherwise(F.col("content"))
    shown = F.filter(F.transform(F.filter("blocks", lambda b: _text(b, "type").isin("text", "toolCall")), lambda b: F.when(_text(b, "type") == "text", strip(_text(b, "text"))).otherwise(format_call(call(b)))), lambda x: x != "")
    result = F.concat(F.lit('<tool_result tool_use_id="'), F.col("call_id"), F.lit('">\n'), body, F.lit("\n</tool_result>"))
    content = F.when(F.col("side") == "user", F.when(strip(body) != "", body)).when(F.col("side") == "assistant", F.when(F.size(shown) > 0, F.array_join(shown, "\n"))).otherwise(result)
    calls = F.when(F.col("side") == "assistant", F.transform(F.filter("blocks", lambda b: _text(b, "type") == "toolCall"), call)).otherwise(F.array().cast(f"array<{_CALL}>"))
    results = F.when(F.col("side") == "toolResult", F.array(F.struct(F.col("call_id").alias("tool_use_id"), body.alias("content"), F.col("is_error").alias("is_error")).cast(_RESULT))).otherwise(F.array().cast(f"array<{_RESULT}>"))
    turns = said.select("source_path", "line_no", F.when(F.col("side") == "assistant", "assistant").otherwise("user").alias("role"), content.alias("content"), calls.alias("tool_calls"), results.alias("tool_results"), "timestamp", "uuid").where("content is not null")
    listed = F.array_sort(F.collect_list(F.struct("line_no", "role", "content", "tool_calls", "tool_results", "timestamp", "uuid")))
    grouped = turns.groupBy("source_path").agg(F.transform(listed, lambda t: t.dropFields("line_no")).alias("turns"))
    head = lambda c: F.coalesce(F.min_by(c, F.when(F.col("type") == "session", F.col("line_no"))), F.lit(""))
    ranks = [F.min("file_rank").alias("file_rank")] if "file_rank" in rows.columns else []
    talk = F.col("side").isin("user", "assistant", "toolResult")
    facts = rows.groupBy("source_path", "folder").agg(head("uuid").alias("session_id"), head("cwd").alias("cwd"), F.count("*").alias("total_records"), F.count_if(talk).alias("conversation_records"), *ranks)
    return facts.withColumns({"mcp_servers": F.array().cast("array<string>"), "runtime_type": F.lit("events")}).join(grouped, "source_path")


def read_sessions(spark: SparkSession, base: str, folder_prefix: str = "") -> DataFrame:
    """All sessions under ``base``/<folder>/<file>.jsonl, with file_rank, newest first."""
    return sessions(records(discover(read_lines(spark, f"{base}/*/*.jsonl"), folder_prefix)))
