"""Other inputs: rejections, general samples, evaluation data, scenarios, telemetry, local logs, workflow definitions, prompts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import json_lines, read_json, read_lines

REJECTION = "session_id string, role string, prompt string, draft_response string, target_response string, rejection_reason string, acceptance_score double, draft_logprobs array<double>, target_logprobs array<double>"
MESSAGES = "array<struct<from:string,value:string>>"
SAMPLE = f"conversations {MESSAGES}, metadata struct<role:string,session_id:string,chunk_index:int,quality_score:double,source:string,runtime_type:string,mcp_servers:array<string>,outcome_score:double>"
SCENARIO = "role string, scenario string, system string, user string, expected_behaviors array<string>"
EVALUATION = "struct<input_ids:array<int>,target_token_ids:array<int>,target_logprobs:array<array<double>>,role:string,sample_id:string>"
STEP = "array<struct<id:string,title:string,description:string,acceptance:string,needs:array<string>>>"
FORMULA = f"path string, formula string, type string, description string, version int, steps {STEP}, vars map<string,struct<description:string,required:boolean,has_default:boolean>>, error string"


def rejections(spark: SparkSession, path: str, role: str | None = None) -> DataFrame:
    """Rejection rows of all files, columns that a file lacks as nulls; the role goes to the scan as a filter."""
    out = spark.read.schema(REJECTION).option("mergeSchema", "true").parquet(path)
    return out.where(F.col("role") == role) if role else out


def general_samples(spark: SparkSession, path: str, role: str | None = None) -> DataFrame:
    out = read_json(spark, path, SAMPLE)
    return out.where(F.col("metadata.role") == role) if role else out


def evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation rows; role unknown and sample_<line> (from 0, blank lines counted) where they are missing."""
    rows = json_lines(read_lines(spark, path)).where("is_valid").select("line_no", F.from_json("line", EVALUATION).alias("e")).select("line_no", "e.*")
    return rows.withColumn("role", F.coalesce("role", F.lit("unknown"))).withColumn("sample_id", F.coalesce("sample_id", F.format_string("sample_%04d", "line_no"))).drop("line_no")


def scenarios(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, SCENARIO)


def telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Log entries with flat dotted keys, as the linker needs them; ordinal is their place in the file."""
    get = lambda key: F.get_json_object("line", f"$['{key}']")
    rows = json_lines(read_lines(spark, path)).where("is_valid")
    return rows.select(F.coalesce(get("gt.session"), get("session_id")).alias("session_id"), get("_msg").alias("message"), get("_time").alias("time"), get("exit_type").alias("exit_type"), get("status").alias("status"), get("gt.topic").alias("topic"), get("gt.issue").alias("issue"), get("_stream").alias("stream"), F.struct("source_path", "line_no").alias("ordinal"))


METRICS = "status string, data struct<resultType:string,result:array<struct<metric:map<string,string>,value:array<string>,values:array<array<string>>>>>"


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """name, labels, time and value of saved answers of a metrics server, one JSON object a file or line, instants and ranges; failed answers give no rows."""
    rows = json_lines(read_lines(spark, path)).where("is_valid").select(F.from_json("line", METRICS).alias("a")).where("a.status = 'success'")
    each = rows.select(F.explode("a.data.result").alias("r"))
    points = each.select(F.col("r.metric").alias("labels"), F.explode(F.concat(F.coalesce("r.values", F.array().cast("array<array<string>>")), F.when(F.col("r.value").isNotNull(), F.array("r.value")).otherwise(F.array().cast("array<array<string>>")))).alias("p"))
    return points.select(F.try_element_at("labels", F.lit("__name__")).alias("name"), "labels", F.timestamp_seconds(F.col("p")[0].cast("double")).alias("time"), F.col("p")[1].try_cast("double").alias("value"))


def local_log(spark: SparkSession, path: str, *fields: str) -> DataFrame:
    """session_id, line_no and fields of a local JSON-lines log; bad lines are left out."""
    rows = json_lines(read_lines(spark, path)).where("is_valid")
    return rows.select(F.get_json_object("line", "$.session_id").alias("session_id"), "line_no", *(F.get_json_object("line", f"$.{f}").alias(f) for f in fields)).where("session_id is not null")


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """role and prompt of one JSON object of prompts by role."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("role", "prompt"))


def formulas(spark: SparkSession, *paths: str) -> DataFrame:
    """Workflow definitions from TOML files, each path once; a file that can't be read is a row with an error.

    TOML has no built-in reader, so the small files are parsed in Python, a file a row.
    """
    import tomllib

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_formula(p, c) for p, c in zip(batch["path"], batch["content"])], columns=[x.split()[0] for x in ("path", "formula", "type", "description", "version", "steps", "vars", "error")])

    def _formula(path: str, content: bytes) -> dict:
        try:
            data = tomllib.loads(bytes(content).decode())
        except (tomllib.TOMLDecodeError, UnicodeDecodeError) as e:
            return {"path": path, "formula": path.rsplit("/", 1)[-1], "type": None, "description": None, "version": None, "steps": None, "vars": None, "error": str(e)}
        text = lambda x: None if x is None else str(x)
        steps = [{k: text(s.get(k)) for k in ("id", "title", "description", "acceptance")} | {"needs": [str(n) for n in s.get("needs", [])]} for s in data.get("steps", [])]
        found = {k: {"description": text(v.get("description")), "required": bool(v.get("required", False)), "has_default": "default" in v} for k, v in data.get("vars", {}).items() if isinstance(v, dict)}
        version = data.get("version", 0)
        return {"path": path, "formula": text(data.get("formula", "")), "type": text(data.get("type", "")), "description": text(data.get("description", "")), "version": version if isinstance(version, int) else 0, "steps": steps, "vars": found, "error": None}

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content").dropDuplicates(["path"])
    return files.mapInPandas(parse, FORMULA)
