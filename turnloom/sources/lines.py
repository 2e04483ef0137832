"""Text files as numbered lines, and JSON lines with the bad ones told apart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """source_path, folder, file_name, file_mtime, line_no (from 0, blank lines counted) and line, stripped and not blank.

    A file is read as a whole, which keeps its line numbers; transcripts are some megabytes.
    """
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_modification_time").alias("file_mtime"))
    rows = files.select("source_path", F.element_at(F.split("source_path", "/"), -2).alias("folder"), "file_name", "file_mtime", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return rows.withColumn("line", F.regexp_replace("line", r"(?U)^\s+|\s+\z", "")).where("line != ''")


def json_lines(lines: DataFrame) -> DataFrame:
    """Adds ``is_valid``: the line is a JSON object. Each reader chooses what to do with the others."""
    return lines.withColumn("is_valid", F.coalesce(F.schema_of_variant(F.try_parse_json("line")).startswith("OBJECT"), F.lit(False)))


def discover(lines: DataFrame, folder_prefix: str = "", most: int | None = None) -> DataFrame:
    """Leaves out files named ``sessions-...`` and folders without the prefix; adds file_rank, newest file first (ties by path), and
    if asked for only the ``most`` newest files.

    Of the files, which are few against the lines, one row each is ranked; the ranks go to the lines by a join that
    Spark broadcasts while the list is small.
    """
    kept = lines.where(~F.col("file_name").startswith("sessions-") & F.col("folder").startswith(folder_prefix))
    files = kept.groupBy("source_path").agg(F.max("file_mtime").alias("file_mtime"))
    ranked = files.withColumn("file_rank", F.row_number().over(Window.orderBy(F.desc("file_mtime"), "source_path")))
    ranked = ranked if most is None else ranked.where(F.col("file_rank") <= most)
    return kept.join(ranked.select("source_path", "file_rank"), "source_path")


def read_existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``read_json``, but no rows where there is no such path."""
    try:
        return read_json(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines by a declared schema; lines that don't parse give nulls."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str, *partitions: str, single_file: bool = False) -> None:
    """JSON lines, by partitions if any are named; one file only where asked for (small exports)."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).json(path)
