"""What the operators share: tables, the shared checkpoint folder, sizes."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

#: Document ids that are null are ordered after all others, among themselves by a hash of the text.
NULL_KEY_BASE = 1 << 62


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the folder that the session names. Only a local master may go without: it gets a temporary one,
    which other machines would not see.
    """
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="turnloom-"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def document_key(doc_id: str = "doc_id", text: str = "text"):
    """A long that orders documents: the id, or for a null id a hash of the text above all ids (ids stay under 2**62)."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_KEY_BASE) + F.xxhash64(F.col(text)).bitwiseAND(F.lit(NULL_KEY_BASE - 1)))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts; one pass over that column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]


def blocks_for(n_bytes: int, target: int, least: int) -> int:
    return max(1, least, math.ceil(n_bytes / target))


def nullable(kind: DataType) -> DataType:
    """The type with every part of it nullable, as data that come back from Python are."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(nullable(kind.elementType))
    return MapType(kind.keyType, nullable(kind.valueType)) if isinstance(kind, MapType) else kind
