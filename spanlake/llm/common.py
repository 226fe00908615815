"""Helpers shared by the operators: tables, shared work folders, written stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Only a session on one machine may leave the setting out (tests); it then
    gets a temporary folder. On a cluster a missing setting is an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spanlake-llm-")
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, keeps
    later jobs from computing it again, and survives lost executors."""
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names (new=old), found by position, so that
    other columns whose names clash or differ only in case do no harm."""
    at = {new: df.columns.index(old) for new, old in columns.items()}
    bare = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return bare.select(*[F.col(f"_{i}").alias(new) for new, i in at.items()])


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): null text read as empty."""
    return pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
