"""The span table at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanlake.schema import SPAN


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    """Scan a span table with the declared schema (no inference, so partition
    values such as experiment_id keep their STRING type)."""
    return spark.read.schema(SPAN).parquet(path)
