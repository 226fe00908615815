"""Registry of named queries: id -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the
derived tables. Computed columns carry the same alias in both forms. Map
columns are compared in their sorted 'k=v' text form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanlake.sources.fixtures import load_table

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(qid: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if qid in REGISTRY:
            raise ValueError(f"duplicate query id {qid}")
        REGISTRY[qid] = (fn, oracle)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "spans")


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # importing the modules registers their queries
    from spanlake.plans import (  # noqa: F401
        q_dashboards, q_lineage, q_filtering, q_annotations, q_sessions, q_evaluation, q_monitoring, q_streaming,
    )
    return REGISTRY
