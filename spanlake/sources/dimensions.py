"""Experiment and run dimensions (S2, S3) and the dimension join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.schema import EXPERIMENT, RUN


def experiments_from_spans(spans: DataFrame) -> DataFrame:
    """One row per experiment seen in the span table, tagged with its
    numbers of spans and of failed ones."""
    g = spans.groupBy("experiment_id").agg(
        F.min("timestamp").alias("creation_time"), F.max("timestamp").alias("last_update_time"),
        F.count(F.lit(1)).alias("n_spans"), F.count_if(F.coalesce(F.col("status") == "ERROR", F.lit(False))).alias("n_errors"))
    return g.select(
        "experiment_id",
        F.concat(F.lit("experiment-"), "experiment_id").alias("name"),
        F.concat(F.lit("/experiments/"), "experiment_id").alias("artifact_location"),
        F.lit("active").alias("lifecycle_stage"),
        "creation_time", "last_update_time",
        F.create_map(F.lit("n_spans"), F.col("n_spans").cast("string"), F.lit("n_errors"), F.col("n_errors").cast("string")).alias("tags"),
    ).select(*[f.name for f in EXPERIMENT.fields])


def runs_from_spans(spans: DataFrame) -> DataFrame:
    """S3: one run per trace (root span's experiment and name; its attributes
    are the params, the trace's span counts the metrics)."""
    from spanlake.operators.lineage import trace_summary
    s = trace_summary(spans, with_payload=False, with_session=False)
    root = F.struct(F.col("parent_span_id").isNotNull(), "start_time_ms", "span_id")
    times = spans.groupBy("trace_id").agg(F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"),
                                          F.min_by("attributes", root).alias("params"))
    j = s.join(times, "trace_id")
    return j.select(
        F.concat(F.lit("run-"), "trace_id").alias("run_id"),
        "experiment_id",
        F.col("root_span_name").alias("run_name"),
        F.when(F.col("error_span_count") > 0, "FAILED").otherwise("FINISHED").alias("status"),
        "start_time", "end_time",
        F.concat(F.lit("/experiments/"), "experiment_id", F.lit("/"), "trace_id").alias("artifact_uri"),
        F.lit("active").alias("lifecycle_stage"),
        "params",
        F.create_map(F.lit("n_spans"), F.col("span_count").cast("double"), F.lit("n_errors"), F.col("error_span_count").cast("double")).alias("metrics"),
    ).select(*[f.name for f in RUN.fields])


def read_dimension(spark, path: str, kind: str) -> DataFrame:
    """S2/S3 scan of a stored dimension with its declared schema."""
    return spark.read.schema({"experiment": EXPERIMENT, "run": RUN}[kind]).parquet(path)


def join_dimension(facts: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Fact ⋈ dimension, without a hint: Spark broadcasts the dimension when
    its size in bytes, estimated or measured at run time (AQE), is under its
    threshold, and otherwise shuffles both sides, splitting a hot key."""
    return facts.join(dim, key, how)
