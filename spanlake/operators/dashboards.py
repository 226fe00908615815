"""The reference's SQL views and dashboard queries.

Every function is DataFrame -> DataFrame. Filters sit directly on the scan so
Catalyst pushes them into the parquet reader; projections list only what the
query returns so the reader prunes the map columns. Top-k queries use
orderBy(...).limit(k) with an explicit tie-break, planned as
TakeOrderedAndProject (a per-partition heap, no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions.exprs import avg_seconds, duration_ms, duration_s, error_count, map_text
from spanlake.functions.scans import grouped_percentiles

# Fixed values that must equal the reference's.
TRAINING = "TRAINING"
ERROR = "ERROR"
SLOW_SECONDS = 10
RECENT_DAYS = 30


def _since_midnight(as_of: str, days: int):
    """CURRENT_DATE() - INTERVAL n DAYS with a fixed `as_of` date, as TIMESTAMP_NTZ."""
    return F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")


def _since_instant(as_of: str, hours: int):
    """CURRENT_TIMESTAMP - INTERVAL n HOUR with a fixed `as_of` instant."""
    return F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(hours))


# ---- S11 views -------------------------------------------------------------

def recent_traces(spans: DataFrame, as_of: str, days: int = RECENT_DAYS) -> DataFrame:
    """Q1 view: spans since midnight `days` before `as_of`, with duration."""
    return spans.filter(F.col("timestamp") >= _since_midnight(as_of, days)).select(
        "request_id", "trace_id", "span_name", "span_type", "start_time_ms", "end_time_ms",
        duration_s().alias("duration_seconds"), "status", "experiment_id", "timestamp",
    )


def training_performance(spans: DataFrame) -> DataFrame:
    """Q2 view: per TRAINING span_name count, avg/min/max seconds, errors, last run."""
    return (
        spans.filter(F.col("span_type") == TRAINING)
        .groupBy("span_name")
        .agg(
            F.count(F.lit(1)).alias("execution_count"),
            avg_seconds().alias("avg_duration_seconds"),
            F.min(duration_s()).alias("min_duration_seconds"),
            F.max(duration_s()).alias("max_duration_seconds"),
            error_count().alias("error_count"),
            F.max("timestamp").alias("last_execution"),
        )
    )


def error_traces(spans: DataFrame) -> DataFrame:
    """Q3 view: ERROR spans with attributes and duration."""
    return spans.filter(F.col("status") == ERROR).select(
        "request_id", "trace_id", "span_name", "span_type", "status", "attributes", "timestamp",
        duration_s().alias("duration_seconds"),
    )


def trace_lineage(spans: DataFrame) -> DataFrame:
    """Q4 view / J1: each span with its parent's name (left self-join on trace + parent id).

    Both sides shuffle on (trace_id, span id); a hot parent (many children)
    is split by AQE's skew-join handling on the child side.
    """
    t = spans.select("trace_id", "span_id", "span_name", "span_type", "parent_span_id",
                     "start_time_ms", "end_time_ms")
    p = spans.select(F.col("trace_id").alias("p_trace_id"), F.col("span_id").alias("p_span_id"),
                     F.col("span_name").alias("parent_span_name"))
    j = t.join(p, (t.parent_span_id == p.p_span_id) & (t.trace_id == p.p_trace_id), "left")
    return j.select("trace_id", "span_id", "span_name", "span_type", "parent_span_id",
                    "parent_span_name", "start_time_ms", "end_time_ms")


def register_views(spans: DataFrame, as_of: str, prefix: str = "") -> list[str]:
    """Publish the four named views as temp views; returns their names."""
    views = {
        "recent_traces": recent_traces(spans, as_of),
        "training_performance": training_performance(spans),
        "error_traces": error_traces(spans),
        "trace_lineage": trace_lineage(spans),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]


# ---- commented / notebook / doc queries ------------------------------------

def q1_recent(spans, as_of, days=RECENT_DAYS):
    return recent_traces(spans, as_of, days).orderBy(F.desc("start_time_ms"), "trace_id")


def q5_recent_top(spans, as_of, days=7, k=100):
    """Q5: the Q1 view filtered to the last `days`, first `k` by start (desc);
    ties by trace and span."""
    v = recent_traces(spans, as_of)
    return v.filter(F.col("timestamp") >= _since_midnight(as_of, days)) \
            .orderBy(F.desc("start_time_ms"), "trace_id", "span_id").limit(k).select(*v.columns)


def q6_training_by_count(spans):
    return training_performance(spans).orderBy(F.desc("execution_count"), "span_name")


def q7_slow_operations(spans, threshold_s=SLOW_SECONDS, k=50):
    d = duration_s()
    return (spans.filter(d > threshold_s)
            .select("span_name", d.alias("duration_seconds"), "status", "timestamp", "span_id")
            .orderBy(F.desc("duration_seconds"), "span_id").limit(k).drop("span_id"))


def q8_lineage_of(spans, trace_id: str):
    """Q8: the filter on the join key is pushed to both sides of the self-join."""
    return trace_lineage(spans).filter(F.col("trace_id") == trace_id).orderBy("start_time_ms", "span_id")


def q9_latest_training(spans, k=10):
    return (spans.filter(F.col("span_type") == TRAINING)
            .select("request_id", "trace_id", "span_name", "span_type", "start_time_ms", "end_time_ms",
                    "status", "request_metadata", "attributes", "span_id")
            .orderBy(F.desc("start_time_ms"), "span_id").limit(k).drop("span_id"))


def q10_latest_spans(spans, k=20):
    return (spans.select("request_id", "trace_id", "span_name", "span_type", "start_time_ms", "end_time_ms",
                         duration_s().alias("duration_seconds"), "status", "timestamp", "span_id")
            .orderBy(F.desc("start_time_ms"), "span_id").limit(k).drop("span_id"))


def q11_training_summary(spans):
    return (spans.filter(F.col("span_type") == TRAINING).groupBy("span_name")
            .agg(F.count(F.lit(1)).alias("execution_count"), avg_seconds().alias("avg_duration_seconds"),
                 F.max(duration_s()).alias("max_duration_seconds"), error_count().alias("error_count"))
            .orderBy(F.desc("execution_count"), "span_name"))


def q12_most_recent_trace(spans):
    """Q12: the trace holding the latest span start.

    max over traces of max(start) is the global max start, so a top-1 over the
    spans answers it without grouping by trace (no shuffle of trace ids).
    Ties: smallest trace_id.
    """
    return spans.select("trace_id", "start_time_ms").orderBy(F.desc("start_time_ms"), "trace_id") \
                .limit(1).select("trace_id")


def q13_latest_hierarchy(spans):
    """Q13: spans of the Q12 trace. The one-row Q12 result is broadcast into a
    semi-join, so there is no driver round trip and no interpolated SQL."""
    latest = q12_most_recent_trace(spans)
    return (spans.join(F.broadcast(latest), "trace_id", "left_semi")
            .select("span_id", "span_name", "span_type", "parent_span_id",
                    duration_s().alias("duration_seconds"), "status", "start_time_ms")
            .orderBy("start_time_ms", "span_id").drop("start_time_ms"))


def q14_duration_profile(spans):
    """Q14: per span_type count, avg/min/max seconds, median and p95.

    The percentiles are exact: ranks over the counts per (type, duration), with
    no value map per group (`scans.grouped_percentiles`)."""
    plain = spans.groupBy("span_type").agg(
        F.count(F.lit(1)).alias("total_executions"), avg_seconds().alias("avg_duration"),
        F.min(duration_s()).alias("min_duration"), F.max(duration_s()).alias("max_duration"))
    pct = grouped_percentiles(spans.select("span_type", duration_ms().alias("ms")), "span_type", "ms",
                              {"median_ms": 0.5, "p95_ms": 0.95})
    return (plain.join(pct.withColumnRenamed("span_type", "_type"), F.col("span_type").eqNullSafe(F.col("_type")), "left")
            .select("span_type", "total_executions", "avg_duration", "min_duration", "max_duration",
                    (F.col("median_ms") / F.lit(1000.0)).alias("median_duration"),
                    (F.col("p95_ms") / F.lit(1000.0)).alias("p95_duration"))
            .orderBy(F.desc("avg_duration"), "span_type"))


def q15_latest_errors(spans, k=10):
    return (spans.filter(F.col("status") == ERROR)
            .select("request_id", "trace_id", "span_name", "span_type", "status", "attributes", "timestamp", "span_id")
            .orderBy(F.desc("timestamp"), "span_id").limit(k).drop("span_id"))


def q16_newest(spans, k=10):
    """Q16: the k newest spans, all columns. Top-k over the sort key alone, then
    the rows of those keys, cut to k again in case a span was delivered twice."""
    keys = ["start_time_ms", "span_id", "trace_id"]
    top = spans.select(*keys).orderBy(F.desc("start_time_ms"), "span_id", "trace_id").limit(k).distinct()
    top = top.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return (spans.join(F.broadcast(top), same, "left_semi")      # k keys at most
            .orderBy(F.desc("start_time_ms"), "span_id", "trace_id").limit(k))


def q17_avg_training_seconds(spans):
    return spans.filter(F.col("span_type") == TRAINING).groupBy("span_name").agg(avg_seconds().alias("avg_seconds"))


def q18_all_errors(spans):
    return spans.filter(F.col("status") == ERROR).orderBy(F.desc("timestamp"), "span_id")


def q19_error_alert(spans, as_of: str, hours: int = 1, threshold: int = 10):
    """Q19: one row when the errors in the last `hours` exceed `threshold`, else none."""
    n = (spans.filter((F.col("status") == ERROR) & (F.col("timestamp") >= _since_instant(as_of, hours)))
         .agg(F.count(F.lit(1)).alias("error_count")))
    return n.filter(F.col("error_count") > threshold)


def q20_recent_training(spans, k=10):
    return (spans.filter(F.col("span_type") == TRAINING)
            .select("span_name", duration_s().alias("duration_seconds"), "status", "start_time_ms", "span_id")
            .orderBy(F.desc("start_time_ms"), "span_id").limit(k).drop("start_time_ms", "span_id"))


def q21_avg_by_operation(spans):
    return (spans.groupBy("span_name")
            .agg(F.count(F.lit(1)).alias("executions"), avg_seconds().alias("avg_seconds"))
            .orderBy(F.desc("avg_seconds"), "span_name"))


def q22_error_rate(spans):
    return (spans.groupBy("span_type")
            .agg(F.count(F.lit(1)).alias("total"), error_count().alias("errors"))
            .withColumn("error_rate_pct", F.col("errors").cast("double") * F.lit(100.0) / F.col("total")))


def q23_latest_requests(spans, k=10):
    return (spans.select("request_id", "span_name", "span_type", "status",
                         duration_s().alias("duration_seconds"), "start_time_ms", "span_id")
            .orderBy(F.desc("start_time_ms"), "span_id").limit(k).drop("start_time_ms", "span_id"))


def q24_training_by_avg(spans):
    return (spans.filter(F.col("span_type") == TRAINING).groupBy("span_name")
            .agg(avg_seconds().alias("avg_duration_seconds"), F.count(F.lit(1)).alias("execution_count"),
                 error_count().alias("error_count"))
            .orderBy(F.desc("avg_duration_seconds"), "span_name"))


def q25_failed(spans):
    return (spans.filter(F.col("status") == ERROR)
            .select("request_id", "trace_id", "span_name", "status", "attributes", "start_time_ms", "span_id")
            .orderBy(F.desc("start_time_ms"), "span_id").drop("start_time_ms", "span_id"))


def q26_count(spans):
    return spans.agg(F.count(F.lit(1)).alias("trace_count"))


def flatten_maps(df: DataFrame) -> DataFrame:
    """Comparable form: map columns as sorted 'k=v' text, the events array as its size."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "map":
            out.append(map_text(f.name).alias(f.name))
        elif t == "array":
            out.append(F.size(f.name).alias(f"{f.name}_count"))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
