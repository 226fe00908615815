"""Dashboards, alerts, SLOs and table maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions.exprs import avg_seconds, duration_ms, error_count
from spanlake.functions.scans import grouped_percentiles

MAD_SCALE = 0.6745        # robust z-score constant (Iglewicz & Hoaglin)
MAD_THRESHOLD = 3.5
RETENTION_DAYS = 7        # fixed value: VACUUM ... RETAIN 168 HOURS


def dashboard(spans: DataFrame, unit: str = "hour") -> DataFrame:
    """M1: throughput, errors and latency per time bucket (date_trunc)."""
    b = F.date_trunc(unit, F.col("timestamp")).cast("timestamp_ntz")
    return spans.groupBy(b.alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("n_spans"),
        F.count_distinct("trace_id").alias("n_traces"),
        error_count().alias("n_errors"),
        (error_count().cast("double") * F.lit(100.0) / F.count(F.lit(1))).alias("error_rate_pct"),
        avg_seconds().alias("avg_seconds"),
        (F.max(duration_ms()).cast("double") / F.lit(1000.0)).alias("max_seconds"),
    )


def unusual_durations(spans: DataFrame, group: str = "span_name", threshold: float = MAD_THRESHOLD) -> DataFrame:
    """M2 'unusual patterns': spans whose duration has robust z-score
    |0.6745 (x - median) / MAD| > threshold within their group.

    Median and MAD are exact and come from the counts per (group, duration):
    both percentiles see one row per distinct duration, and the spans are
    scanned once for the counts and once more for the join with the group
    statistics (one row per group)."""
    base = spans.select("span_id", "trace_id", group, duration_ms().alias("ms")).filter(F.col("ms").isNotNull() & F.col(group).isNotNull())
    hist = base.groupBy(group, "ms").agg(F.count(F.lit(1)).alias("n"))
    med = grouped_percentiles(hist, group, "ms", {"median_ms": 0.5}, count="n")
    dev = hist.join(med, group).withColumn("absdev", F.abs(F.col("ms").cast("double") - F.col("median_ms")))
    mad = grouped_percentiles(dev, group, "absdev", {"mad_ms": 0.5}, count="n")
    j = base.join(med.join(mad.filter(F.col("mad_ms") > 0), group), group)
    z = F.lit(MAD_SCALE) * (F.col("ms").cast("double") - F.col("median_ms")) / F.col("mad_ms")
    return (j.select("span_id", "trace_id", group, F.col("ms").alias("duration_ms"), "median_ms", "mad_ms",
                     z.alias("robust_z"))
            .filter(F.abs(F.col("robust_z")) > threshold))


def slo_report(spans: DataFrame, latency_s: float = 10.0, slo: float = 0.99, by: str = "span_type",
               unit: str = "day") -> DataFrame:
    """M3: per bucket and group, the share of spans under the latency threshold,
    the error rate and the remaining error budget 1 - error_rate / (1 - slo)."""
    b = F.date_trunc(unit, F.col("timestamp")).cast("timestamp_ntz")
    fast = F.coalesce(duration_ms() <= F.lit(int(latency_s * 1000)), F.lit(False))
    g = spans.groupBy(b.alias("bucket_start"), by).agg(
        F.count(F.lit(1)).alias("n_spans"),
        (F.count_if(fast).cast("double") / F.count(F.lit(1))).alias("latency_sli"),
        (error_count().cast("double") / F.count(F.lit(1))).alias("error_rate"))
    return g.withColumn("error_budget_remaining", F.lit(1.0) - F.col("error_rate") / F.lit(1.0 - slo))


def _as_checks(one_row: DataFrame) -> DataFrame:
    """A one-row frame of counters as rows (check_name, violations)."""
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check_name"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("violations"))
        for c in one_row.columns])).alias("c")).select("c.*")


def contract_audit(spans: DataFrame, experiments: DataFrame | None = None, runs: DataFrame | None = None) -> DataFrame:
    """Violation counts per check: NOT NULL request_id/span_id, end before
    start, duplicate span ids inside a trace, dangling parents, and duplicate or
    null primary keys of the dimensions.

    The row checks are one aggregate. Duplicates and dangling parents come from
    one pass: every span names its own id and its parent's, and each (trace, id)
    counts both kinds of mention; partial counts keep a parent of very many
    children from being one group. A null trace id matches no parent."""
    surplus = lambda n: F.sum(F.when(F.col(n) > 1, F.col(n) - 1))
    row = spans.agg(
        F.count_if(F.col("request_id").isNull()).alias("null_request_id"),
        F.count_if(F.col("span_id").isNull()).alias("null_span_id"),
        F.count_if(F.coalesce(F.col("end_time_ms") < F.col("start_time_ms"), F.lit(False))).alias("end_before_start"))
    mention = lambda c, own: F.struct(F.col(c).alias("id"), F.lit(own).alias("own"))
    named = (spans.select("trace_id", F.explode(F.array(mention("span_id", 1), mention("parent_span_id", 0))).alias("m"))
             .filter(F.col("m.id").isNotNull())
             .groupBy("trace_id", "m.id").agg(F.sum("m.own").alias("n"), F.sum(1 - F.col("m.own")).alias("n_children")))
    keyed = named.agg(
        surplus("n").alias("duplicate_span_id"),
        F.sum(F.when((F.col("n") == 0) | F.col("trace_id").isNull(), F.col("n_children"))).alias("dangling_parent"))
    out = _as_checks(row).unionByName(_as_checks(keyed))
    for name, dim, key in (("experiment", experiments, "experiment_id"), ("run", runs, "run_id")):
        if dim is not None:
            per = dim.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
            out = out.unionByName(_as_checks(per.agg(
                F.sum(F.when(F.col("k").isNotNull() & (F.col("n") > 1), F.col("n") - 1)).alias(f"{name}_pk_duplicate"),
                F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias(f"{name}_null_key"))))
    return out


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: rows, nulls, distinct values, min and max (as text).

    Counts, min and max are one aggregate. The distinct values are counted from
    (column, value) pairs: duplicates go in the partial aggregate and every
    value is a group of its own, so no column's values meet in one task. Map and
    array columns need a comparable form first (`dashboards.flatten_maps`)."""
    columns = columns or df.columns
    plain = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        plain += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                  F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max")]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"{c}__nulls").alias("n_nulls"),
                     F.col(f"{c}__min").alias("min_value"), F.col(f"{c}__max").alias("max_value")) for c in columns]
    stats = df.agg(*plain).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                                          for c in columns])).alias("p")).select("p.*")
    values = pairs.filter(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.lit(1).alias("one"))
    distinct = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    return (stats.join(distinct, "column_name", "left")
            .select("column_name", "n_rows", "n_nulls", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
                    "min_value", "max_value"))


def with_span_date(spans: DataFrame) -> DataFrame:
    """C4: derived partition column (the table format's days(timestamp))."""
    return spans.withColumn("span_date", F.to_date("timestamp"))


def retention_tiers(spans: DataFrame, as_of: str, days: int = RETENTION_DAYS) -> DataFrame:
    """C3 re-aimed as rows: 'archive' when older than as_of - days, else 'live'."""
    cut = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return with_span_date(spans).withColumn(
        "tier", F.when(F.col("timestamp") < cut, F.lit("archive")).otherwise(F.lit("live")))


def write_partitioned(spans: DataFrame, path: str, mode: str = "append") -> None:
    """C4 sink: date-partitioned span table; rebalance first so each date is
    written by as many tasks as its size needs (a hot day is split)."""
    (with_span_date(spans).hint("rebalance", "span_date").sortWithinPartitions("span_date", "trace_id", "start_time_ms")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")  # overwrite only the dates written
     .partitionBy("span_date").parquet(path))


def write_retention(spans: DataFrame, live_path: str, archive_path: str, as_of: str, days: int = RETENTION_DAYS) -> None:
    """C3 sink: live and archive tables, each date-partitioned, overwriting only
    the dates present (dynamic partition overwrite)."""
    t = retention_tiers(spans, as_of, days)
    write_partitioned(t.filter(F.col("tier") == "live").drop("tier", "span_date"), live_path, mode="overwrite")
    write_partitioned(t.filter(F.col("tier") == "archive").drop("tier", "span_date"), archive_path, mode="overwrite")

