"""Registered monitoring / maintenance queries: M1-M3, C1-C4."""

from pyspark.sql import functions as F

from spanlake.operators import monitoring as M
from spanlake.operators import sketches as K
from spanlake.operators.dashboards import flatten_maps
from spanlake.plans.fixture_sql import percentile_ctes, with_tables
from spanlake.plans.q_dashboards import ALL_SPANS_SQL, TAG_TEXT_CTE
from spanlake.plans.registry import query, spans
from spanlake.session import scratch_dir
from spanlake.sources import dimensions as D

AS_OF_RETENTION = "2024-01-31 00:00:00"
PROFILE_COLUMNS = ["request_id", "trace_id", "span_id", "span_name", "span_type", "parent_span_id", "start_time_ms",
                   "end_time_ms", "status", "attributes", "events_count", "request_metadata", "execution_order",
                   "inputs", "outputs", "tags", "experiment_id", "timestamp"]


@query("m1_dashboard_hourly", with_tables("""
SELECT date_trunc('hour', timestamp) AS bucket_start, count(*) AS n_spans, count(DISTINCT trace_id) AS n_traces,
 count(*) FILTER (WHERE status = 'ERROR') AS n_errors,
 CAST(count(*) FILTER (WHERE status = 'ERROR') AS DOUBLE) * 100.0 / count(*) AS error_rate_pct,
 CAST(SUM(end_time_ms - start_time_ms) AS DOUBLE) / COUNT(end_time_ms - start_time_ms) / 1000.0 AS avg_seconds,
 CAST(max(end_time_ms - start_time_ms) AS DOUBLE) / 1000.0 AS max_seconds
FROM spans GROUP BY 1""", "spans"))
def m1(spark, sf):
    return M.dashboard(spans(spark, sf))


M2_CTE = """
base AS (SELECT span_id, trace_id, span_name, end_time_ms - start_time_ms AS ms FROM spans
  WHERE end_time_ms IS NOT NULL),""" + percentile_ctes("base", "span_name", "ms", {"med": 0.5}, name="pm") + """,
dev AS (SELECT b.*, pm.med AS median_ms, abs(CAST(b.ms AS DOUBLE) - pm.med) AS absdev FROM base b
  JOIN pm ON pm.g = b.span_name),""" + percentile_ctes("dev", "span_name", "absdev", {"mad": 0.5}, name="pd")


@query("m2_unusual_durations", with_tables("""
SELECT * FROM (SELECT d.span_id, d.trace_id, d.span_name, d.ms AS duration_ms, d.median_ms, pd.mad AS mad_ms,
  0.6745 * (CAST(d.ms AS DOUBLE) - d.median_ms) / pd.mad AS robust_z
  FROM dev d JOIN pd ON pd.g = d.span_name WHERE pd.mad > 0) WHERE abs(robust_z) > 3.5""", "spans", extra=M2_CTE))
def m2(spark, sf):
    return M.unusual_durations(spans(spark, sf))


@query("m3_slo_report", with_tables("""
SELECT bucket_start, span_type, n_spans, latency_sli, error_rate,
 1.0 - error_rate / (CAST(1.0 AS DOUBLE) - CAST(0.99 AS DOUBLE)) AS error_budget_remaining FROM (
 SELECT date_trunc('day', timestamp) AS bucket_start, span_type, count(*) AS n_spans,
  CAST(count(*) FILTER (WHERE coalesce(end_time_ms - start_time_ms <= 10000, false)) AS DOUBLE) / count(*) AS latency_sli,
  CAST(count(*) FILTER (WHERE status = 'ERROR') AS DOUBLE) / count(*) AS error_rate
 FROM spans GROUP BY 1, 2)""", "spans"))
def m3(spark, sf):
    return M.slo_report(spans(spark, sf))


@query("c1_contract_audit", with_tables("""
SELECT 'null_request_id' AS check_name, count(*) FILTER (WHERE request_id IS NULL) AS violations FROM spans
UNION ALL SELECT 'null_span_id', count(*) FILTER (WHERE span_id IS NULL) FROM spans
UNION ALL SELECT 'end_before_start', count(*) FILTER (WHERE end_time_ms < start_time_ms) FROM spans
UNION ALL SELECT 'duplicate_span_id', coalesce(sum(n - 1), 0) FROM
  (SELECT count(*) AS n FROM spans WHERE span_id IS NOT NULL GROUP BY trace_id, span_id HAVING count(*) > 1)
UNION ALL SELECT 'dangling_parent', count(*) FROM spans c WHERE parent_span_id IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM spans p WHERE p.trace_id = c.trace_id AND p.span_id = c.parent_span_id)
UNION ALL SELECT 'experiment_pk_duplicate', count(k) - count(DISTINCT k) FROM exps
UNION ALL SELECT 'experiment_null_key', count(*) FROM exps WHERE k IS NULL
UNION ALL SELECT 'run_pk_duplicate', count(k) - count(DISTINCT k) FROM run_keys
UNION ALL SELECT 'run_null_key', count(*) FROM run_keys WHERE k IS NULL""", "spans", extra="""
exps AS (SELECT experiment_id AS k FROM (SELECT DISTINCT experiment_id FROM spans) UNION ALL
  SELECT CASE WHEN experiment_id < '3' THEN experiment_id END FROM (SELECT DISTINCT experiment_id FROM spans)),
run_keys AS (SELECT trace_id AS k FROM (SELECT DISTINCT trace_id FROM spans) UNION ALL
  SELECT CASE WHEN trace_id LIKE '%-1' THEN trace_id END FROM (SELECT DISTINCT trace_id FROM spans))"""))
def c1(spark, sf):
    """The dimensions carry faults: every row a second time, with its key or without one."""
    s = spans(spark, sf)
    exps, runs = D.experiments_from_spans(s), D.runs_from_spans(s)
    again = exps.withColumn("experiment_id", F.when(F.col("experiment_id") < "3", F.col("experiment_id")))
    rerun = runs.withColumn("run_id", F.when(F.col("run_id").like("%-1"), F.col("run_id")))
    return M.contract_audit(s, exps.unionByName(again), runs.unionByName(rerun))


def _profile_sql():
    parts = []
    for c in PROFILE_COLUMNS:
        parts.append(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, "
                     f"count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS min_value, "
                     f"CAST(max({c}) AS VARCHAR) AS max_value FROM flat")
    return "\nUNION ALL ".join(parts)


@query("c2_column_profile", with_tables(_profile_sql(), "spans", "tag_log", extra=TAG_TEXT_CTE + ",\nflat AS (" + ALL_SPANS_SQL + ")"))
def c2(spark, sf):
    return M.column_profile(flatten_maps(spans(spark, sf)), PROFILE_COLUMNS)


@query("c3_retention_tiers", with_tables(f"""
SELECT CASE WHEN timestamp < TIMESTAMP '{AS_OF_RETENTION}' - INTERVAL 7 DAY THEN 'archive' ELSE 'live' END AS tier,
 CAST(timestamp AS DATE) AS span_date, count(*) AS n_spans FROM spans GROUP BY 1, 2""", "spans"))
def c3(spark, sf):
    return (M.retention_tiers(spans(spark, sf), AS_OF_RETENTION).groupBy("tier", "span_date")
            .agg(F.count(F.lit(1)).alias("n_spans")))


@query("c4_partitioned_table", with_tables("""
SELECT CAST(timestamp AS DATE) AS span_date, trace_id, span_id, start_time_ms FROM spans
WHERE timestamp >= TIMESTAMP '2024-01-10 00:00:00'""", "spans"))
def c4_table(spark, sf):
    """Written in two appends by date, read back with a condition on the date."""
    path = scratch_dir(spark, "sinks", "c4", unique=True)
    s = spans(spark, sf)
    M.write_partitioned(s.filter("experiment_id < '2'"), path)
    M.write_partitioned(s.filter("experiment_id >= '2'"), path)
    back = spark.read.parquet(path).filter(F.col("span_date") >= F.lit("2024-01-10").cast("date"))
    return back.select("span_date", "trace_id", "span_id", "start_time_ms")


@query("c4_date_partitions", with_tables("""
SELECT CAST(timestamp AS DATE) AS span_date, count(*) AS n_spans, count(DISTINCT trace_id) AS n_traces
FROM spans GROUP BY 1""", "spans"))
def c4(spark, sf):
    return (M.with_span_date(spans(spark, sf)).groupBy("span_date")
            .agg(F.count(F.lit(1)).alias("n_spans"), F.count_distinct("trace_id").alias("n_traces")))


# ---- sketches beside the exact forms ---------------------------------------------------

SKETCH_PROBS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
SECOND_DAYS = "2024-01-16"


def _stored(spark, rows, name):
    """Sketches stored in two runs: the second run reads the later days only."""
    path = scratch_dir(spark, "sketches", name, unique=True)
    for part in ("coalesce(timestamp < TIMESTAMP_NTZ '{d} 00:00:00', true)", "timestamp >= TIMESTAMP_NTZ '{d} 00:00:00'"):
        K.write_days(rows(F.expr(part.format(d=SECOND_DAYS))), path)
    return K.read_days(spark, path)


@query("a6_sketch_percentiles", with_tables("""
SELECT span_type, count(*) AS n, true AS p50, true AS p95, true AS p99 FROM spans WHERE end_time_ms IS NOT NULL AND start_time_ms IS NOT NULL
GROUP BY span_type""", "spans"))
def a6_sketch(spark, sf):
    """Whether each estimate's rank is within the sketch's bound of the exact one."""
    s = spans(spark, sf)
    stored = _stored(spark, lambda part: K.duration_sketches(s.filter(part)), "durations")
    errors = K.rank_errors(s, K.merged_percentiles(stored, SKETCH_PROBS), SKETCH_PROBS)
    return errors.select("span_type", "n", *[(F.col(a) <= K.RANK_BOUND).alias(a) for a in SKETCH_PROBS])


@query("c2_approx_distinct", with_tables("SELECT column_name, n_rows, n_nulls, true AS within_bound FROM (" + _profile_sql() + ")",
    "spans", "tag_log", extra=TAG_TEXT_CTE + ",\nflat AS (" + ALL_SPANS_SQL + ")"))
def c2_sketch(spark, sf):
    """Whether each column's estimate is within three standard errors of the exact count."""
    s = flatten_maps(spans(spark, sf))
    stored = _stored(spark, lambda part: K.distinct_sketches(s.filter(part), PROFILE_COLUMNS), "distinct")
    exact = M.column_profile(s, PROFILE_COLUMNS).select("column_name", F.col("n_distinct").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return K.approx_distinct(stored).join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", (off <= F.col("exact") * K.HLL_BOUND + 1).alias("within_bound"))
