"""Registered forms of the SQL family: S1, Q1-Q26, P/F/X/A checks."""

from functools import reduce

from pyspark.sql import functions as F

from spanlake.functions.exprs import duration_s
from spanlake.operators import dashboards as d
from spanlake.plans.fixture_sql import percentile_ctes, with_tables
from spanlake.plans.registry import query, spans

AS_OF_RECENT = "2024-02-05"
AS_OF_ALERT = "2024-01-31 00:00:00"
ALERT_HOURS = 24
ALERT_THRESHOLD = 10
LINEAGE_TRACE = "tr-1-0"

DUR = "CAST(end_time_ms - start_time_ms AS DOUBLE) / 1000.0"
AVG_DUR = "CAST(SUM(end_time_ms - start_time_ms) AS DOUBLE) / COUNT(end_time_ms - start_time_ms) / 1000.0"
ERRS = "CAST(SUM(CASE WHEN status = 'ERROR' THEN 1 ELSE 0 END) AS BIGINT)"
ATTR_TEXT = "concat('event_type=', attr_event_type, ',k=', attr_k, ',tokens=', attr_tokens)"
META_TEXT = "concat('trace.session=', session_id)"
TAG_LATEST_CTE = """
tag_latest AS (SELECT trace_id, key, arg_max(value, seq) AS value FROM tag_log GROUP BY trace_id, key)"""
TAG_TEXT_CTE = TAG_LATEST_CTE + """,
tag_text AS (SELECT trace_id, string_agg(key || '=' || value, ',' ORDER BY key) AS tags FROM tag_latest GROUP BY trace_id)"""
STAR = f"""s.request_id, s.trace_id, s.span_id, s.span_name, s.span_type, s.parent_span_id, s.start_time_ms,
 s.end_time_ms, s.status, {ATTR_TEXT} AS attributes, 0 AS events_count, {META_TEXT} AS request_metadata,
 s.execution_order, s.inputs, s.outputs, coalesce(t.tags, '') AS tags, s.experiment_id, s.timestamp"""


ALL_SPANS_SQL = f"SELECT {STAR} FROM spans s LEFT JOIN tag_text t ON s.trace_id = t.trace_id"


@query("s1_span_scan", with_tables(ALL_SPANS_SQL, "spans", "tag_log", extra=TAG_TEXT_CTE))
def s1_span_scan(spark, sf):
    return d.flatten_maps(spans(spark, sf))


@query("p1_duration", with_tables(f"SELECT span_id, {DUR} AS duration_seconds FROM spans", "spans"))
def p1_duration(spark, sf):
    return spans(spark, sf).select("span_id", duration_s().alias("duration_seconds"))


@query("q1_recent_traces", with_tables(f"""
SELECT request_id, trace_id, span_name, span_type, start_time_ms, end_time_ms, {DUR} AS duration_seconds,
 status, experiment_id, timestamp FROM spans
WHERE timestamp >= DATE '{AS_OF_RECENT}' - INTERVAL 30 DAYS ORDER BY start_time_ms DESC""", "spans"))
def q1(spark, sf):
    return d.q1_recent(spans(spark, sf), AS_OF_RECENT)


@query("q2_training_performance", with_tables(f"""
SELECT span_name, COUNT(*) AS execution_count, {AVG_DUR} AS avg_duration_seconds,
 MIN({DUR}) AS min_duration_seconds, MAX({DUR}) AS max_duration_seconds, {ERRS} AS error_count,
 MAX(timestamp) AS last_execution
FROM spans WHERE span_type = 'TRAINING' GROUP BY span_name""", "spans"))
def q2(spark, sf):
    return d.training_performance(spans(spark, sf))


@query("q3_error_traces", with_tables(f"""
SELECT request_id, trace_id, span_name, span_type, status, {ATTR_TEXT} AS attributes, timestamp,
 {DUR} AS duration_seconds FROM spans WHERE status = 'ERROR' ORDER BY timestamp DESC""", "spans"))
def q3(spark, sf):
    return d.flatten_maps(d.error_traces(spans(spark, sf)).orderBy(F.desc("timestamp")))


LINEAGE_SQL = """
SELECT trace_id, parent_span_id, parent_span_name, span_id, span_name, span_type, start_time_ms, end_time_ms
FROM spans LEFT JOIN
 (SELECT trace_id, span_id AS parent_span_id, span_name AS parent_span_name FROM spans) AS parents
 USING (trace_id, parent_span_id)"""


@query("q4_trace_lineage", with_tables(LINEAGE_SQL + " ORDER BY trace_id, start_time_ms", "spans"))
def q4(spark, sf):
    return d.trace_lineage(spans(spark, sf)).orderBy("trace_id", "start_time_ms")


@query("q5_recent_7d_top100", with_tables(f"""
SELECT * EXCLUDE (span_id) FROM (SELECT request_id, trace_id, span_id, span_name, span_type, start_time_ms, end_time_ms,
 {DUR} AS duration_seconds, status, experiment_id, timestamp FROM spans
 WHERE timestamp >= DATE '{AS_OF_RECENT}' - INTERVAL 30 DAYS) v
WHERE timestamp >= DATE '{AS_OF_RECENT}' - INTERVAL 7 DAYS
ORDER BY start_time_ms DESC, trace_id, span_id LIMIT 100""", "spans"))
def q5(spark, sf):
    return d.q5_recent_top(spans(spark, sf), AS_OF_RECENT)


@query("q6_training_by_count", with_tables(f"""
SELECT span_name, COUNT(*) AS execution_count, {AVG_DUR} AS avg_duration_seconds,
 MIN({DUR}) AS min_duration_seconds, MAX({DUR}) AS max_duration_seconds, {ERRS} AS error_count,
 MAX(timestamp) AS last_execution
FROM spans WHERE span_type = 'TRAINING' GROUP BY span_name ORDER BY execution_count DESC""", "spans"))
def q6(spark, sf):
    return d.q6_training_by_count(spans(spark, sf))


@query("q7_slow_operations", with_tables(f"""
SELECT span_name, {DUR} AS duration_seconds, status, timestamp FROM spans
WHERE {DUR} > 10 ORDER BY duration_seconds DESC, span_id LIMIT 50""", "spans"))
def q7(spark, sf):
    return d.q7_slow_operations(spans(spark, sf))


@query("q8_lineage_of_trace", with_tables(LINEAGE_SQL + f" WHERE trace_id = '{LINEAGE_TRACE}'", "spans"))
def q8(spark, sf):
    return d.q8_lineage_of(spans(spark, sf), LINEAGE_TRACE)


@query("q9_latest_training", with_tables(f"""
SELECT request_id, trace_id, span_name, span_type, start_time_ms, end_time_ms, status,
 {META_TEXT} AS request_metadata, {ATTR_TEXT} AS attributes FROM spans
WHERE span_type = 'TRAINING' ORDER BY start_time_ms DESC, span_id LIMIT 10""", "spans"))
def q9(spark, sf):
    return d.flatten_maps(d.q9_latest_training(spans(spark, sf)))


@query("q10_latest_spans", with_tables(f"""
SELECT request_id, trace_id, span_name, span_type, start_time_ms, end_time_ms, {DUR} AS duration_seconds,
 status, timestamp FROM spans ORDER BY start_time_ms DESC, span_id LIMIT 20""", "spans"))
def q10(spark, sf):
    return d.q10_latest_spans(spans(spark, sf))


@query("q11_training_summary", with_tables(f"""
SELECT span_name, COUNT(*) AS execution_count, {AVG_DUR} AS avg_duration_seconds,
 MAX({DUR}) AS max_duration_seconds, {ERRS} AS error_count
FROM spans WHERE span_type = 'TRAINING' GROUP BY span_name ORDER BY execution_count DESC""", "spans"))
def q11(spark, sf):
    return d.q11_training_summary(spans(spark, sf))


Q12_SQL = """SELECT trace_id FROM spans GROUP BY trace_id ORDER BY max(start_time_ms) DESC, trace_id LIMIT 1"""


@query("q12_most_recent_trace", with_tables(Q12_SQL, "spans"))
def q12(spark, sf):
    return d.q12_most_recent_trace(spans(spark, sf))


@query("q13_latest_trace_hierarchy", with_tables(f"""
SELECT span_id, span_name, span_type, parent_span_id, {DUR} AS duration_seconds, status FROM spans
WHERE trace_id = ({Q12_SQL}) ORDER BY start_time_ms""", "spans"))
def q13(spark, sf):
    return d.q13_latest_hierarchy(spans(spark, sf))


@query("q14_duration_profile", with_tables(f"""
SELECT s.span_type, COUNT(*) AS total_executions, {AVG_DUR} AS avg_duration,
 MIN({DUR}) AS min_duration, MAX({DUR}) AS max_duration,
 max(p.p50) / 1000.0 AS median_duration, max(p.p95) / 1000.0 AS p95_duration
FROM spans s LEFT JOIN pct p ON s.span_type IS NOT DISTINCT FROM p.g
GROUP BY s.span_type ORDER BY avg_duration DESC""", "spans",
    extra=percentile_ctes("spans", "span_type", "end_time_ms - start_time_ms", {"p50": 0.5, "p95": 0.95})))
def q14(spark, sf):
    return d.q14_duration_profile(spans(spark, sf))


@query("q15_latest_errors", with_tables(f"""
SELECT request_id, trace_id, span_name, span_type, status, {ATTR_TEXT} AS attributes, timestamp FROM spans
WHERE status = 'ERROR' ORDER BY timestamp DESC, span_id LIMIT 10""", "spans"))
def q15(spark, sf):
    return d.flatten_maps(d.q15_latest_errors(spans(spark, sf)))


@query("q16_select_star_newest", with_tables(f"""
SELECT {STAR} FROM spans s LEFT JOIN tag_text t ON s.trace_id = t.trace_id
ORDER BY s.start_time_ms DESC, s.span_id LIMIT 10""", "spans", "tag_log", extra=TAG_TEXT_CTE))
def q16(spark, sf):
    return d.flatten_maps(d.q16_newest(spans(spark, sf)))


@query("q17_avg_training_seconds", with_tables(f"""
SELECT span_name, {AVG_DUR} AS avg_seconds FROM spans WHERE span_type = 'TRAINING' GROUP BY span_name""", "spans"))
def q17(spark, sf):
    return d.q17_avg_training_seconds(spans(spark, sf))


@query("q18_all_errors", with_tables(f"""
SELECT {STAR} FROM spans s LEFT JOIN tag_text t ON s.trace_id = t.trace_id
WHERE s.status = 'ERROR' ORDER BY s.timestamp DESC""", "spans", "tag_log", extra=TAG_TEXT_CTE))
def q18(spark, sf):
    return d.flatten_maps(d.q18_all_errors(spans(spark, sf)))


@query("q19_error_alert", with_tables(f"""
SELECT COUNT(*) AS error_count FROM spans
WHERE status = 'ERROR' AND timestamp >= TIMESTAMP '{AS_OF_ALERT}' - INTERVAL {ALERT_HOURS} HOUR
HAVING COUNT(*) > {ALERT_THRESHOLD}""", "spans"))
def q19(spark, sf):
    return d.q19_error_alert(spans(spark, sf), AS_OF_ALERT, ALERT_HOURS, ALERT_THRESHOLD)


@query("q20_recent_training_runs", with_tables(f"""
SELECT span_name, {DUR} AS duration_seconds, status FROM spans WHERE span_type = 'TRAINING'
ORDER BY start_time_ms DESC, span_id LIMIT 10""", "spans"))
def q20(spark, sf):
    return d.q20_recent_training(spans(spark, sf))


@query("q21_avg_by_operation", with_tables(f"""
SELECT span_name, COUNT(*) AS executions, {AVG_DUR} AS avg_seconds FROM spans
GROUP BY span_name ORDER BY avg_seconds DESC""", "spans"))
def q21(spark, sf):
    return d.q21_avg_by_operation(spans(spark, sf))


@query("q22_error_rate", with_tables(f"""
SELECT span_type, COUNT(*) AS total, {ERRS} AS errors,
 CAST({ERRS} AS DOUBLE) * 100.0 / COUNT(*) AS error_rate_pct FROM spans GROUP BY span_type""", "spans"))
def q22(spark, sf):
    return d.q22_error_rate(spans(spark, sf))


@query("q23_latest_requests", with_tables(f"""
SELECT request_id, span_name, span_type, status, {DUR} AS duration_seconds FROM spans
ORDER BY start_time_ms DESC, span_id LIMIT 10""", "spans"))
def q23(spark, sf):
    return d.q23_latest_requests(spans(spark, sf))


@query("q24_training_by_avg", with_tables(f"""
SELECT span_name, {AVG_DUR} AS avg_duration_seconds, COUNT(*) AS execution_count, {ERRS} AS error_count
FROM spans WHERE span_type = 'TRAINING' GROUP BY span_name ORDER BY avg_duration_seconds DESC""", "spans"))
def q24(spark, sf):
    return d.q24_training_by_avg(spans(spark, sf))


@query("q25_failed_traces", with_tables(f"""
SELECT request_id, trace_id, span_name, status, {ATTR_TEXT} AS attributes FROM spans
WHERE status = 'ERROR' ORDER BY start_time_ms DESC""", "spans"))
def q25(spark, sf):
    return d.flatten_maps(d.q25_failed(spans(spark, sf)))


@query("q26_span_count", with_tables("SELECT COUNT(*) AS trace_count FROM spans", "spans"))
def q26(spark, sf):
    return d.q26_count(spans(spark, sf))


@query("s11_all_views", with_tables(f"""
SELECT 'recent_traces' AS view_name, count(*) AS n, count(DISTINCT trace_id) AS n_keys FROM spans WHERE timestamp >= DATE '{AS_OF_RECENT}' - INTERVAL 30 DAYS
UNION ALL SELECT 'training_performance', count(DISTINCT span_name), count(DISTINCT span_name) FROM spans WHERE span_type = 'TRAINING'
UNION ALL SELECT 'error_traces', count(*), count(DISTINCT trace_id) FROM spans WHERE status = 'ERROR'
UNION ALL SELECT 'trace_lineage', count(*), count(DISTINCT trace_id) FROM spans""", "spans"))
def s11_all(spark, sf):
    """Rows and keys of each of the four views, read through the catalog."""
    names = d.register_views(spans(spark, sf), AS_OF_RECENT, prefix="spanlake_all_")
    key = {"training_performance": "span_name"}
    parts = []
    for name in names:
        view = name.removeprefix("spanlake_all_")
        parts.append(spark.table(name).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key.get(view, "trace_id")).alias("n_keys"))
                     .select(F.lit(view).alias("view_name"), "n", "n_keys"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("s11_named_views", with_tables(LINEAGE_SQL, "spans"))
def s11(spark, sf):
    """Publish the four views, read one back through the catalog."""
    d.register_views(spans(spark, sf), AS_OF_RECENT, prefix="spanlake_")
    return spark.table("spanlake_trace_lineage")
