"""Registered lineage / tree / summary queries: J1, T6, T7, T11, T12."""

from spanlake.operators import lineage as L
from spanlake.plans.fixture_sql import with_tables
from spanlake.plans.q_dashboards import LINEAGE_SQL
from spanlake.plans.registry import query, spans, table
from spanlake.operators.dashboards import trace_lineage
from spanlake.sources.fixtures import bucketed_spans

ROOT_CTE = """
ranked AS (SELECT s.*, count(*) OVER (PARTITION BY trace_id) AS span_count,
  count(*) FILTER (WHERE status = 'ERROR') OVER (PARTITION BY trace_id) AS error_span_count,
  row_number() OVER (PARTITION BY trace_id ORDER BY parent_span_id IS NOT NULL, start_time_ms, span_id) AS rn
  FROM spans s),
summary AS (SELECT trace_id, request_id, experiment_id, span_id AS root_span_id, span_name AS root_span_name,
  start_time_ms AS timestamp_ms, end_time_ms, coalesce(status, 'OK') AS status, inputs AS request,
  outputs AS response, span_count, error_span_count, session_id FROM ranked WHERE rn = 1)"""


@query("j1_lineage_self_join", with_tables(LINEAGE_SQL, "spans"))
def j1(spark, sf):
    return trace_lineage(spans(spark, sf))


@query("j1_bucketed_lineage", with_tables(LINEAGE_SQL, "spans"))
def j1_bucketed(spark, sf):
    return trace_lineage(bucketed_spans(spark, sf))


@query("t12_bucketed_summary", with_tables("SELECT * FROM summary", "spans", extra=ROOT_CTE))
def t12_bucketed(spark, sf):
    return L.trace_summary(bucketed_spans(spark, sf))


@query("t12_trace_summary", with_tables("SELECT * FROM summary", "spans", extra=ROOT_CTE))
def t12(spark, sf):
    return L.trace_summary(spans(spark, sf))


@query("t6_list_recent_traces", with_tables("""
SELECT trace_id, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d %H:%M:%S UTC') AS timestamp, status,
 CASE WHEN length(replace(coalesce(request, ''), chr(10), ' ')) > 60
      THEN substr(replace(coalesce(request, ''), chr(10), ' '), 1, 60) || '...'
      ELSE replace(coalesce(request, ''), chr(10), ' ') END AS input_preview
FROM summary ORDER BY timestamp_ms DESC, trace_id LIMIT 10""", "spans", extra=ROOT_CTE))
def t6(spark, sf):
    return L.list_recent_traces(spans(spark, sf))


@query("t7_most_recent_session_trace", with_tables("""
SELECT trace_id FROM summary s
WHERE NOT EXISTS (SELECT 1 FROM tag_log t WHERE t.trace_id = s.trace_id AND t.key = 'cc_env.type'
                  AND t.value = 'env_snapshot')
ORDER BY timestamp_ms DESC, trace_id LIMIT 1""", "spans", "tag_log", extra=ROOT_CTE))
def t7(spark, sf):
    return L.most_recent_session_trace(spans(spark, sf), table(spark, sf, "tag_log"))


TREE_CTE = """
tops AS (SELECT c.trace_id, c.span_id, c.span_name FROM spans c
  WHERE c.parent_span_id IS NULL OR NOT EXISTS
   (SELECT 1 FROM spans p WHERE p.trace_id = c.trace_id AND p.span_id = c.parent_span_id)),
walk(trace_id, span_id, depth, root_span_id, path) AS (
  SELECT trace_id, span_id, 0, span_id, span_name FROM tops
  UNION ALL
  SELECT c.trace_id, c.span_id, w.depth + 1, w.root_span_id, w.path || '/' || c.span_name
  FROM walk w JOIN spans c ON c.trace_id = w.trace_id AND c.parent_span_id = w.span_id)"""


@query("t11_trace_tree", with_tables("""
SELECT s.trace_id, s.span_id, w.depth, w.root_span_id, w.path FROM spans s
LEFT JOIN walk w ON s.trace_id = w.trace_id AND s.span_id = w.span_id""", "spans", extra=TREE_CTE, recursive=True))
def t11(spark, sf):
    return L.trace_tree(spans(spark, sf))
