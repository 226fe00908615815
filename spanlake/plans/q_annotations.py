"""Registered tag / feedback queries: T8-T10, F6-F8, J7."""

from spanlake.operators import annotations as A
from spanlake.operators.lineage import trace_summary, trace_tags
from spanlake.plans.fixture_sql import with_tables
from spanlake.plans.q_dashboards import TAG_LATEST_CTE as TAG_LATEST
from spanlake.plans.registry import query, spans, table
from spanlake.schema import SESSION_KEY

@query("t8_latest_tags", with_tables("SELECT trace_id, key, value FROM tag_latest", "tag_log", extra=TAG_LATEST))
def t8(spark, sf):
    return A.latest_tag_values(table(spark, sf, "tag_log"))


@query("t9_feedback_summary", with_tables("""
SELECT trace_id, count(*) AS n_assessments,
 arg_max(value, create_ms) FILTER (WHERE name = 'quality') AS latest_quality,
 arg_max(value, create_ms) FILTER (WHERE name = 'toxic') AS latest_toxic,
 count(*) FILTER (WHERE source_type = 'HUMAN') AS n_human, 'true' AS has_feedback
FROM feedback_log GROUP BY trace_id""", "feedback_log"))
def t9(spark, sf):
    return A.feedback_summary(table(spark, sf, "feedback_log"))


T10_EXTRA = """
fb_tags AS (SELECT trace_id, create_ms AS seq, 'has_feedback' AS key, 'true' AS value FROM feedback_log
  UNION ALL SELECT trace_id, create_ms, 'feedback_' || name, value FROM feedback_log),
all_tags AS (SELECT trace_id, key, arg_max(value, seq) AS value FROM
  (SELECT trace_id, seq, key, value FROM tag_log UNION ALL SELECT * FROM fb_tags) GROUP BY trace_id, key),
tr AS (SELECT DISTINCT trace_id FROM spans),
flags AS (SELECT tr.trace_id,
  bool_or(a.key = 'has_feedback' AND a.value = 'true') AS hf,
  bool_or(a.key = 'feedback_quality' AND a.value = 'good') AS pos,
  bool_or(a.key = 'feedback_quality' AND a.value = 'poor') AS neg
  FROM tr LEFT JOIN all_tags a ON a.trace_id = tr.trace_id GROUP BY tr.trace_id)"""


@query("t10_feedback_search", with_tables("""
SELECT count(*) FILTER (WHERE hf) AS has_feedback, count(*) FILTER (WHERE pos) AS positive,
 count(*) FILTER (WHERE neg) AS negative, count(*) AS all_traces FROM flags""",
    "spans", "tag_log", "feedback_log", extra=T10_EXTRA))
def t10(spark, sf):
    s = spans(spark, sf)
    return A.feedback_search_counts(trace_summary(s, with_payload=False, with_session=False), table(spark, sf, "tag_log"), table(spark, sf, "feedback_log"))


@query("j7_trace_feedback", with_tables("""
SELECT t.trace_id, count(f.trace_id) AS n_feedback, count(f.trace_id) > 0 AS has_feedback
FROM (SELECT DISTINCT trace_id FROM spans) t LEFT JOIN feedback_log f ON f.trace_id = t.trace_id
GROUP BY t.trace_id""", "spans", "feedback_log"))
def j7(spark, sf):
    return A.traces_with_feedback(trace_summary(spans(spark, sf), with_payload=False, with_session=False), table(spark, sf, "feedback_log"))


@query("f6_tag_search", with_tables("""
SELECT DISTINCT s.trace_id FROM spans s JOIN tag_latest t ON t.trace_id = s.trace_id
WHERE t.key = 'click' AND t.value = '1'""", "spans", "tag_log", extra=TAG_LATEST))
def f6(spark, sf):
    return A.search_by_tag(trace_tags(spans(spark, sf), table(spark, sf, "tag_log")), "click", "1").select("trace_id")


@query("f7_tag_exclude", with_tables("""
SELECT DISTINCT s.trace_id FROM spans s WHERE NOT EXISTS
 (SELECT 1 FROM tag_latest t WHERE t.trace_id = s.trace_id AND t.key = 'purchase' AND t.value = '3')""",
    "spans", "tag_log", extra=TAG_LATEST))
def f7(spark, sf):
    return A.search_excluding_tag(trace_tags(spans(spark, sf), table(spark, sf, "tag_log")), "purchase", "3").select("trace_id")


@query("f8_metadata_search", with_tables("""
SELECT trace_id, span_id FROM spans WHERE session_id = 'sess-1'""", "spans"))
def f8(spark, sf):
    return A.search_by_metadata(spans(spark, sf), SESSION_KEY, "sess-1").select("trace_id", "span_id")
