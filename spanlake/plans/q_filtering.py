"""Registered trace-filter queries: F5, J2, J3, T1-T3, X5."""

from pyspark.sql import functions as F

from spanlake.functions.exprs import map_text
from spanlake.operators import filtering as FL
from spanlake.plans.fixture_sql import with_tables
from spanlake.plans.q_dashboards import ATTR_TEXT
from spanlake.plans.registry import query, spans, table
from spanlake.session import scratch_dir
from spanlake.sources.spans import read_spans

# Fixed filter criteria of the registered checks.
F5_NAMES = ["purchase_0", "purchase_1", "purchase_2", "view_0"]
F5_ATTRS = {"event_type": "purchase"}
T1_NAMES = [f"{e}_{k}" for e in ("view", "signup", "error", "click", "purchase") for k in (0, 1)]
T1_FP = FL.criteria_fingerprint(T1_NAMES, None)
_in = lambda names: ", ".join(f"'{n}'" for n in names)


@query("f5_span_filter", with_tables(f"""
SELECT trace_id, span_id, span_name FROM spans
WHERE span_name IN ({_in(F5_NAMES)}) AND attr_event_type = 'purchase'""", "spans"))
def f5(spark, sf):
    return FL.filter_spans(spans(spark, sf), F5_NAMES, F5_ATTRS).select("trace_id", "span_id", "span_name")


def _feedback_requests(spark, sf):
    return table(spark, sf, "feedback_log").select(F.col("create_ms").alias("request_key"), "trace_id")


@query("j2_trace_lookup", with_tables("""
SELECT f.create_ms AS request_key, f.trace_id, s.span_id FROM feedback_log f JOIN spans s ON s.trace_id = f.trace_id""",
    "spans", "feedback_log"))
def j2(spark, sf):
    found, _ = FL.lookup_traces(spans(spark, sf), _feedback_requests(spark, sf))
    return found.select("request_key", "trace_id", "span_id")


@query("j2_missing_requests", with_tables("""
SELECT request_key, trace_id FROM (SELECT create_ms AS request_key, trace_id FROM feedback_log
 UNION ALL SELECT create_ms, trace_id || '-gone' FROM feedback_log WHERE create_ms % 3 = 0) f
WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.trace_id = f.trace_id)""", "spans", "feedback_log"))
def j2_missing(spark, sf):
    """Every third request also asks for a trace that is not there."""
    asked = _feedback_requests(spark, sf).select("request_key", "trace_id")
    gone = asked.filter("request_key % 3 = 0").withColumn("trace_id", F.concat("trace_id", F.lit("-gone")))
    _, missing = FL.lookup_traces(spans(spark, sf), asked.unionByName(gone))
    return missing.select("request_key", "trace_id")


MATCHED_CTE = f"""
m AS (SELECT trace_id, span_id, parent_span_id, start_time_ms, coalesce(execution_order, 2147483647) AS eo,
  span_name, span_type, end_time_ms, status, attr_k, attr_event_type, attr_tokens, experiment_id
  FROM spans WHERE span_name IN ({_in(T1_NAMES)})),
root AS (SELECT trace_id, span_id AS root_span_id FROM
  (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY start_time_ms, eo, span_id) AS rn FROM m) WHERE rn = 1),
rp AS (SELECT c.*, root.root_span_id, c.span_id = root.root_span_id AS is_root,
  CASE WHEN c.span_id = root.root_span_id THEN NULL
       WHEN p.span_id IS NOT NULL AND (p.start_time_ms < c.start_time_ms OR (p.start_time_ms = c.start_time_ms
            AND (p.eo < c.eo OR (p.eo = c.eo AND p.span_id < c.span_id)))) THEN c.parent_span_id
       ELSE root.root_span_id END AS new_parent_span_id
  FROM m c JOIN root ON c.trace_id = root.trace_id
  LEFT JOIN m p ON p.trace_id = c.trace_id AND p.span_id = c.parent_span_id)"""


@query("j3_parent_in_matched", with_tables(f"""
SELECT c.trace_id, c.span_id, p.span_id IS NOT NULL AS parent_matched FROM m c
LEFT JOIN m p ON p.trace_id = c.trace_id AND p.span_id = c.parent_span_id""", "spans", extra=MATCHED_CTE))
def j3(spark, sf):
    m = FL.filter_spans(spans(spark, sf), T1_NAMES)
    return FL.parent_in_matched(m).select("trace_id", "span_id", F.col("p_key").isNotNull().alias("parent_matched"))


@query("t2_reparent", with_tables("SELECT trace_id, span_id, new_parent_span_id, is_root, root_span_id FROM rp",
                                  "spans", extra=MATCHED_CTE))
def t2(spark, sf):
    m = FL.filter_spans(spans(spark, sf), T1_NAMES)
    return FL.reparent(m).select("trace_id", "span_id", "new_parent_span_id", "is_root", "root_span_id")


NEW_IDS = f"""
ids AS (SELECT rp.*, 'tr-f-' || substr(sha256(concat_ws('|', trace_id, trace_id, '{T1_FP}')), 1, 32) AS new_trace_id FROM rp)"""


@query("t1_filter_and_create", with_tables(f"""
SELECT trace_id AS source_trace_id, span_id AS source_span_id, new_trace_id AS trace_id,
 'sp-f-' || substr(sha256(concat_ws('|', new_trace_id, span_id)), 1, 16) AS span_id,
 CASE WHEN new_parent_span_id IS NOT NULL THEN 'sp-f-' || substr(sha256(concat_ws('|', new_trace_id, new_parent_span_id)), 1, 16) END AS parent_span_id,
 span_name, span_type, start_time_ms, end_time_ms, coalesce(status, 'OK') AS status, experiment_id, is_root,
 {ATTR_TEXT} AS attributes, 'filtered=true,source_trace_id=' || trace_id AS tags
FROM ids""", "spans", extra=MATCHED_CTE + "," + NEW_IDS))
def t1(spark, sf):
    s = spans(spark, sf)
    requests = s.select(F.col("trace_id").alias("request_key"), "trace_id").distinct()
    new = FL.filter_and_create_traces(s, requests, T1_NAMES)
    return new.select("source_trace_id", "source_span_id", "trace_id", "span_id", "parent_span_id",
                      "span_name", "span_type", "start_time_ms", "end_time_ms", "status", "experiment_id",
                      "is_root", map_text("attributes").alias("attributes"), map_text("tags").alias("tags"))


@query("s8_filtered_trace_table", with_tables("""
SELECT 'new' AS kind, new_trace_id AS trace_id, experiment_id, span_name, start_time_ms FROM ids
UNION ALL SELECT 'old', trace_id, experiment_id, span_name, start_time_ms FROM spans WHERE experiment_id IN ('1', '3')""",
    "spans", extra=MATCHED_CTE + "," + NEW_IDS))
def s8(spark, sf):
    """The filtered traces appended to a span table that holds some spans, read back."""
    path = scratch_dir(spark, "sinks", "s8", unique=True)
    s = spans(spark, sf)
    FL.write_filtered_traces(s.filter(F.col("experiment_id").isin("1", "3")), path)
    requests = s.select(F.col("trace_id").alias("request_key"), "trace_id").distinct()
    FL.write_filtered_traces(FL.filter_and_create_traces(s, requests, T1_NAMES), path)
    new = F.col("tags")["filtered"] == "true"
    return read_spans(spark, path).select(F.when(new, "new").otherwise("old").alias("kind"), "trace_id", "experiment_id", "span_name", "start_time_ms")


@query("t3_new_trace_identity", with_tables("""
SELECT trace_id AS request_key, trace_id AS source_trace_id, new_trace_id AS trace_id, experiment_id,
 count(*) AS span_count FROM ids GROUP BY ALL""", "spans", extra=MATCHED_CTE + "," + NEW_IDS))
def t3(spark, sf):
    s = spans(spark, sf)
    requests = s.select(F.col("trace_id").alias("request_key"), "trace_id").distinct()
    return FL.created_traces(FL.filter_and_create_traces(s, requests, T1_NAMES, experiment_id=""))


@query("x5_split_pairs", with_tables("""
SELECT trace_id, seq, key, value FROM (
 SELECT trace_id, seq, key || '=' || value AS pair FROM tag_log) x,
 LATERAL (SELECT split_part(pair, '=', 1) AS key, substr(pair, strpos(pair, '=') + 1) AS value)""", "tag_log"))
def x5(spark, sf):
    pairs = table(spark, sf, "tag_log").select("trace_id", "seq", F.concat("key", F.lit("="), "value").alias("pair"))
    ok, _bad = FL.split_pairs(pairs)
    return ok.select("trace_id", "seq", "key", "value")
