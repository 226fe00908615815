"""Registered evaluation queries: V1-V7, A10/V3, S2, S3, J8, S9."""

from pyspark.sql import functions as F

from spanlake.operators import evaluation as EV
from spanlake.operators.lineage import trace_summary, trace_tags
from spanlake.plans.fixture_sql import with_tables
from spanlake.plans.q_lineage import ROOT_CTE
from spanlake.plans.registry import query, spans, table
from spanlake.functions.exprs import map_text
from spanlake.schema import SPAN
from spanlake.sources import dimensions as D
from spanlake.sources.fixtures import derived_path


@query("v1_sample_traces", with_tables("""
SELECT trace_id FROM summary ORDER BY sha256('42|' || trace_id), trace_id LIMIT 50""", "spans", extra=ROOT_CTE))
def v1(spark, sf):
    return EV.sample_traces(trace_summary(spans(spark, sf), with_payload=False, with_session=False)).select("trace_id")


SCORES_CTE = ROOT_CTE + """,
fq AS (SELECT trace_id, arg_max(value, create_ms) AS q FROM feedback_log WHERE name = 'quality' GROUP BY trace_id),
sc AS (SELECT s.trace_id, CAST(s.end_time_ms - s.timestamp_ms AS DOUBLE) / 1000.0 AS dur, s.error_span_count,
  s.span_count, coalesce(fq.q = 'poor', false) AS neg FROM summary s LEFT JOIN fq ON fq.trace_id = s.trace_id),
scores AS (SELECT trace_id,
  CASE WHEN error_span_count > 0 THEN 'errors' WHEN neg THEN 'negative_feedback' END AS category,
  CASE WHEN error_span_count > 0 THEN error_span_count || ' of ' || span_count || ' spans failed'
       WHEN neg THEN 'latest human quality rating is poor' ELSE 'no failure signal' END AS rationale
  FROM sc)"""


def _scores(spark, sf):
    s = spans(spark, sf)
    return EV.rule_scores(trace_summary(s, with_payload=False, with_session=False), table(spark, sf, "feedback_log"))


@query("v2_rule_scores", with_tables("SELECT trace_id, category IS NULL AS passed, category, rationale FROM scores",
                                     "spans", "feedback_log", extra=SCORES_CTE))
def v2(spark, sf):
    return _scores(spark, sf)


@query("v2_pluggable_judge", with_tables("""
SELECT trace_id, error_span_count * 5 <= span_count AS passed, CASE WHEN error_span_count * 5 > span_count THEN 'many_errors' END AS category,
 error_span_count || '/' || span_count AS rationale FROM summary""", "spans", extra=ROOT_CTE))
def v2_judge(spark, sf):
    """A judge in Python over batches of trace summaries."""
    def judge(batch):
        bad = batch["error_span_count"] * 5 > batch["span_count"]
        rationale = batch["error_span_count"].astype(str) + "/" + batch["span_count"].astype(str)
        return batch.assign(passed=~bad, category=bad.map({True: "many_errors", False: None}), rationale=rationale)

    return EV.judge_traces(trace_summary(spans(spark, sf), with_payload=False, with_session=False), judge)


@query("v3_issue_summary", with_tables("""
SELECT category AS name, count(DISTINCT trace_id) AS n_traces,
 CAST(count(DISTINCT trace_id) AS DOUBLE) / (SELECT count(*) FROM scores) AS frequency,
 CAST(floor(count(DISTINCT trace_id) * 100 / (SELECT count(*) FROM scores WHERE category IS NOT NULL)) AS INT) AS confidence,
 array_to_string(list_sort(list(trace_id ORDER BY trace_id)[1:3]), ',') AS example_trace_ids,
(SELECT arg_max(rationale, (n, rationale)) FROM (SELECT rationale, count(*) AS n FROM scores s WHERE s.category = c.category GROUP BY rationale)) AS description,
coalesce((SELECT string_agg(span_name, ',' ORDER BY n DESC, span_name) FROM (SELECT span_name, count(DISTINCT p.trace_id) AS n FROM spans p JOIN scores s
 ON s.trace_id = p.trace_id WHERE p.status = 'ERROR' AND s.category = c.category GROUP BY span_name ORDER BY n DESC, span_name LIMIT 3)), '') AS root_causes
FROM scores c WHERE category IS NOT NULL GROUP BY category""", "spans", "feedback_log", extra=SCORES_CTE))
def v3(spark, sf):
    return EV.issue_summary(_scores(spark, sf), spans=spans(spark, sf))


@query("v4_evaluation_dataset", with_tables("""
SELECT t.trace_id,
 arg_max(f.value, f.create_ms) FILTER (WHERE f.name = 'quality') AS quality_label,
 arg_max(f.value, f.create_ms) FILTER (WHERE f.name = 'toxic') AS toxic_label,
 CASE WHEN CAST(('0x' || substr(sha256('42|' || t.trace_id), 1, 8)) AS BIGINT) % 1000 < 200 THEN 'test' ELSE 'train' END AS split
FROM (SELECT DISTINCT trace_id FROM spans) t JOIN feedback_log f ON f.trace_id = t.trace_id GROUP BY t.trace_id""",
    "spans", "feedback_log"))
def v4(spark, sf):
    return EV.evaluation_dataset(trace_summary(spans(spark, sf), with_payload=False, with_session=False), table(spark, sf, "feedback_log"))


@query("v5_aggregated_metrics", with_tables("""
SELECT experiment_id, count(DISTINCT trace_id) AS n_traces, count(*) AS n_spans,
 CAST(SUM(end_time_ms - start_time_ms) AS DOUBLE) / COUNT(end_time_ms - start_time_ms) / 1000.0 AS avg_span_seconds,
 CAST(sum(TRY_CAST(attr_tokens AS BIGINT)) AS BIGINT) AS total_tokens,
 count(*) FILTER (WHERE status = 'ERROR') AS error_spans
FROM spans GROUP BY experiment_id""", "spans"))
def v5(spark, sf):
    return EV.aggregated_metrics(spans(spark, sf))


@query("v6_binary_metrics", """
WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND 1 - toxic = 1) AS tp,
  count(*) FILTER (WHERE quality <> 1 AND 1 - toxic = 1) AS fp,
  count(*) FILTER (WHERE quality = 1 AND 1 - toxic <> 1) AS fn,
  count(*) FILTER (WHERE quality <> 1 AND 1 - toxic <> 1) AS tn FROM labels),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall FROM c)
SELECT tp, fp, fn, tn, CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) END AS accuracy,
 precision, recall, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1_score
FROM m""")
def v6(spark, sf):
    lb = table(spark, sf, "labels")
    return EV.binary_metrics(lb.select(F.col("quality").alias("y_true"), (1 - F.col("toxic")).alias("y_pred")))


@query("v7_train_evaluate")
def v7(spark, sf):
    emb = table(spark, sf, "embeddings").withColumn("target", (F.col("label") % 2).cast("double"))
    pred, _ = EV.train_and_evaluate(emb, label="target")
    return pred.select("vec_id", "target", "prediction")


@query("v7_test_split", """
SELECT vec_id, CAST(label % 2 AS DOUBLE) AS target,
 CASE WHEN CAST('0x' || substr(sha256('42|' || vec_id), 1, 8) AS BIGINT) % 1000 < 200 THEN 'test' ELSE 'train' END AS split
FROM embeddings""")
def v7_split(spark, sf):
    """The parts that V7 trains on and predicts."""
    emb = table(spark, sf, "embeddings")
    return emb.select("vec_id", (F.col("label") % 2).cast("double").alias("target"),
                      F.when(EV.held_out("vec_id"), "test").otherwise("train").alias("split"))


def _experiments(spark, sf):
    path = derived_path(spark, sf, "experiments", lambda: D.experiments_from_spans(spans(spark, sf)))
    return D.read_dimension(spark, path, "experiment")


def _runs(spark, sf):
    return D.read_dimension(spark, derived_path(spark, sf, "runs", lambda: D.runs_from_spans(spans(spark, sf))), "run")


@query("s2_experiments", with_tables("""
SELECT experiment_id, 'experiment-' || experiment_id AS name, '/experiments/' || experiment_id AS artifact_location,
 'active' AS lifecycle_stage, min(timestamp) AS creation_time, max(timestamp) AS last_update_time,
 'n_errors=' || count(*) FILTER (WHERE status = 'ERROR') || ',n_spans=' || count(*) AS tags
FROM spans GROUP BY experiment_id""", "spans"))
def s2(spark, sf):
    """The stored table, maps included."""
    return _experiments(spark, sf).withColumn("tags", map_text("tags"))


RUNS_SQL = """
SELECT 'run-' || s.trace_id AS run_id, s.experiment_id, s.root_span_name AS run_name,
 CASE WHEN s.error_span_count > 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
 t.start_time, t.end_time, '/experiments/' || s.experiment_id || '/' || s.trace_id AS artifact_uri,
 'active' AS lifecycle_stage, CAST(s.span_count AS DOUBLE) AS n_spans, CAST(s.error_span_count AS DOUBLE) AS n_errors,
 'event_type=' || r.attr_event_type || ',k=' || r.attr_k || ',tokens=' || r.attr_tokens AS params
FROM summary s JOIN ranked r ON r.trace_id = s.trace_id AND r.rn = 1 JOIN (SELECT trace_id, min(timestamp) AS start_time, max(timestamp) AS end_time FROM spans
 GROUP BY trace_id) t ON t.trace_id = s.trace_id"""


@query("s3_runs", with_tables(RUNS_SQL, "spans", extra=ROOT_CTE))
def s3(spark, sf):
    runs = _runs(spark, sf)
    return runs.select(*[c for c in runs.columns if c not in ("params", "metrics")], map_text("params").alias("params"),
                       F.col("metrics")["n_spans"].alias("n_spans"), F.col("metrics")["n_errors"].alias("n_errors"))


@query("j8_span_dimension_join", with_tables(f"""
SELECT sp.span_id, 'experiment-' || sp.experiment_id AS name, r.status AS run_status
FROM spans sp LEFT JOIN ({RUNS_SQL}) r ON r.run_id = 'run-' || sp.trace_id""", "spans", extra=ROOT_CTE))
def j8(spark, sf):
    s = spans(spark, sf)
    exps = _experiments(spark, sf).select("experiment_id", "name")
    runs = _runs(spark, sf).select(F.col("run_id"), F.col("status").alias("run_status"))
    j = D.join_dimension(s.select("span_id", "experiment_id", F.concat(F.lit("run-"), "trace_id").alias("run_id")),
                         exps, "experiment_id")
    return D.join_dimension(j, runs, "run_id").select("span_id", "name", "run_status")


@query("j8_pruned_experiments", with_tables("""
SELECT trace_id, span_id, 'experiment-' || experiment_id AS name FROM spans WHERE experiment_id IN
 (SELECT experiment_id FROM spans GROUP BY experiment_id HAVING count(*) FILTER (WHERE status = 'ERROR') * 100 < 8 * count(*))""", "spans"))
def j8_pruned(spark, sf):
    """Spans stored by experiment; a condition on the stored experiments picks
    the partitions that are read."""
    path = derived_path(spark, sf, "spans_by_experiment", lambda: spans(spark, sf), by="experiment_id")
    stored = spark.read.schema(SPAN).parquet(path)
    tags = F.col("tags")
    calm = _experiments(spark, sf).filter(tags["n_errors"].cast("long") * 100 < tags["n_spans"].cast("long") * 8).select("experiment_id", "name")
    return D.join_dimension(stored.select("trace_id", "span_id", "experiment_id"), calm, "experiment_id", "inner").select("trace_id", "span_id", "name")


@query("s9_store_search", with_tables("""
SELECT s.trace_id, s.timestamp_ms, s.status FROM summary s JOIN
 (SELECT trace_id, arg_max(value, seq) AS v FROM tag_log WHERE key = 'purchase' GROUP BY trace_id) t
 ON t.trace_id = s.trace_id WHERE t.v = '7' ORDER BY s.timestamp_ms DESC, s.trace_id LIMIT 10""",
    "spans", "tag_log", extra=ROOT_CTE))
def s9(spark, sf):
    from spanlake.operators.annotations import search_traces
    s = spans(spark, sf)
    t = trace_summary(s, with_payload=False, with_session=False).join(trace_tags(s), "trace_id", "left")
    return search_traces(t, F.col("tags")["purchase"] == "7", max_results=10).select("trace_id", "timestamp_ms", "status")
