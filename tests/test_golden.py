
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import make_spans


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_f7_tag_not_equal_keeps_missing_key(spark):
    from spanlake.operators.annotations import search_excluding_tag
    df = spark.createDataFrame(
        [("a", {"cc_env.type": "env_snapshot"}), ("b", {"other": "x"}), ("c", None)],
        "trace_id string, tags map<string,string>")
    assert sorted(r.trace_id for r in search_excluding_tag(df, "cc_env.type", "env_snapshot").collect()) == ["b", "c"]


def test_j2_request_order_duplicates_and_missing(spark):
    from spanlake.operators.filtering import lookup_traces, requests_frame
    spans = make_spans(spark, [{"trace_id": "a", "span_id": "x"}, {"trace_id": "b", "span_id": "y"}])
    found, missing = lookup_traces(spans, requests_frame(spark, ["a", "missing", "a"]))
    assert sorted(rows(found, "request_key", "trace_id")) == [(0, "a"), (2, "a")]
    assert rows(missing, "request_key", "trace_id") == [(1, "missing")]


def _reparent(spark, spec, names=None):
    from spanlake.operators.filtering import filter_spans, reparent
    spans = make_spans(spark, spec)
    m = filter_spans(spans, names)
    return {r.span_id: (r.new_parent_span_id, r.is_root) for r in reparent(m).collect()}


def test_t2_grandparent_matches_parent_does_not(spark):
    spec = [
        {"span_id": "g", "span_name": "keep", "start_time_ms": 1},
        {"span_id": "p", "span_name": "drop", "parent_span_id": "g", "start_time_ms": 2},
        {"span_id": "c", "span_name": "keep", "parent_span_id": "p", "start_time_ms": 3},
        {"span_id": "r0", "span_name": "keep", "start_time_ms": 0},
    ]
    out = _reparent(spark, spec, ["keep"])
    # root is the earliest match (r0); c's parent p was dropped -> root, never the grandparent g
    assert out["r0"] == (None, True)
    assert out["c"] == ("r0", False)
    assert out["g"] == ("r0", False)


def test_t2_parent_matches_but_starts_later(spark):
    spec = [
        {"span_id": "root", "start_time_ms": 0},
        {"span_id": "p", "parent_span_id": "root", "start_time_ms": 50},
        {"span_id": "c", "parent_span_id": "p", "start_time_ms": 10},
    ]
    out = _reparent(spark, spec)
    assert out["c"] == ("root", False)
    assert out["p"] == ("root", False)


def test_t2_equal_start_lower_execution_order_is_root(spark):
    spec = [
        {"span_id": "b", "start_time_ms": 5, "execution_order": 2},
        {"span_id": "a", "start_time_ms": 5, "execution_order": 1},
    ]
    out = _reparent(spark, spec)
    assert out["a"] == (None, True)
    assert out["b"] == ("a", False)


def test_t3_empty_experiment_override_uses_source(spark):
    from spanlake.operators.filtering import filter_and_create_traces, requests_frame
    spans = make_spans(spark, [{"trace_id": "a", "span_id": "x", "experiment_id": "42"}])
    new = filter_and_create_traces(spans, requests_frame(spark, ["a"]), experiment_id="")
    r = new.collect()[0]
    assert r.experiment_id == "42"
    assert r.tags == {"source_trace_id": "a", "filtered": "true"}
    assert r.parent_span_id is None and r.status == "OK"


def test_t5_job_needs_a_criterion(spark):
    from spanlake.operators.filtering import requests_frame, run_filter_job
    spans = make_spans(spark, [{"trace_id": "a"}])
    with pytest.raises(ValueError):
        run_filter_job(spans, requests_frame(spark, ["a"]))


def test_t8_last_write_wins_and_atomic_rejects(spark):
    from spanlake.operators.annotations import latest_tag_values, tag_requests_to_log
    req = spark.createDataFrame(
        [(1, "t", 1, "a=1"), (1, "t", 2, "a=2"), (1, "t", 3, "b=x=y"), (2, "t", 4, "c=1"), (2, "t", 5, "bad")],
        "batch_id int, trace_id string, seq int, pair string")
    log, bad = tag_requests_to_log(req)
    assert sorted(rows(latest_tag_values(log), "key", "value")) == [("a", "2"), ("b", "x=y")]
    assert rows(bad, "batch_id", "n_invalid", "first_invalid") == [(2, 1, "bad")]


def test_t10_feedback_round_trip(spark):
    from spanlake.operators.annotations import feedback_search_counts
    traces = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "trace_id string")
    empty_tags = spark.createDataFrame([], "trace_id string, seq long, key string, value string")
    fb = spark.createDataFrame(
        [("t1", "quality", "good", "HUMAN", "user_123", 1, None), ("t3", "quality", "poor", "HUMAN", "user_456", 2, None)],
        "trace_id string, name string, value string, source_type string, source_id string, create_ms long, rationale string")
    r = feedback_search_counts(traces, empty_tags, fb).collect()[0]
    assert (r.has_feedback, r.positive, r.negative, r.all_traces) == (2, 1, 1, 3)


def _skip(spark, entries):
    from spanlake.operators.sessions import skip_decisions
    df = spark.createDataFrame(entries, "session_id string, ord long, type string, is_tool_result boolean, text string")
    return {r.session_id: (r.skill_name, r.skipped) for r in skip_decisions(df).collect()}


def test_e1_skip_cases(spark):
    out = _skip(spark, [
        ("s1", 0, "user", False, "Base directory for this skill: /x/feedback-trace\nbody"),
        ("s2", 0, "user", False, " \t\n Base directory for this skill:   /x/tag-trace  \nbody"),
        ("s3", 0, "user", False, "Base directory for this skill: /x/tag-trace/\nbody"),
        ("s4", 0, "user", False, "Base directory for this skill: /x/tag-trace"),
        ("s4", 1, "user", True, "tool output"),
        ("s5", 0, "user", False, "Base directory for this skill: /x/tag-trace"),
        ("s5", 1, "user", False, "hello"),
        ("s6", 0, "assistant", False, "Base directory for this skill: /x/tag-trace"),
    ])
    assert out["s1"] == ("feedback-trace", True)
    assert out["s2"] == ("tag-trace", True)
    assert out["s3"] == ("", False)          # trailing slash: basename is ''
    assert out["s4"] == ("tag-trace", True)  # tool result skipped, previous user entry decides
    assert out["s5"] == (None, False)
    assert out["s6"] == (None, False)        # no user entry: never skipped


def test_s4_jsonl_reader_polymorphic_content_and_bad_lines(spark, tmp_path):
    from spanlake.operators.sessions import read_transcripts, skip_decisions
    (tmp_path / "sa.jsonl").write_text(
        '{"type": "user", "message": {"content": [{"type": "text", "text": "Base directory for this skill: /p/tag-trace"},'
        ' {"type": "image"}, "loose string", {"type": "text", "text": "more"}]}}\n\n')
    (tmp_path / "sb.jsonl").write_text(
        '{"type": "user", "message": {"content": "Base directory for this skill: /p/feedback-trace"}}\n{not json\n')
    (tmp_path / "sc.jsonl").write_text(
        '{"type": "user", "message": {"content": "Base directory for this skill: /p/tag-trace"}}\n'
        '{"type": "user", "toolUseResult": {}, "message": {"content": "x"}}\n')
    e = read_transcripts(spark, str(tmp_path))
    texts = {r.session_id: r.text for r in e.filter("session_id = 'sa'").collect()}
    assert texts["sa"] == "Base directory for this skill: /p/tag-trace\nmore"
    out = {r.session_id: r.skipped for r in skip_decisions(e).collect()}
    assert out == {"sa": True, "sb": False, "sc": False}  # sb: unparsable line; sc: {} toolUseResult is falsy


def test_e1_stop_hook_active_never_skips(spark):
    from spanlake.operators.sessions import skip_decisions
    df = spark.createDataFrame([("s", 0, "user", False, "Base directory for this skill: /a/tag-trace")],
                               "session_id string, ord long, type string, is_tool_result boolean, text string")
    stops = spark.createDataFrame([("s", True)], "session_id string, stop_hook_active boolean")
    assert skip_decisions(df, stops).collect()[0].skipped is False


def test_e3_prompt_uri_needs_name_and_version(spark):
    from spanlake.functions.exprs import prompt_uri
    df = spark.createDataFrame([("p", 2), ("p", None), ("p", 0), (None, 3)], "n string, v int")
    assert [r.u for r in df.select(prompt_uri("n", "v").alias("u")).collect()] == ["prompts:/p/2", None, None, None]


def test_e7_versions_a_a_empty_b_a(spark):
    from spanlake.operators.prompts import assign_prompt_versions
    df = spark.createDataFrame(
        [("s1", "p", "A", 1, "abcdef0123"), ("s2", "p", "A", 2, "none"), ("s3", "p", "", 3, "none"),
         ("s4", "p", "B", 4, "none"), ("s5", "p", "A", 5, "none")],
        "session_id string, project string, instructions string, snapshot_ms long, git_sha string")
    # bucket of 2 ms forces the two-level scan across several buckets
    out = {r.session_id: (r.prompt_version, r.commit_message)
           for r in assign_prompt_versions(df, bucket_ms=2).collect()}
    assert [out[f"s{i}"][0] for i in range(1, 6)] == [1, 1, None, 2, 3]
    assert out["s1"][1] == "git:abcdef01" and out["s2"][1] == "no-git"


def test_a9_ordered_digest_and_none(spark):
    import hashlib
    from spanlake.operators.prompts import skills_hash
    parts = spark.createDataFrame([("p", "beta", "B"), ("p", "alpha", "A")], "project string, key string, content string")
    groups = spark.createDataFrame([("p",), ("empty",)], "project string")
    got = {r.project: r.skills_hash for r in skills_hash(parts, groups).collect()}
    assert got["p"] == hashlib.sha256("alpha\nA\0beta\nB".encode()).hexdigest()
    assert got["empty"] == "none"


def test_x4_preview(spark):
    from spanlake.functions.exprs import preview
    vals = [None, "x" * 60, "y" * 61, "a\nb", "\U0001F600" * 61]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    out = [r.p for r in df.select(preview("t").alias("p")).collect()]
    assert out == ["", "x" * 60, "y" * 60 + "...", "a b", "\U0001F600" * 60 + "..."]


def test_x3_utc_format(spark):
    from spanlake.functions.exprs import fmt_utc
    df = spark.createDataFrame([(1704067200123,)], "ms long")
    assert df.select(fmt_utc("ms").alias("f")).collect()[0].f == "2024-01-01 00:00:00 UTC"


def test_q12_and_q13_latest_trace(spark):
    from spanlake.operators.dashboards import q12_most_recent_trace, q13_latest_hierarchy
    spans = make_spans(spark, [
        {"trace_id": "a", "span_id": "a1", "start_time_ms": 10},
        {"trace_id": "b", "span_id": "b1", "start_time_ms": 5},
        {"trace_id": "b", "span_id": "b2", "start_time_ms": 50, "parent_span_id": "b1"},
    ])
    assert q12_most_recent_trace(spans).collect()[0].trace_id == "b"
    assert [r.span_id for r in q13_latest_hierarchy(spans).collect()] == ["b1", "b2"]


def test_q19_alert_threshold(spark):
    from spanlake.operators.dashboards import q19_error_alert
    base = dt.datetime(2024, 1, 31, 0, 0)
    ten = [{"status": "ERROR", "timestamp": base - dt.timedelta(minutes=i + 1), "span_id": f"e{i}"} for i in range(10)]
    assert q19_error_alert(make_spans(spark, ten), "2024-01-31 00:00:00", 1, 10).count() == 0
    eleven = ten + [{"status": "ERROR", "timestamp": base - dt.timedelta(minutes=30), "span_id": "e10"}]
    assert q19_error_alert(make_spans(spark, eleven), "2024-01-31 00:00:00", 1, 10).collect()[0].error_count == 11


def test_p1_null_end(spark):
    from spanlake.operators.dashboards import training_performance
    spans = make_spans(spark, [
        {"span_type": "TRAINING", "span_name": "t", "start_time_ms": 0, "end_time_ms": 2000},
        {"span_type": "TRAINING", "span_name": "t", "start_time_ms": 0, "end_time_ms": None},
    ])
    r = training_performance(spans).collect()[0]
    assert r.execution_count == 2 and r.avg_duration_seconds == 2.0


def test_c1_one_violation_each(spark):
    from spanlake.operators.monitoring import contract_audit
    spans = make_spans(spark, [
        {"span_id": "a"}, {"span_id": "a"},                      # duplicate
        {"span_id": "b", "parent_span_id": "nope"},              # dangling
        {"span_id": "c", "start_time_ms": 10, "end_time_ms": 5},  # end < start
    ])
    spans = spans.unionByName(make_spans(spark, [{"span_id": "z"}]).withColumn("span_id", F.lit(None).cast("string")))
    runs = spark.createDataFrame([("r1",), ("r1",)], "run_id string")
    got = {r.check_name: r.violations for r in contract_audit(spans, runs=runs).collect()}
    assert got["duplicate_span_id"] == 1 and got["dangling_parent"] == 1
    assert got["end_before_start"] == 1 and got["null_span_id"] == 1 and got["run_pk_duplicate"] == 1


def test_t11_tree_with_dangling_and_cycle(spark):
    from spanlake.operators.lineage import trace_tree
    spans = make_spans(spark, [
        {"span_id": "r", "span_name": "root"},
        {"span_id": "a", "span_name": "a", "parent_span_id": "r"},
        {"span_id": "b", "span_name": "b", "parent_span_id": "a"},
        {"span_id": "d", "span_name": "d", "parent_span_id": "ghost"},
        {"span_id": "x", "span_name": "x", "parent_span_id": "y"},
        {"span_id": "y", "span_name": "y", "parent_span_id": "x"},
    ])
    got = {r.span_id: (r.depth, r.root_span_id, r.path) for r in trace_tree(spans).collect()}
    assert got["b"] == (2, "r", "root/a/b")
    assert got["d"] == (0, "d", "d")
    assert got["x"] == (None, None, None) and got["y"] == (None, None, None)


def test_e10_normalise(spark):
    from spanlake.operators.prompts import normalise_snapshot
    df = spark.createDataFrame([("abc\n", " M f\n"), ("abc\n", "\n"), (None, None)], "head string, porcelain string")
    assert [(r.git_sha, r.git_dirty) for r in normalise_snapshot(df).collect()] == [
        ("abc", "true"), ("abc", "false"), ("none", "none")]


def test_v6_zero_division(spark):
    from spanlake.operators.evaluation import binary_metrics
    df = spark.createDataFrame([(0, 0), (0, 0)], "y_true int, y_pred int")
    r = binary_metrics(df).collect()[0]
    assert (r.accuracy, r.precision, r.recall, r.f1_score) == (1.0, 0.0, 0.0, 0.0)


def test_v2_pluggable_judge_runs_in_pandas(spark):
    import pandas as pd
    from spanlake.operators.evaluation import issue_summary, judge_traces
    summary = spark.createDataFrame([("t1", 3, 0), ("t2", 5, 2), ("t3", 1, 1)],
                                    "trace_id string, span_count long, error_span_count long")

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        failed = pdf["error_span_count"] > 0
        return pd.DataFrame({"trace_id": pdf["trace_id"], "passed": ~failed,
                             "category": failed.map({True: "errors", False: None}),
                             "rationale": pdf["error_span_count"].astype(str) + " errors"})

    scores = judge_traces(summary, judge)
    assert sorted((r.trace_id, r.passed) for r in scores.collect()) == [("t1", True), ("t2", False), ("t3", False)]
    issue = issue_summary(scores).collect()[0]
    assert (issue.name, issue.n_traces, issue.confidence, issue.example_trace_ids) == ("errors", 2, 100, "t2,t3")
    assert abs(issue.frequency - 2 / 3) < 1e-12


def test_e2_first_stop_gets_the_snapshot(spark):
    from spanlake.operators.sessions import companion_traces, enrich_traces, enrichment_tag_rows
    t0 = 1704067200000
    traces = spark.createDataFrame(
        [("t0", "s", t0 - 9), ("t1", "s", t0 + 400), ("t2", "s", t0 + 800), ("t3", None, t0 + 900), ("t4", "u", t0),
         ("k1", "k", t0 + 10), ("k2", "k", t0 + 20)], "trace_id string, session_id string, timestamp_ms long")
    snaps = spark.createDataFrame(
        [("s", "abc", "true", "h", None, t0, "p", 3),            # used by t1, not by the later t2
         ("s", "end", "true", "h", None, t0 + 900, "p", 3),      # after every Stop
         ("k", "old", "false", "h", "k", t0, None, None),        # replaced before a Stop
         ("k", "new", "false", "h", "k", t0 + 5, None, None),    # k1's Stop is skipped: k2 uses it
         ("x", "d", "false", "h", "k", t0, None, None)],         # no trace
        "session_id string, git_sha string, git_dirty string, claude_md_hash string, skills_hash string, "
        "snapshot_ms long, prompt_name string, prompt_version int")
    skipped = spark.createDataFrame([("k1",)], "trace_id string")
    enriched, unmatched = enrich_traces(traces, snaps, skipped)
    assert sorted(r.git_sha for r in unmatched.collect()) == ["d", "end", "old"]
    tags = {(r.trace_id, r.key): r.value for r in enrichment_tag_rows(enriched).collect()}
    assert {t for t, _ in tags} == {"t1", "k2"}
    assert tags["t1", "cc_env.git_sha"] == "abc" and tags["t1", "cc_env.skills_hash"] == "none"
    assert tags["t1", "cc_env.snapshot_timestamp"] == "2024-01-01T00:00:00+00:00"
    assert tags["t1", "cc_env.prompt_uri"] == "prompts:/p/3" and tags["k2", "cc_env.git_sha"] == "new"
    comp = companion_traces(enriched).collect()
    assert len(comp) == 1 and comp[0].session_trace_id == "t1" and comp[0].companion_trace_id.startswith("tr-env-")


def test_t8_default_target_is_latest_session_trace(spark):
    from spanlake.operators.annotations import latest_tag_values, tag_requests_to_log
    from spanlake.operators.lineage import most_recent_session_trace
    spans = make_spans(spark, [
        {"trace_id": "old", "span_id": "a", "start_time_ms": 1},
        {"trace_id": "new", "span_id": "b", "start_time_ms": 5},
        {"trace_id": "comp", "span_id": "c", "start_time_ms": 9, "tags": {"cc_env.type": "env_snapshot"}},
    ])
    req = spark.createDataFrame([(1, None, 1, "k=v"), (1, "old", 2, "x=y")], "batch_id int, trace_id string, seq int, pair string")
    log, _ = tag_requests_to_log(req, most_recent_session_trace(spans))
    assert sorted(rows(latest_tag_values(log), "trace_id", "key", "value")) == [("new", "k", "v"), ("old", "x", "y")]


def test_t9_feedback_append_default_target_and_tags(spark):
    from spanlake.operators.annotations import feedback_tags, latest_tag_values, log_feedback
    log = spark.createDataFrame([("t1", "quality", "good", "HUMAN", "u", 1, None)],
                                "trace_id string, name string, value string, source_type string, source_id string, "
                                "create_ms long, rationale string")
    new = spark.createDataFrame([(None, "quality", "poor", "u2", 2, "slow")],
                                "trace_id string, name string, value string, source_id string, create_ms long, rationale string")
    target = spark.createDataFrame([("t2",)], "trace_id string")
    out = log_feedback(log, new, target)
    assert sorted(rows(out, "trace_id", "value", "source_type")) == [("t1", "good", "HUMAN"), ("t2", "poor", "HUMAN")]
    tags = {(r.trace_id, r.key): r.value for r in latest_tag_values(feedback_tags(out)).collect()}
    assert tags[("t2", "has_feedback")] == "true" and tags[("t2", "feedback_quality")] == "poor"


def test_v2_idle_time_is_not_a_failure_by_default(spark):
    from spanlake.operators.evaluation import rule_scores
    summary = spark.createDataFrame([("t", 0, 3_600_000, 2, 0)],
                                    "trace_id string, timestamp_ms long, end_time_ms long, span_count long, error_span_count long")
    assert rule_scores(summary).collect()[0].passed is True
    r = rule_scores(summary, max_seconds=60).collect()[0]
    assert (r.passed, r.category, r.rationale) == (False, "slow", "root span took 3600.000 s")


def test_e5_first_stop_after_snapshot_supersede_and_buckets(spark):
    from spanlake.operators.sessions import first_stop_after_snapshot
    traces = spark.createDataFrame(
        [("t0", "s", 5), ("t1", "s", 20), ("t2", "s", 35), ("t3", "s", 90), ("u1", "u", 1)],
        "trace_id string, session_id string, timestamp_ms long")
    snaps = spark.createDataFrame([("s", 10), ("s", 30), ("s", 31), ("s", 100), ("u", 1)],
                                  "session_id string, snapshot_ms long")
    for bucket in (7, 1000):  # many buckets and one bucket give the same answer
        got = {(r.session_id, r.snapshot_ms): r.trace_id
               for r in first_stop_after_snapshot(traces, snaps, bucket_ms=bucket).collect()}
        assert got == {("s", 10): "t1", ("s", 30): None, ("s", 31): "t2", ("s", 100): None, ("u", 1): "u1"}


def test_tag_log_lies_over_stored_tags(spark):
    from spanlake.operators.lineage import most_recent_session_trace, trace_tags
    spans = make_spans(spark, [
        {"trace_id": "a", "span_id": "1", "start_time_ms": 1},
        {"trace_id": "a", "span_id": "2", "start_time_ms": 2, "tags": {"k": "stored", "m": "kept"}},
        {"trace_id": "a", "span_id": "3", "start_time_ms": 3, "tags": {"k": "later span"}},
        {"trace_id": "b", "span_id": "4", "start_time_ms": 9},
    ])
    log = spark.createDataFrame([("a", 1, "k", "first"), ("a", 2, "k", "last"), ("b", 1, "cc_env.type", "env_snapshot"),
                                 ("gone", 1, "k", "v")], "trace_id string, seq long, key string, value string")
    assert dict(rows(trace_tags(spans), "trace_id", "tags")) == {"a": {"k": "stored", "m": "kept"}, "b": {}}
    assert dict(rows(trace_tags(spans, log), "trace_id", "tags")) == {
        "a": {"k": "last", "m": "kept"}, "b": {"cc_env.type": "env_snapshot"}}
    assert rows(most_recent_session_trace(spans), "trace_id") == [("b",)]
    assert rows(most_recent_session_trace(spans, log), "trace_id") == [("a",)]


def test_exact_percentiles_equal_the_builtin(spark):
    from pyspark.sql import functions as F
    from spanlake.functions.scans import grouped_percentiles
    data = [("a", v) for v in (-7, 0, 0, 3, 10_000, 10_000, 123_456_789)] + [("b", 5), (None, 1), (None, 4), ("c", None)]
    df = spark.createDataFrame(data, "g string, v long")
    want = df.filter("v is not null").groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("p50"), F.percentile("v", F.lit(0.95)).alias("p95"))
    got = grouped_percentiles(df, "g", "v", {"p50": 0.5, "p95": 0.95})
    key = lambda r: str(r)
    assert sorted(rows(got, "g", "p50", "p95"), key=key) == sorted(rows(want, "g", "p50", "p95"), key=key)
