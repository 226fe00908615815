"""Plan checks: pushdown, pruning, top-k, broadcast only of bounded sides,
and no whole-trace windows where an aggregate does the job."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from spanlake.sources.fixtures import load_table


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def spans(spark):
    return load_table(spark, SF001, "spans")


def test_filter_pushdown_and_column_pruning(spans):
    from spanlake.operators.dashboards import error_traces
    p = plan(error_traces(spans))
    assert "EqualTo(status,ERROR)" in p
    read = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    for col in ("tags", "events", "request_metadata", "inputs", "outputs"):
        assert col not in read


def test_recent_filter_reaches_scan(spans):
    from spanlake.operators.dashboards import recent_traces
    p = plan(recent_traces(spans, "2024-02-05"))
    assert "GreaterThanOrEqual(timestamp" in p


def test_topk_is_take_ordered(spans):
    from spanlake.operators.dashboards import q10_latest_spans, q7_slow_operations
    assert "TakeOrderedAndProject" in plan(q10_latest_spans(spans))
    assert "TakeOrderedAndProject" in plan(q7_slow_operations(spans))


def test_latest_hierarchy_broadcasts_only_the_one_row_side(spans):
    from spanlake.operators.dashboards import q13_latest_hierarchy
    p = plan(q13_latest_hierarchy(spans), "simple")
    assert p.count("BroadcastExchange") == 1
    bx = p[p.index("BroadcastExchange"):]
    assert "TakeOrderedAndProject" in bx or "Limit" in bx


def test_lineage_of_one_trace_filters_both_sides(spans):
    from spanlake.operators.dashboards import q8_lineage_of
    p = plan(q8_lineage_of(spans, "tr-1-0"))
    assert p.count("EqualTo(trace_id,tr-1-0)") >= 2


@pytest.mark.parametrize("name", ["reparent", "latest", "skip", "summary"])
def test_no_window_over_whole_trace_or_session(spark, spans, name):
    from spanlake.operators import filtering as FL, sessions as SS, lineage as L
    df = {
        "reparent": lambda: FL.reparent(FL.filter_spans(spans, ["view_0", "click_1"])),
        "latest": lambda: SS.latest_trace_per_session(SS.session_traces(spans)),
        "skip": lambda: SS.skip_decisions(load_table(spark, SF001, "transcripts")),
        "summary": lambda: L.trace_summary(spans),
    }[name]()
    assert "Window" not in plan(df, "simple")


def test_prompt_versions_window_is_bucketed(spark):
    from spanlake.operators.prompts import assign_prompt_versions
    p = plan(assign_prompt_versions(load_table(spark, SF001, "env_snapshots")), "simple")
    # the row-level window is partitioned by (project, bucket), never by project alone
    assert "hashpartitioning(project#" in p and "_b#" in p


def test_issue_examples_use_group_limit(spark, spans):
    from spanlake.operators.evaluation import issue_summary, rule_scores
    from spanlake.operators.lineage import trace_summary
    p = plan(issue_summary(rule_scores(trace_summary(spans))), "simple")
    assert "WindowGroupLimit" in p


def test_dimension_join_has_no_hint_and_no_action(spark, spans):
    from spanlake.sources.dimensions import experiments_from_spans, join_dimension
    exps = experiments_from_spans(spans).select("experiment_id", "name")
    tracker = spark.sparkContext.statusTracker()
    jobs = set(tracker.getJobIdsForGroup(None))
    joined = join_dimension(spans, exps, "experiment_id")
    assert set(tracker.getJobIdsForGroup(None)) == jobs
    assert "strategy=broadcast" not in plan(joined, "extended")


def test_exact_percentiles_need_no_value_map_and_no_single_task(spans):
    from spanlake.operators.dashboards import q14_duration_profile, q21_avg_by_operation
    from spanlake.operators.monitoring import unusual_durations
    for df in (q14_duration_profile(spans), unusual_durations(spans), q21_avg_by_operation(spans)):
        p = plan(df, "simple")
        assert "percentile(" not in p and "SinglePartition" not in p


def test_newest_spans_sort_keys_only(spans):
    from spanlake.operators.dashboards import q16_newest
    reads = [l for l in plan(q16_newest(spans)).splitlines() if l.startswith("ReadSchema")]
    assert any("inputs" not in r for r in reads)


def test_session_lookup_does_not_read_payload_columns(spans):
    from spanlake.operators.sessions import latest_trace_per_session, session_traces
    p = plan(latest_trace_per_session(session_traces(spans)))
    read = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    assert "inputs" not in read and "outputs" not in read and "tags" not in read


def test_scoring_reads_no_payload_or_metadata(spans):
    from spanlake.operators.evaluation import rule_scores
    from spanlake.operators.lineage import trace_summary
    p = plan(rule_scores(trace_summary(spans, with_payload=False, with_session=False)))
    read = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    for col in ("inputs", "outputs", "request_metadata", "attributes", "tags"):
        assert col not in read


def test_bucketed_spans_join_without_an_exchange_of_spans(spark):
    from spanlake.operators.dashboards import trace_lineage
    from spanlake.operators.filtering import filter_spans, reparent
    from spanlake.operators.lineage import trace_summary
    from spanlake.sources.fixtures import bucketed_spans
    from spanlake.sources.layouts import read_bucketed
    s = bucketed_spans(spark, SF001)
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for df in (trace_lineage(s), trace_summary(s), reparent(filter_spans(s, ["view_0", "click_1"]))):
            p = plan(df, "simple")
            assert "Bucketed: true" in p or "Bucketed: true" in plan(df)
            assert "Exchange" not in p
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert read_bucketed(spark, "/nowhere/else", 4).schema.fieldNames() == s.schema.fieldNames()


def test_condition_on_experiments_prunes_partitions(spark):
    from spanlake.plans.registry import load_all
    p = plan(load_all()["j8_pruned_experiments"][0](spark, SF001))
    assert "dynamicpruning" in p.lower()


def test_snapshot_texts_are_read_only_where_returned(spark):
    from spanlake.operators.prompts import assign_prompt_versions
    p = plan(assign_prompt_versions(load_table(spark, SF001, "env_snapshots")).select("session_id", "prompt_version"))
    assert all("instructions:" not in l and "skills_prompts" not in l for l in p.splitlines() if l.startswith("ReadSchema"))


def test_reparenting_deals_a_trace_over_shares(spark, spans):
    """No exchange of spans is by trace alone; only root rows are."""
    from spanlake.operators.filtering import filter_spans, reparent
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reparent(filter_spans(spans, ["view_0", "click_1"]))
        lines = plan(df, "simple").splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    alone = [k for k, l in enumerate(lines) if "Exchange hashpartitioning(trace_id" in l and "_salt" not in l and "span_id" not in l.split("hashpartitioning")[1]]
    for k in alone:      # below it an aggregate per share: at most SALTS rows a trace
        assert any("HashAggregate" in l or "SortAggregate" in l for l in lines[k + 1:k + 3])
    assert any("_salt" in l and "Exchange" in l for l in lines)


def test_input_tables_are_dealt_out_narrow(spark, tmp_path, monkeypatch):
    """Spans are made wide after the last shuffle; whole texts of snapshots are not shuffled."""
    import datetime as dt
    from spanlake.sources import fixtures as FX
    sf = str(tmp_path / "sf")
    docs = [(k, f"text {k}", None if k and k % 3 == 0 else "en", "s", 6) for k in (None, *range(1, 30), 29)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    (spark.createDataFrame([(k, dt.datetime(2024, 1, 1, k % 24), k % 5, "click", 1.0, '{"k": 7}') for k in range(60)],
                           "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
     .withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{sf}/events.parquet"))
    frame = type(spark.range(1))
    plans, write = [], frame.write.fget

    def noted(self):
        plans.append((self._jdf.queryExecution().executedPlan().toString(), self.columns))
        return write(self)

    monkeypatch.setattr(frame, "write", property(noted))
    snaps = spark.read.parquet(FX.materialise(spark, sf, "env_snapshots"))
    FX.materialise(spark, sf, "spans")
    monkeypatch.undo()
    texts = next(p for p, c in plans if "skills_prompts" in c)
    assert "Exchange hashpartitioning" not in texts and "Exchange rangepartitioning" not in texts and "REBALANCE" not in texts
    wide = next(p for p, c in plans if "request_metadata" in c)
    dealt = wide[wide.index("REBALANCE"):]
    assert "AS attributes" in wide[:wide.index("REBALANCE")] and "AS attributes" not in dealt
    told = {r.instructions for r in snaps.collect()}
    assert "text 1" in told and not told & {"text 3", "text 5", "text 7"} and snaps.count() == 22 + 3      # odd ids: the first text; null languages join nothing
