"""T2, E1 and E7 on the sf0.01 fixture: invariants, hand-written tables, and the
fixture counts of FIXTURES.md §2."""

from itertools import groupby

from tests.conftest import SF01
from tests.invariants import check_reparented, check_versions, order_key
from spanlake.sources.fixtures import load_table


def test_t2_invariants_on_the_fixture(spark):
    from spanlake.operators.filtering import filter_spans, reparent
    from spanlake.plans.q_filtering import T1_NAMES
    m = filter_spans(load_table(spark, SF01, "spans"), T1_NAMES)
    parents = {(r.trace_id, r.span_id): r.new_parent_span_id for r in reparent(m).collect()}
    rows = [r.asDict() for r in m.select("trace_id", "span_id", "parent_span_id", "start_time_ms", "execution_order")
            .orderBy("trace_id").collect()]
    inverted = 0
    for trace, group in groupby(rows, key=lambda r: r["trace_id"]):
        matched = list(group)
        by_id = {s["span_id"]: s for s in matched}
        check_reparented(matched, {i: parents[trace, i] for i in by_id})
        inverted += sum(order_key(by_id[s["parent_span_id"]]) > order_key(s) for s in matched if s["parent_span_id"] in by_id)
    assert len(rows) == len(parents)
    assert inverted > 0          # the fixture plants matched parents that start after their child


def test_e1_table_and_fixture_counts(spark):
    from spanlake.operators.sessions import skip_decisions
    got = skip_decisions(load_table(spark, SF01, "transcripts"))
    assert got.filter("skipped").count() == 41 and got.count() == 100
    call = "Base directory for this skill: "
    user = lambda text: ("user", False, text)
    cases = {   # session: (entries, skipped)
        "plain": ([user("hello")], False),
        "listed": ([user("hello"), user(call + "/a/tag-trace")], True),
        "other skill": ([user(call + "/a/other")], False),
        "asked on": ([user(call + "/a/tag-trace"), user("and then?")], False),
        "answered": ([user(call + "/a/tag-trace"), ("assistant", False, "done")], True),
        "tool result": ([user(call + "/a/feedback-trace\nmore"), ("user", True, "out")], True),
        "folder": ([user(call + "/a/tag-trace/")], False),
        "no entry": ([("assistant", False, call + "/a/tag-trace")], False),
        "nbsp": ([user("\u00a0" + call + "/a/tag-trace\u3000")], True),
        "ideographic space": ([user("\u3000\n" + call + "/a/tag-trace")], True),
        "file separator": ([user("\x1c" + call + "/a/tag-trace\x1f")], True),
        "zero width": ([user("\u200b" + call + "/a/tag-trace")], False),
    }
    rows = [(s, i, *e) for s, (entries, _) in cases.items() for i, e in enumerate(entries)]
    df = spark.createDataFrame(rows, "session_id string, ord long, type string, is_tool_result boolean, text string")
    assert {r.session_id: r.skipped for r in skip_decisions(df).collect()} == {s: want for s, (_, want) in cases.items()}


def test_e7_invariants_on_the_fixture(spark):
    from spanlake.operators.prompts import assign_prompt_versions
    env = load_table(spark, SF01, "env_snapshots")
    rows = assign_prompt_versions(env).orderBy("project", "snapshot_ms", "session_id").collect()
    for _, group in groupby(rows, key=lambda r: r.project):
        group = list(group)
        check_versions([r.instructions for r in group], [r.prompt_version for r in group])
    versioned = [r.prompt_version for r in rows if r.prompt_version is not None]
    assert len(versioned) == 1055 and max(versioned) == 47


def test_fixture_sizes(spark):
    s = load_table(spark, SF01, "spans")
    assert s.count() == 10000
    assert s.select("trace_id").distinct().count() == 749
    assert load_table(spark, SF01, "env_snapshots").count() == 1143
