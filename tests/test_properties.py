"""Property tests on random small inputs: invariants of T2, E7 and E1; E5, T11
and the bucketed scans against plain definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import make_spans
from tests.invariants import check_reparented, check_versions

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@st.composite
def traces(draw):
    n = draw(st.integers(1, 12))
    spans = []
    for i in range(n):
        parent = draw(st.one_of(st.none(), st.integers(0, n))) if i else None  # may dangle (== n) or point later
        spans.append({"trace_id": draw(st.sampled_from(["a", "b"])), "span_id": f"s{i}",
                      "span_name": draw(st.sampled_from(["x", "y"])),
                      "parent_span_id": None if parent is None else f"s{parent}",
                      "start_time_ms": draw(st.integers(0, 5)), "execution_order": i})
    return spans


@SETTINGS
@given(traces())
def test_t2_invariants(spark, spec):
    from spanlake.operators.filtering import filter_spans, reparent
    got = reparent(filter_spans(make_spans(spark, spec), ["x"])).collect()
    for t in ("a", "b"):
        matched = [s for s in spec if s["trace_id"] == t and s["span_name"] == "x"]
        parents = {r.span_id: r.new_parent_span_id for r in got if r.trace_id == t}
        if matched:
            check_reparented(matched, parents)
        else:
            assert not parents


@SETTINGS
@given(st.lists(st.sampled_from(["A", "B", ""]), min_size=1, max_size=25), st.integers(1, 6))
def test_e7_invariants(spark, texts, bucket):
    from spanlake.operators.prompts import assign_prompt_versions
    rows = [(f"s{i:02d}", "p", t, i, "none") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "session_id string, project string, instructions string, snapshot_ms long, git_sha string")
    got = assign_prompt_versions(df, bucket_ms=bucket).orderBy("snapshot_ms").collect()
    check_versions(texts, [r.prompt_version for r in got])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["snap", "stop"]), st.integers(0, 30)), min_size=1, max_size=20),
       st.integers(1, 8))
def test_e5_first_stop_matches_sequential(spark, events, bucket):
    from spanlake.operators.sessions import first_stop_after_snapshot
    snaps = sorted({ts for kind, ts in events if kind == "snap"})
    stops = [(f"t{i:02d}", ts) for i, (kind, ts) in enumerate(events) if kind == "stop"]
    sdf = spark.createDataFrame([("s", ts) for ts in snaps] or [("z", 0)], "session_id string, snapshot_ms long")
    tdf = spark.createDataFrame([(t, "s", ts) for t, ts in stops] or [("tz", "z2", 0)],
                                "trace_id string, session_id string, timestamp_ms long")
    got = {(r.session_id, r.snapshot_ms): r.trace_id
           for r in first_stop_after_snapshot(tdf, sdf, bucket_ms=bucket).collect()}
    timeline = sorted([(ts, 0, "") for ts in snaps] + [(ts, 1, t) for t, ts in stops])
    want = {}
    for i, (ts, kind, _) in enumerate(timeline):
        if kind == 0:
            nxt = timeline[i + 1] if i + 1 < len(timeline) else None
            want[("s", ts)] = nxt[2] if nxt and nxt[1] == 1 else None
    if not snaps:
        want = {("z", 0): None}
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 14)), min_size=1, max_size=14))
def test_t11_matches_sequential_walk(spark, parents):
    from spanlake.operators.lineage import trace_tree
    n = len(parents)
    spec = [{"span_id": f"s{i}", "span_name": f"n{i}",
             "parent_span_id": None if p is None else f"s{p}"} for i, p in enumerate(parents)]
    got = {r.span_id: (r.depth, r.root_span_id, r.path) for r in trace_tree(make_spans(spark, spec)).collect()}
    par = {f"s{i}": (None if p is None or p >= n else f"s{p}") for i, p in enumerate(parents)}  # p >= n dangles
    want = {}
    for i in range(n):
        node, chain, seen = f"s{i}", [], set()
        while node is not None and node not in seen:
            seen.add(node)
            chain.append(node)
            node = par[node]
        if node is not None:          # hit a cycle
            want[f"s{i}"] = (None, None, None)
        else:
            want[f"s{i}"] = (len(chain) - 1, chain[-1], "/".join("n" + c[1:] for c in reversed(chain)))
    assert got == want


ENTRIES = {   # entry text: is it a call of a skip-listed skill?
    "hello": False,
    "Base directory for this skill: /a/tag-trace": True,
    "  \n Base directory for this skill: /b/feedback-trace \nx": True,
    "Base directory for this skill: /c/other": False,
    "Base directory for this skill: /d/": False,
}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.booleans(), st.sampled_from(list(ENTRIES))),
                max_size=8))
def test_e1_decides_by_the_last_user_entry(spark, entries):
    from spanlake.operators.sessions import skip_decisions
    rows = [("s", i, *e) for i, e in enumerate(entries)] + [("other", 0, "assistant", False, "x")]
    df = spark.createDataFrame(rows, "session_id string, ord long, type string, is_tool_result boolean, text string")
    got = {r.session_id: r.skipped for r in skip_decisions(df).collect()}
    typed = [text for kind, tool, text in entries if kind == "user" and not tool]
    assert got.get("s", False) == any(ENTRIES[t] for t in typed[-1:]) and got["other"] is False


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2"]), st.integers(0, 50)), min_size=1, max_size=40),
       st.integers(1, 20))
def test_bucketed_scans_equal_plain_windows(spark, rows, bucket):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from spanlake.functions.scans import bucketed_lead, bucketed_row_number
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k string, t long, i long")
    b = F.floor(F.col("t") / F.lit(bucket))
    w = Window.partitionBy("k").orderBy("t", "i")
    plain = {r.i: (r.rn, r.nt) for r in df.select("i", F.row_number().over(w).alias("rn"),
                                                  F.lead("t").over(w).alias("nt")).collect()}
    rn = {r.i: r.seq for r in bucketed_row_number(df, "k", ["t", "i"], b).collect()}
    nt = {r.i: r.next_t for r in bucketed_lead(df, "k", ["t", "i"], ["t"], b).collect()}
    assert {i: (rn[i], nt[i]) for i in rn} == plain
