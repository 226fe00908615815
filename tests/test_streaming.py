"""Streams: runs over several batches, with late and re-delivered rows, give the
batch answer; read failures are raised."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spanlake.schema import SESSION_KEY as ST_KEY
from tests.conftest import make_spans


def _errors(spark, day, hours, prefix):
    return make_spans(spark, [
        {"span_id": f"{prefix}{i}", "status": "ERROR", "timestamp": dt.datetime(2024, 1, day, h, 5)}
        for i, h in enumerate(hours)])


def test_st1_counts_errors_however_late(spark, tmp_path):
    from spanlake.streaming import streams as ST
    src, work = str(tmp_path / "src"), str(tmp_path / "work")
    _errors(spark, 2, [0, 0, 1], "a").write.mode("append").parquet(src)
    ST.error_alerts(spark, src, work)
    _errors(spark, 2, [1, 2], "b").write.mode("append").parquet(src)          # same and newer windows
    _errors(spark, 1, [3], "late").write.mode("append").parquet(src)          # a day late
    got = {(r.window_start.day, r.window_start.hour): (r.error_count, r.alert)
           for r in ST.error_alerts(spark, src, work, threshold=1, max_files=1).collect()}
    assert got == {(2, 0): (2, True), (2, 1): (2, True), (2, 2): (1, False), (1, 3): (1, False)}


def test_a_corrupt_sink_raises(spark, tmp_path):
    from spanlake.streaming import streams as ST
    assert ST.read_sink(spark, str(tmp_path / "none"), "k string").count() == 0
    (tmp_path / "out" / "batch_id=0").mkdir(parents=True)
    (tmp_path / "out" / "batch_id=0" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        ST.read_sink(spark, str(tmp_path / "out"), "k string").collect()


def test_st3_keeps_late_spans_and_drops_repeats(spark, tmp_path):
    from spanlake.streaming import streams as ST
    src, table, work = (str(tmp_path / d) for d in ("src", "table", "work"))
    a = _errors(spark, 20, [0, 1], "x")
    deliveries = [a, a, _errors(spark, 1, [5], "late"), a.unionByName(_errors(spark, 20, [7], "new")),
                  make_spans(spark, [{"span_id": "undated"}]).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))]
    for d in deliveries * 2:
        d.write.mode("append").parquet(src)
        stored = ST.ingest_spans(spark, src, table, work, max_files=1)
    got = sorted(r.span_id for r in stored.collect())
    assert got == ["late0", "new0", "undated", "x0", "x1"]


def _session_log(spark, tmp_path):
    at = {"t0": 10, "t1": 500_000, "t2": 900_000, "t3": 90 * 86_400_000}
    make_spans(spark, [{"trace_id": t, "span_id": "r", "start_time_ms": ms, "request_metadata": {ST_KEY: "s"}}
                       for t, ms in at.items()]).repartition(3).write.parquet(str(tmp_path / "spans"))
    snaps = [("s", 100_000), ("s", 300_000), ("s", 950_000), ("idle", 1), ("s", 91 * 86_400_000)]
    spark.createDataFrame(snaps, "session_id string, snapshot_ms long").write.parquet(str(tmp_path / "snaps"))
    return str(tmp_path / "spans"), str(tmp_path / "snaps"), str(tmp_path / "w")


@pytest.mark.parametrize("max_files", [None, 1])
def test_st2_pending_snapshot_of_each_stop(spark, tmp_path, max_files):
    from spanlake.streaming import streams as ST
    m = ST.session_snapshot_join(spark, *_session_log(spark, tmp_path), max_files)
    assert {(r.trace_id, r.snapshot_ms) for r in m.collect()} == {("t1", 300_000), ("t2", 300_000), ("t3", 950_000)}


def test_st2_consumes_once_and_never_a_replaced_snapshot(spark, tmp_path):
    from spanlake.streaming import streams as ST
    m = ST.consumed_snapshots(spark, *_session_log(spark, tmp_path), max_files=1)
    assert {(r.snapshot_ms, r.trace_id) for r in m.collect()} == {(300_000, "t1"), (950_000, "t3")}


def test_st3_tag_upserts_last_write_wins_across_batches(spark, tmp_path):
    from spanlake.streaming import streams as ST
    src, work = str(tmp_path / "log"), str(tmp_path / "w")
    sch = "trace_id string, seq long, key string, value string"
    spark.createDataFrame([("t", 1, "a", "1"), ("t", 2, "b", "x")], sch).write.mode("append").parquet(src)
    ST.tag_upserts(spark, src, work)
    spark.createDataFrame([("t", 3, "a", "2"), ("t", 0, "b", "old")], sch).write.mode("append").parquet(src)
    got = {(r.key, r.value) for r in ST.tag_upserts(spark, src, work).collect()}
    assert got == {("a", "2"), ("b", "x")}


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4], [4, 2, 0, 3, 1]])
def test_st2_state_over_batches_in_any_order(spark, tmp_path, order):
    """Snapshots replaced before a Stop, Stops and snapshots that come late, and
    every file twice: after every batch the state gives the batch answer of
    what has come so far."""
    from spanlake.operators.sessions import first_stop_after_snapshot, snapshot_at_stop
    from spanlake.streaming import streams as ST
    day = 86_400_000
    files = [([5, 10 * day + 3], [("a", 20), ("b", 12 * day)]), ([7], [("c", 6), ("d", 30)]), ([20], [("e", 10 * day + 3)]),
             ([11 * day, 25], [("f", 11 * day - 1)]), ([40 * day], [("g", 39 * day), ("h", 60 * day)])]
    spans, snaps, work = (str(tmp_path / d) for d in ("spans", "snaps", "work"))
    for n, k in enumerate([*order, *order]):
        at, stops = files[k]
        spark.createDataFrame([(s, t) for t in at for s in ("s", "other")], "session_id string, snapshot_ms long").coalesce(1).write.mode("append").parquet(snaps)
        make_spans(spark, [{"trace_id": t, "span_id": "r", "start_time_ms": ms, "request_metadata": {ST_KEY: "s"}} for t, ms in stops]).coalesce(1).write.mode("append").parquet(spans)
        if n not in (2, 9):
            continue
        come = [files[j] for j in {*order[:n + 1]}]
        traces = spark.createDataFrame([("s", t, ms) for _, ts in come for t, ms in ts], "session_id string, trace_id string, timestamp_ms long")
        shots = spark.createDataFrame([(s, t) for ats, _ in come for t in ats for s in ("s", "other")], "session_id string, snapshot_ms long")
        got = {tuple(r) for r in ST.consumed_snapshots(spark, spans, snaps, work, max_files=1).collect()}
        want = first_stop_after_snapshot(traces, shots).filter("trace_id IS NOT NULL")
        assert got == {(r.session_id, r.snapshot_ms, r.trace_id, r.trace_start_ms) for r in want.collect()} and len(got) > 1
        pending = {(r.trace_id, r.snapshot_ms) for r in ST.session_snapshot_join(spark, spans, snaps, work, max_files=1).collect()}
        assert pending == {(r.trace_id, r.snapshot_ms) for r in snapshot_at_stop(traces, shots).collect()}


def test_st2_needs_no_python_per_session_and_day(spark, tmp_path, monkeypatch):
    """Many sessions and days at once: native state, the batch answer."""
    from pyspark.sql import GroupedData
    from spanlake.operators.sessions import first_stop_after_snapshot, snapshot_at_stop
    from spanlake.streaming import streams as ST

    def refuse(*_, **__):
        raise AssertionError("a Python call per key")

    monkeypatch.setattr(GroupedData, "applyInPandasWithState", refuse)
    n, half_day = 3000, 43_200_000
    ids = spark.range(n).selectExpr("concat('s', id % 500) AS session_id", "id")
    shots = ids.select("session_id", (F.col("id") * half_day % (40 * half_day)).alias("snapshot_ms"))
    stops = ids.select("session_id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("trace_id"),
                       (F.col("id") * 7 * half_day % (40 * half_day) + F.col("id") % 2).alias("timestamp_ms"))
    spans, snaps, work = (str(tmp_path / d) for d in ("spans", "snaps", "work"))
    shots.write.parquet(snaps)
    empty = make_spans(spark, [{"span_id": "r"}])
    (stops.crossJoin(empty.drop("trace_id", "start_time_ms", "request_metadata"))
     .withColumn("request_metadata", F.create_map(F.lit(ST_KEY), F.col("session_id"))).withColumnRenamed("timestamp_ms", "start_time_ms")
     .select(*empty.columns).write.parquet(spans))
    got = {tuple(r) for r in ST.consumed_snapshots(spark, spans, snaps, work).collect()}
    want = first_stop_after_snapshot(stops, shots.distinct()).filter("trace_id IS NOT NULL")
    assert got == {(r.session_id, r.snapshot_ms, r.trace_id, r.trace_start_ms) for r in want.collect()} and len(got) > 500
    pending = {tuple(r) for r in ST.session_snapshot_join(spark, spans, snaps, work).collect()}
    assert pending == {(r.session_id, r.trace_id, r.snapshot_ms, r.trace_start_ms) for r in snapshot_at_stop(stops, shots).collect()}


def test_st3_reads_the_table_a_few_times_for_many_batches(spark, tmp_path, monkeypatch):
    from spanlake.sources.span_table import SpanTable
    from spanlake.streaming import streams as ST
    src, table, work = (str(tmp_path / d) for d in ("src", "table", "work"))
    _errors(spark, 3, range(20), "a").repartition(1).write.parquet(src)
    ST.ingest_spans(spark, src, table, work)
    for k in range(9):                                                        # repeats, and one new span each
        (_errors(spark, 3, range(20), "a").filter(F.col("span_id") == f"a{k}").unionByName(_errors(spark, 3, [k], f"new{k}-"))
         .coalesce(1).write.mode("append").parquet(src))
    reads, read = [], SpanTable.read
    monkeypatch.setattr(SpanTable, "read", lambda self, version=None: reads.append(1) or read(self, version))
    stored = ST.ingest_spans(spark, src, table, work, max_files=1)
    assert sorted(r.span_id for r in stored.collect()) == sorted([f"a{k}" for k in range(20)] + [f"new{k}-0" for k in range(9)])
    assert len(reads) < 10                                                    # one a batch before, and one at the end
    left = ST.BatchFolders(spark, f"{work}/waiting")
    assert left.ids() == []
    _errors(spark, 4, [1], "dead").write.parquet(f"{work}/waiting/batch_id=99")      # left by a run that died
    assert "dead0" in {r.span_id for r in ST.ingest_spans(spark, src, table, work).collect()}
