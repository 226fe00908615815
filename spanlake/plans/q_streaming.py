"""Registered streaming queries: ST1-ST3 (each runs its stream to completion
over the whole table, then returns the sink contents), and the versioned span
table under ST3 (S10, C3)."""

from pyspark.sql import functions as F

from spanlake.plans.fixture_sql import with_tables
from spanlake.plans.registry import query, spans
from spanlake.session import scratch_dir
from spanlake.sources.fixtures import materialise
from spanlake.sources.span_table import SpanTable, move
from spanlake.streaming import streams as ST


@query("st1_error_alert_stream", with_tables("""
SELECT date_trunc('hour', timestamp) AS window_start, date_trunc('hour', timestamp) + INTERVAL 1 HOUR AS window_end,
 count(*) AS error_count, count(*) > 10 AS alert FROM spans WHERE status = 'ERROR' GROUP BY 1, 2""", "spans"))
def st1(spark, sf):
    work = scratch_dir(spark, "streams", "st1", unique=True)
    return ST.error_alerts(spark, materialise(spark, sf, "spans"), work)


@query("st2_session_snapshot_join", with_tables("""
SELECT * FROM (SELECT r.session_id, r.trace_id, (SELECT max(e.snapshot_ms) FROM env_snapshots e
  WHERE e.session_id = r.session_id AND e.snapshot_ms <= r.start_time_ms) AS snapshot_ms, r.start_time_ms AS trace_start_ms
 FROM (SELECT DISTINCT session_id, trace_id, start_time_ms FROM spans
       WHERE parent_span_id IS NULL AND session_id IS NOT NULL) r) WHERE snapshot_ms IS NOT NULL""",
    "spans", "env_snapshots"))
def st2(spark, sf):
    work = scratch_dir(spark, "streams", "st2", unique=True)
    return ST.session_snapshot_join(spark, materialise(spark, sf, "spans"), materialise(spark, sf, "env_snapshots"), work)


@query("st2_consume_once_stream", with_tables("""
SELECT e.session_id, e.snapshot_ms, arg_min(r.trace_id, (r.start_time_ms, r.trace_id)) AS trace_id,
 min(r.start_time_ms) AS trace_start_ms
FROM env_snapshots e JOIN spans r ON r.session_id = e.session_id AND r.parent_span_id IS NULL
 AND r.start_time_ms >= e.snapshot_ms
WHERE NOT EXISTS (SELECT 1 FROM env_snapshots n WHERE n.session_id = e.session_id
 AND n.snapshot_ms > e.snapshot_ms AND n.snapshot_ms <= r.start_time_ms)
GROUP BY e.session_id, e.snapshot_ms""", "spans", "env_snapshots"))
def st2_once(spark, sf):
    work = scratch_dir(spark, "streams", "st2-once", unique=True)
    return ST.consumed_snapshots(spark, materialise(spark, sf, "spans"), materialise(spark, sf, "env_snapshots"), work)


@query("st3_incremental_ingest", with_tables("SELECT trace_id, span_id, status, start_time_ms FROM spans", "spans"))
def st3(spark, sf):
    """Two deliveries of every span file, at different rates: each span once."""
    work = scratch_dir(spark, "streams", "st3", unique=True)
    path = materialise(spark, sf, "spans")
    twice = ST.span_stream(spark, path, 1).unionByName(ST.span_stream(spark, path))
    return ST.ingest_stream(twice, f"{work}/table", work).select("trace_id", "span_id", "status", "start_time_ms")


@query("st3_tag_upsert_stream", with_tables("""
SELECT trace_id, key, arg_max(value, seq) AS value FROM tag_log GROUP BY trace_id, key""", "tag_log"))
def st3_tags(spark, sf):
    work = scratch_dir(spark, "streams", "st3-tags", unique=True)
    return ST.tag_upserts(spark, materialise(spark, sf, "tag_log"), work)


# ---- S10, C3: versions of a span table -------------------------------------------------

SECOND_LOAD_MS = 1704931200000          # 2024-01-11T00:00:00Z
KEEP_FROM = "2024-01-17 00:00:00"
CHANGES_CTE = f"""
err AS (SELECT DISTINCT trace_id, 'yes' AS reviewed FROM spans WHERE status = 'ERROR'),
rv AS (SELECT s.trace_id, s.span_id, s.start_time_ms, s.timestamp, err.reviewed FROM spans s LEFT JOIN err ON err.trace_id = s.trace_id)"""
DELETED = f"coalesce(timestamp < TIMESTAMP '{KEEP_FROM}', false)"


def _versioned(spark, sf, name):
    """Version 1 and 2: spans loaded in two parts; 3: traces with an error are
    tagged; 4: old spans go. The table is folded between 2 and 3."""
    t = SpanTable(spark, scratch_dir(spark, "span-tables", name, unique=True))
    s = spans(spark, sf)
    t.append(s.filter(F.col("start_time_ms") < SECOND_LOAD_MS))
    t.append(s.filter(F.col("start_time_ms") >= SECOND_LOAD_MS))
    t.fold()
    errors = s.filter(F.col("status") == "ERROR").select("trace_id").distinct()
    t.upsert_tags(errors.select("trace_id", F.lit("reviewed").alias("key"), F.lit("yes").alias("value")))
    t.delete(F.expr(DELETED.replace("TIMESTAMP ", "TIMESTAMP_NTZ ")))
    return t


@query("s10_change_feed", with_tables(f"""
SELECT 2 AS version, 'insert' AS change, trace_id, span_id, CAST(NULL AS VARCHAR) AS reviewed FROM rv WHERE start_time_ms >= {SECOND_LOAD_MS}
UNION ALL SELECT 3, 'update_preimage', trace_id, span_id, NULL FROM rv WHERE reviewed = 'yes'
UNION ALL SELECT 3, 'update_postimage', trace_id, span_id, reviewed FROM rv WHERE reviewed = 'yes'
UNION ALL SELECT 4, 'delete', trace_id, span_id, reviewed FROM rv WHERE {DELETED}""", "spans", extra=CHANGES_CTE))
def s10_changes(spark, sf):
    """What happened to the table after version 1, up to version 4."""
    feed = _versioned(spark, sf, "changes").changes(1, 4)
    return feed.select(F.col("version").cast("int").alias("version"), "change", "trace_id", "span_id", F.col("tags")["reviewed"].alias("reviewed"))


@query("s10_table_at_version", with_tables(f"""
SELECT 3 AS at_version, trace_id, span_id, reviewed, CASE WHEN reviewed = 'yes' THEN 3 WHEN start_time_ms < {SECOND_LOAD_MS} THEN 1 ELSE 2 END AS written_by FROM rv
UNION ALL SELECT 4, trace_id, span_id, reviewed, CASE WHEN reviewed = 'yes' THEN 3 WHEN start_time_ms < {SECOND_LOAD_MS} THEN 1 ELSE 2 END
 FROM rv WHERE NOT {DELETED}""", "spans", extra=CHANGES_CTE))
def s10_at_version(spark, sf):
    """The table as of version 3 from base and later versions, and of 4 from a fold."""
    t = _versioned(spark, sf, "versions")
    t.fold()
    row = lambda v: t.read(v).select(
        F.lit(v).alias("at_version"), "trace_id", "span_id", F.col("tags")["reviewed"].alias("reviewed"), F.col("version").cast("int").alias("written_by"))
    return row(3).unionByName(row(4))


@query("c3_archive_move", with_tables(f"""
SELECT CASE WHEN {DELETED} THEN 'archive' ELSE 'live' END AS tier, trace_id, span_id, start_time_ms FROM spans""", "spans"))
def c3_move(spark, sf):
    """Old spans move from the live table to the archive; the first attempt
    stops after it has written the archive, the second one finishes."""
    path = scratch_dir(spark, "span-tables", "move", unique=True)
    live, archive = SpanTable(spark, f"{path}/live"), SpanTable(spark, f"{path}/archive")
    live.append(spans(spark, sf))
    old = F.expr(DELETED.replace("TIMESTAMP ", "TIMESTAMP_NTZ "))
    archive.append(live.read().drop("version").filter(old), 1)
    move(live, archive, old, 1)
    row = lambda t, tier: t.read().select(F.lit(tier).alias("tier"), "trace_id", "span_id", "start_time_ms")
    return row(live, "live").unionByName(row(archive, "archive"))
