"""Structured Streaming forms of the event-driven parts (ST1-ST3).

Streams read the span table (or snapshot table) folder as a file source, so
new files are picked up incrementally. Every stream writes through
`foreachBatch` into one folder per batch id with overwrite: a retried batch
replaces its own folder, so the sinks are idempotent under retries and lost
executors. Nothing depends on a watermark: rows may come in any order and any
amount late, and a back-fill can be rate-limited with `max_files`. ST2 keeps
state per session and day; ST1 and the tag stream combine their batches when
the sink is read; ST3 commits its batches to a versioned span table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.functions.exprs import instant_to_ntz, ntz_to_instant
from spanlake.schema import SESSION_KEY, SPAN, SPAN_COLUMNS
from spanlake.sources.span_table import SpanTable, file_system


def span_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """File-source stream over a span folder, at most `max_files` files per batch."""
    r = spark.readStream.schema(SPAN)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def batch_sink(out_path: str, rows=None, partition_by: str | None = None):
    """foreachBatch writer: `rows(batch, batch_id)` (default: the batch itself)
    goes to the batch's own `batch_id=N` folder with overwrite."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = (rows(batch, batch_id) if rows else batch).write.mode("overwrite")
        (w.partitionBy(partition_by) if partition_by else w).parquet(f"{out_path}/batch_id={batch_id}")
    return write


def read_sink(spark: SparkSession, out_path: str, schema: str) -> DataFrame:
    """All rows of a batch sink with their batch_id. No folder yet means no
    batch has run: an empty frame. Any other read failure is raised."""
    schema = f"{schema}, batch_id int"
    try:
        return spark.read.schema(schema).parquet(out_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_available(query_df: DataFrame, checkpoint: str, sink, mode: str = "append") -> None:
    """Drive a stream over everything available now, then stop."""
    (query_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).foreachBatch(sink).start().awaitTermination())


# ---- ST1 ----------------------------------------------------------------------------

ERROR_COUNTS = "window_start timestamp_ntz, window_end timestamp_ntz, error_count long"


def error_counts(spans: DataFrame, window: str = "1 hour") -> DataFrame:
    """Errors per event-time window of a batch (a partial aggregate)."""
    e = spans.filter(F.col("status") == "ERROR").select(ntz_to_instant("timestamp").alias("event_time"))
    return (e.groupBy(F.window("event_time", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("error_count"))
            .select(instant_to_ntz("w.start").alias("window_start"), instant_to_ntz("w.end").alias("window_end"),
                    "error_count"))


def error_alerts(spark: SparkSession, spans_path: str, work: str, threshold: int = 10,
                 window: str = "1 hour", max_files: int | None = None) -> DataFrame:
    """ST1 end to end: each batch writes its count per window, the reader adds
    them up, so an error counts however late it comes. Returns every window
    with `alert` = count > threshold."""
    out = f"{work}/out"
    run_available(span_stream(spark, spans_path, max_files), f"{work}/ckpt",
                  batch_sink(out, lambda batch, _: error_counts(batch, window)))
    res = (read_sink(spark, out, ERROR_COUNTS).groupBy("window_start", "window_end")
           .agg(F.sum("error_count").alias("error_count")))
    return res.withColumn("alert", F.col("error_count") > threshold)


# ---- ST2 ----------------------------------------------------------------------------

DAY_MS = 86_400_000
DAY_EVENTS = ("session_id string, day long, head struct<trace_id:string,ts:long>, last_snap long, "
              "snaps array<struct<snapshot_ms:long,trace_id:string,trace_start_ms:long>>, "
              "stops array<struct<trace_id:string,ts:long,snapshot_ms:long>>")


def day_matches(days: DataFrame) -> DataFrame:
    """(session_id, day, snaps, stops) with all events of each day -> the day's
    matches (DAY_EVENTS): in order of time, a snapshot before a Stop of the same
    millisecond, a snapshot is used by the event after it if that is a Stop, and
    the last snapshot so far is pending at a Stop."""
    snaps = F.transform("snaps", lambda ts: F.struct(ts.alias("ts"), F.lit(None).cast("string").alias("trace_id")))
    stops = F.transform("stops", lambda s: F.struct(s["ts"].alias("ts"), s["trace_id"].alias("trace_id")))
    keys = ["session_id", "day"]
    ev = days.select(*keys, F.explode(F.concat(snaps, stops)).alias("e")).select(*keys, "e.*")
    order = Window.partitionBy(*keys).orderBy("ts", F.col("trace_id").asc_nulls_first())
    snap = F.when(F.col("trace_id").isNull(), F.col("ts"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = ev.select(*keys, "ts", "trace_id", F.row_number().over(order).alias("n"), F.max(snap).over(so_far).alias("pending"),
                  F.lead("trace_id").over(order).alias("next_id"), F.lead("ts").over(order).alias("next_ts"))
    used = F.struct(F.col("ts").alias("snapshot_ms"), F.col("next_id").alias("trace_id"),
                    F.when(F.col("next_id").isNotNull(), F.col("next_ts")).alias("trace_start_ms"))
    stop = F.struct("trace_id", "ts", F.col("pending").alias("snapshot_ms"))
    is_stop = F.col("trace_id").isNotNull()
    return x.groupBy(*keys).agg(
        F.max(F.when(is_stop & (F.col("n") == 1), F.struct("trace_id", "ts"))).alias("head"), F.max(snap).alias("last_snap"),
        F.collect_list(F.when(~is_stop, used)).alias("snaps"), F.collect_list(F.when(is_stop, stop)).alias("stops"))


def session_days(spark: SparkSession, spans_path: str, snapshots_path: str, work: str, max_files: int | None = None) -> DataFrame:
    """Snapshots and Stops (root spans that name a session) as one keyed stream.

    The state of a session and day, an aggregate that Spark keeps, holds the
    day's snapshot times and Stops; an event, however late, changes the matches
    of its own day only, which are found and written anew (`day_matches`). A long session is many keys, and a refresh reads new files,
    the state they touch, and one emitted row per day. Re-delivered events
    change nothing. Returns the last row of every (session, day)."""
    read = spark.readStream.schema("session_id string, snapshot_ms long")
    snaps = (read.option("maxFilesPerTrigger", max_files) if max_files else read).parquet(snapshots_path)
    snaps = snaps.select("session_id", F.col("snapshot_ms").alias("ts"), F.lit(None).cast("string").alias("trace_id"))
    stops = (span_stream(spark, spans_path, max_files).filter(F.col("parent_span_id").isNull())
             .select(F.col("request_metadata")[SESSION_KEY].alias("session_id"), F.col("start_time_ms").alias("ts"), "trace_id")
             .filter(F.col("trace_id").isNotNull()))
    events = snaps.unionByName(stops).filter(F.col("session_id").isNotNull() & F.col("ts").isNotNull())
    of = F.col("trace_id")
    days = (events.withColumn("day", F.floor(F.col("ts") / F.lit(DAY_MS))).groupBy("session_id", "day")
            .agg(F.collect_set(F.when(of.isNull(), F.col("ts"))).alias("snaps"),
                 F.collect_set(F.when(of.isNotNull(), F.struct("ts", "trace_id"))).alias("stops")))
    run_available(days, f"{work}/ckpt", batch_sink(f"{work}/days", lambda batch, _: day_matches(batch)), "update")
    rows = read_sink(spark, f"{work}/days", DAY_EVENTS)
    values = F.struct("head", "last_snap", "snaps", "stops")
    return rows.groupBy("session_id", "day").agg(F.max_by(values, "batch_id").alias("d")).select("session_id", "day", "d.*")


def session_snapshot_join(spark: SparkSession, spans_path: str, snapshots_path: str, work: str,
                          max_files: int | None = None) -> DataFrame:
    """ST2: each Stop with the snapshot pending in its session, i.e. the latest
    one taken at or before it, however long ago; one row per Stop, none for a
    Stop without an earlier snapshot.
    Returns session_id, trace_id, snapshot_ms, trace_start_ms."""
    days = session_days(spark, spans_path, snapshots_path, work, max_files)
    earlier = Window.partitionBy("session_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    d = days.withColumn("carried", F.max("last_snap").over(earlier)).select("session_id", "carried", F.explode("stops").alias("s"))
    return d.select("session_id", "s.trace_id", F.coalesce("s.snapshot_ms", "carried").alias("snapshot_ms"),
                    F.col("s.ts").alias("trace_start_ms")).filter(F.col("snapshot_ms").isNotNull())


def consumed_snapshots(spark: SparkSession, spans_path: str, snapshots_path: str, work: str,
                       max_files: int | None = None) -> DataFrame:
    """ST2 + E5: each snapshot with the first Stop that consumes it; a snapshot
    replaced by a newer one before any Stop is never used.
    Returns session_id, snapshot_ms, trace_id, trace_start_ms."""
    days = session_days(spark, spans_path, snapshots_path, work, max_files)
    following = F.lead("head").over(Window.partitionBy("session_id").orderBy("day"))
    d = days.withColumn("next", following).select("session_id", "last_snap", "next", F.explode("snaps").alias("s"))
    open_ = F.col("s.trace_id").isNull() & (F.col("s.snapshot_ms") == F.col("last_snap"))     # pending at the day's end
    return d.select("session_id", "s.snapshot_ms",
                    F.when(open_, F.col("next.trace_id")).otherwise(F.col("s.trace_id")).alias("trace_id"),
                    F.when(open_, F.col("next.ts")).otherwise(F.col("s.trace_start_ms")).alias("trace_start_ms")
                    ).filter(F.col("trace_id").isNotNull())


# ---- ST3 ----------------------------------------------------------------------------

FOLD_EVERY = 8       # versions
TAKE_SHARE = 2       # batches wait until they are a half of the table


def ingest_spans(spark: SparkSession, source_path: str, table_path: str, work: str,
                 max_files: int | None = None) -> DataFrame:
    """ST3: incremental ingest of new span files into a table, each
    (trace_id, span_id) once, however late it comes or comes again."""
    return ingest_stream(span_stream(spark, source_path, max_files), table_path, work)


def ingest_stream(spans: DataFrame, table_path: str, work: str, fold_every: int = FOLD_EVERY) -> DataFrame:
    """A batch waits in the stream's folder as it came. Once the waiting batches
    have a half of the table's bytes, and at the end of a run, they become a
    version of a `SpanTable` together: each span once, from the earliest of them,
    less those that the table holds in the same stretch of time
    (file and row group statistics prune the rest; a re-delivery repeats the
    span as it was, thus with the same timestamp). So the table's keys are read
    a few times a run, not once a batch. A retried batch replaces its folder or
    finds its id in the table's log; batches left by a run that died are taken
    by the next one. Every `fold_every` versions the small folders are folded
    and those folded before are dropped, so the number of files stays bounded."""
    spark = spans.sparkSession
    table, waiting = SpanTable(spark, table_path), BatchFolders(spark, f"{work}/waiting")
    keys = ["trace_id", "span_id", "timestamp"]

    def take() -> None:
        ids = [i for i in waiting.ids() if i > table.batch()]
        if ids:
            rows = waiting.read(ids, SPAN)
            span = rows.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count_if(F.col("timestamp").isNull()).alias("undated")).first()
            near = F.col("timestamp").between(F.lit(span["lo"]), F.lit(span["hi"]))
            stored = table.read().filter(near | F.col("timestamp").isNull() if span["undated"] else near).select(*(F.col(k).alias(f"k_{k}") for k in keys))
            first = F.row_number().over(Window.partitionBy(*keys).orderBy("batch_id"))      # limited before the shuffle
            fresh = rows.withColumn("_n", first).filter("_n = 1").drop("_n", "batch_id")
            table.append(fresh.join(stored, [fresh[k].eqNullSafe(stored[f"k_{k}"]) for k in keys], "left_anti"), ids[-1])
            if table.unfolded() >= fold_every:
                table.vacuum(1)
                table.fold()
        waiting.drop(table.batch())

    def sink(batch: DataFrame, batch_id: int) -> None:
        if table.batch() >= batch_id:
            return
        waiting.write(batch, batch_id)
        if waiting.size() * TAKE_SHARE >= table.size():
            take()

    run_available(spans, f"{work}/ckpt", sink)
    take()
    return table.read().select(*SPAN_COLUMNS)


class BatchFolders:
    """Batches of a stream that wait in one folder each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._fs, self._root = file_system(spark, path)

    def _at(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def ids(self) -> list[int]:
        if not self._fs.exists(self._root):
            return []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in self._fs.listStatus(self._root))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(self._at(batch_id))

    def read(self, ids: list[int], schema) -> DataFrame:
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
        return rows.option("basePath", self.path).parquet(*(self._at(i) for i in ids))

    def size(self) -> int:
        """Bytes."""
        return self._fs.getContentSummary(self._root).getLength() if self._fs.exists(self._root) else 0

    def drop(self, up_to: int) -> None:
        for i in self.ids():
            if i <= up_to:
                self._fs.delete(file_system(self.spark, self._at(i))[1], True)


def tag_upserts(spark: SparkSession, tag_log_path: str, work: str, max_files: int | None = None) -> DataFrame:
    """ST3 (tags): stream the append-only tag log; each micro-batch writes its
    own last-write-per-(trace, key) rows (a partial aggregate of the batch) to
    its batch folder, and the reader keeps the highest `seq` per (trace, key)
    across batches. Returns (trace_id, key, value)."""
    r = spark.readStream.schema("trace_id string, seq long, key string, value string")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    out = f"{work}/out"

    def last_writes(batch: DataFrame, _: int) -> DataFrame:
        return (batch.groupBy("trace_id", "key").agg(F.max(F.struct("seq", "value")).alias("l"))
                .select("trace_id", "key", "l.seq", "l.value"))

    run_available(r.parquet(tag_log_path), f"{work}/ckpt", batch_sink(out, last_writes))
    merged = read_sink(spark, out, "trace_id string, key string, seq long, value string")
    return (merged.groupBy("trace_id", "key").agg(F.max(F.struct("seq", "value")).alias("l"))
            .select("trace_id", "key", "l.value"))
