"""Input tables derived from the driver's parquet files (FIXTURES.md §2).

The reference ships no trace data, so the span table, environment snapshots,
transcripts, tag log and feedback log are derived from `events`, `documents`,
`conversations` and `labels` with DataFrame operations. Each derived table is
written once as parquet under the shared scratch folder (``scratch_dir``) and
read back from there, so every operator scans a columnar table with filter
pushdown and column pruning, like the production span table at rest.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.functions.exprs import epoch_ntz
from spanlake.functions.scans import bucketed_row_number
from spanlake.schema import EVENT, SESSION_KEY
from spanlake.session import scratch_dir

FIXTURE_VERSION = "v7"
TABLES = ("spans", "env_snapshots", "transcripts", "tag_log", "feedback_log")

# Fixed values of the fixture recipe (FIXTURES.md §2).
CLOCK_SKEW_MS = 864000000      # +10 days on every 97th event
SNAPSHOT_EPOCH_MS = 1704067200000  # 2024-01-01T00:00:00Z
LATER_MS = 9 * 86400000        # between a session's snapshots
AGAIN_MS = 30000               # until a snapshot is taken again
BAD_LINE = '{"type": "user", "message": {"cont'


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _trace_id(user_id, ts) -> F.Column:
    week = F.floor((F.dayofmonth(ts) - 1) / F.lit(7.0)).cast("int")
    return F.concat(F.lit("tr-"), user_id.cast("string"), F.lit("-"), week.cast("string"))


def derive_tag_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _raw(spark, sf_dir, "events")
    return ev.select(
        _trace_id(F.col("user_id"), F.col("ts")).alias("trace_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("key"),
        F.get_json_object("props", "$.k").cast("string").alias("value"),
    )


def latest_tags(tag_log: DataFrame) -> DataFrame:
    """Per-trace tag map, last write wins per key."""
    from spanlake.operators.annotations import tag_maps
    return tag_maps(tag_log)


def _ms(ts) -> F.Column:
    return F.timestamp_diff("MILLISECOND", epoch_ntz(), ts)


def span_events(spark: SparkSession, sf_dir: str, tag_log: DataFrame | None = None) -> DataFrame:
    """The events with what their spans need from other rows: position in the
    trace (`seq`), `parent_event` and the trace's `tags`. Everything else of a
    span comes from its own row (`span_rows`) and goes through no shuffle."""
    ev = _raw(spark, sf_dir, "events")
    e = ev.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        _trace_id(F.col("user_id"), F.col("ts")).alias("trace_id"),
    )
    # Position of each event in its trace, per (trace, hour) plus the counts of
    # the trace's earlier hours, so a very large trace is not numbered by one task.
    s = bucketed_row_number(e, "trace_id", ["ts", "event_id"], F.floor(_ms(F.col("ts")) / F.lit(3_600_000)), out="seq")
    parents = s.select(
        F.col("trace_id").alias("p_trace"), F.col("seq").alias("p_seq"), F.col("event_id").alias("parent_event")
    )
    p = s.join(
        parents,
        (s.trace_id == parents.p_trace) & (s.seq > 1) & (parents.p_seq == F.floor(s.seq / F.lit(2.0)).cast("int")),
        "left",
    )
    tags = latest_tags(tag_log if tag_log is not None else derive_tag_log(spark, sf_dir))
    return p.drop("p_trace", "p_seq").join(tags, "trace_id", "left")


def span_rows(events: DataFrame) -> DataFrame:
    """Each row of `span_events` as a span."""
    from spanlake.schema import SPAN_COLUMNS
    st = _ms(F.col("ts")) + F.when(F.col("event_id") % 97 == 0, F.lit(CLOCK_SKEW_MS)).otherwise(F.lit(0))
    q = events.withColumns({"st": st, "k": F.get_json_object("props", "$.k").cast("int")})
    k = F.col("k")
    span_type = (
        F.when(F.col("seq") == 1, "WORKFLOW")
        .when(F.col("event_type") == "view", "PREPROCESSING")
        .when(F.col("event_type") == "signup", "FEATURE_ENGINEERING")
        .when(F.col("event_type") == "click", "INFERENCE")
        .when(F.col("event_type") == "purchase", "TRAINING")
        .otherwise("EVALUATION")
    )
    parent = (
        F.when(F.col("seq") == 1, F.lit(None).cast("string"))
        .when(F.col("event_id") % 89 == 0, F.concat(F.lit("sp-missing-"), F.col("event_id").cast("string")))
        .otherwise(F.concat(F.lit("sp-"), F.col("parent_event").cast("string")))
    )
    session = F.concat(F.lit("sess-"), F.col("user_id").cast("string"))
    spans = q.select(
        F.concat(F.lit("rq-"), F.col("trace_id")).alias("request_id"),
        "trace_id",
        F.concat(F.lit("sp-"), F.col("event_id").cast("string")).alias("span_id"),
        F.concat(F.col("event_type"), F.lit("_"), (k % 4).cast("string")).alias("span_name"),
        span_type.alias("span_type"),
        parent.alias("parent_span_id"),
        F.col("st").alias("start_time_ms"),
        F.when(k == 98, F.lit(None).cast("bigint"))
        .otherwise(F.col("st") + F.floor(F.col("value") * 100).cast("bigint")).alias("end_time_ms"),
        F.when(k < 8, "ERROR").when(k == 99, F.lit(None).cast("string")).otherwise("OK").alias("status"),
        F.create_map(
            F.lit("k"), k.cast("string"),
            F.lit("event_type"), F.col("event_type"),
            F.lit("tokens"), (k * 10 + 5).cast("string"),
        ).alias("attributes"),
        F.array().cast(f"array<{EVENT.simpleString()}>").alias("events"),
        F.create_map(F.lit(SESSION_KEY), session).alias("request_metadata"),
        F.col("seq").cast("int").alias("execution_order"),
        F.col("props").alias("inputs"),
        F.concat(F.lit('{"k2": '), (k * 2).cast("string"), F.lit("}")).alias("outputs"),
        (F.col("user_id") % 5).cast("string").alias("experiment_id"),
        F.col("ts").alias("timestamp"),
        F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags"),
    )
    return spans.select(*SPAN_COLUMNS)


def derive_spans(spark: SparkSession, sf_dir: str, tag_log: DataFrame | None = None) -> DataFrame:
    return span_rows(span_events(spark, sf_dir, tag_log))


def first_texts(docs: DataFrame, first: DataFrame) -> DataFrame:
    """(source, lang, began_with): the text of each group's smallest id, `first`
    (source, lang, first_id) from an aggregate that does not read the texts."""
    f = first.withColumnsRenamed({"source": "_source", "lang": "_lang"})
    same = (docs["source"] == f["_source"]) & (docs["lang"] == f["_lang"]) & docs["doc_id"].eqNullSafe(f["first_id"])
    return docs.join(f, same, "left_semi").groupBy("source", "lang").agg(F.min_by("text", "doc_id").alias("began_with"))


def derive_env_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of sessions of three documents each, days apart, and every
    seventh taken once more. Instructions are whole texts: the document's own,
    or (odd ids) the one that its source and language began with, so that a
    project goes back to earlier instructions. Two skill files a snapshot."""
    from spanlake.operators.prompts import prompts_hash
    d = _raw(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    # Stored first, so that Spark knows their sizes: a small side is broadcast
    # and the documents' texts are not shuffled.
    first = derived_folder(spark, sf_dir, "first_ids", lambda: d.groupBy("source", "lang").agg(F.min("doc_id").alias("first_id")))
    began = derived_folder(spark, sf_dir, "first_texts", lambda: first_texts(d, first))
    d = d.join(began, ["source", "lang"])
    doc = F.col("doc_id")
    sha_src = F.floor(doc / F.lit(10.0)).cast("int").cast("string")
    instructions = F.when(doc % 13 == 0, "").when(doc % 2 == 1, F.col("began_with")).otherwise(F.col("text"))
    skills = F.when(doc % 5 == 0, F.create_map().cast("map<string,string>")).otherwise(F.create_map(
        F.concat(F.lit("skills/"), F.col("lang"), F.lit("/SKILL.md")), F.concat(F.lit("Write in "), F.col("lang"), F.lit("\n"), F.col("text")),
        F.concat(F.lit("extra/"), F.col("source"), F.lit("/SKILL.md")), F.concat(F.lit("About "), F.col("source"))))
    at = F.lit(SNAPSHOT_EPOCH_MS) + doc * 60000 + (doc % 3) * LATER_MS
    times = F.when(doc % 7 == 0, F.array(at, at + AGAIN_MS)).otherwise(F.array(at))
    return d.select(
        F.concat(F.lit("sess-"), F.floor(doc / F.lit(3.0)).cast("string")).alias("session_id"),
        F.col("source").alias("project"),
        F.when(doc % 17 == 0, "none").otherwise(F.substring(F.sha2(sha_src, 256), 1, 40)).alias("git_sha"),
        F.when(doc % 17 == 0, "none").when(doc % 4 == 0, "true").otherwise("false").alias("git_dirty"),
        instructions.alias("instructions"),
        F.when(instructions == "", "none").otherwise(F.sha2(instructions, 256)).alias("instructions_hash"),
        prompts_hash(skills).alias("skills_hash"),
        skills.alias("skills_prompts"),
        F.explode(times).alias("snapshot_ms"),
    )


def derive_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _raw(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").groupBy("conv_id").agg(F.max("turn").alias("lu"))
    j = c.join(u, "conv_id", "left")
    last_user = (F.col("role") == "user") & (F.col("turn") == F.col("lu"))
    m5 = F.col("conv_id") % 5
    nl = F.lit("\n")
    text = (
        F.when(last_user & (m5 == 0), F.concat(F.lit("Base directory for this skill: /opt/skills/feedback-trace"), nl, "text"))
        .when(last_user & (m5 == 1), F.concat(nl, F.lit("  Base directory for this skill: /opt/skills/tag-trace "), nl, "text"))
        .when(last_user & (m5 == 2), F.concat(F.lit("Base directory for this skill: /opt/skills/other"), nl, "text"))
        .when((F.col("role") == "user") & (F.col("turn") == 0) & (m5 == 4),
              F.concat(F.lit("Base directory for this skill: /opt/skills/tag-trace"), nl, "text"))
        .otherwise(F.col("text"))
    )
    return j.select(
        F.concat(F.lit("sess-"), F.col("conv_id").cast("string")).alias("session_id"),
        F.col("turn").alias("ord"),
        F.col("role").alias("type"),
        F.coalesce(last_user & (m5 == 3), F.lit(False)).alias("is_tool_result"),
        text.alias("text"),
    )


def derive_feedback_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lb = _raw(spark, sf_dir, "labels")
    tid = F.concat(F.lit("tr-"), (F.col("doc_id") % 50).cast("string"), F.lit("-"), (F.col("doc_id") % 4).cast("string"))
    quality = lb.select(
        tid.alias("trace_id"), F.lit("quality").alias("name"),
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("value"),
        F.lit("HUMAN").alias("source_type"),
        F.concat(F.lit("user_"), (F.col("doc_id") % 7).cast("string")).alias("source_id"),
        (F.col("doc_id") * 1000).alias("create_ms"),
    )
    toxic = lb.select(
        tid.alias("trace_id"), F.lit("toxic").alias("name"),
        F.when(F.col("toxic") == 1, "true").otherwise("false").alias("value"),
        F.lit("CODE").alias("source_type"), F.lit("rule").alias("source_id"),
        (F.col("doc_id") * 1000 + 1).alias("create_ms"),
    )
    return quality.unionByName(toxic).withColumn("rationale", F.lit(None).cast("string"))


_DERIVERS = {
    "spans": lambda spark, d: derive_spans(spark, d),
    "env_snapshots": derive_env_snapshots,
    "transcripts": derive_transcripts,
    "tag_log": derive_tag_log,
    "feedback_log": derive_feedback_log,
}

# Sort keys inside each written file: keep a trace's spans together so row-group
# statistics prune `trace_id = ?` lookups; the rebalance splits oversized partitions.
# Snapshots hold two whole texts a row: they are written as the documents are
# read, neither shuffled nor sorted.
_LAYOUT = {
    "spans": ("trace_id", ["trace_id", "start_time_ms"]),
    "env_snapshots": (None, []),
    "transcripts": ("session_id", ["session_id", "ord"]),
    "tag_log": ("trace_id", ["trace_id", "seq"]),
    "feedback_log": ("trace_id", ["trace_id", "create_ms"]),
}


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The un-materialised derivation (a lazy plan over the driver tables)."""
    return _DERIVERS[name](spark, sf_dir)


def _input_identity(spark: SparkSession, sf_dir: str) -> str:
    """Hash of the input files' paths, lengths and times: other data, other tables."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(sf_dir)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(f"{s.getPath().toString()}|{s.getLen()}|{s.getModificationTime()}" for s in fs.listStatus(folder))
    return hashlib.sha1("\n".join([*files, str(FIXTURE_VERSION)]).encode()).hexdigest()[:16]


def table_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return scratch_dir(spark, "tables", _input_identity(spark, sf_dir), name)


def _publish(spark: SparkSession, path: str, write) -> str:
    """The folder `path`, written on first use: `write(folder)` fills a fresh
    folder, which is then renamed, so no reader or second writer sees a part."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        fresh = hadoop.Path(f"{path}-{uuid.uuid4().hex[:12]}")
        write(fresh.toString())
        if fs.exists(target) or not fs.rename(fresh, target):
            if not fs.exists(target):
                raise OSError(f"cannot publish {path}")
            fs.delete(fresh, True)      # another session was first
    return path


def materialise(spark: SparkSession, sf_dir: str, name: str) -> str:
    def write(folder: str) -> None:
        key, order = _LAYOUT[name]
        if key is None:
            rows = derive(spark, sf_dir, name)
        elif name == "spans":       # dealt out before the rows are made wide
            rows = span_rows(span_events(spark, sf_dir).hint("rebalance", key))
        else:
            rows = derive(spark, sf_dir, name).hint("rebalance", key)
        (rows.sortWithinPartitions(*order) if order else rows).write.option("compression", "zstd").parquet(folder)
    return _publish(spark, table_path(spark, sf_dir, name), write)


def _write_transcripts_jsonl(spark: SparkSession, sf_dir: str, path: str) -> None:
    from spanlake.operators.sessions import transcripts_to_jsonl
    t = load_table(spark, sf_dir, "transcripts")
    lines = transcripts_to_jsonl(t)
    # every seventh session has a line cut off after its first entry
    number = F.substring("session_id", 6, 20).cast("long")
    bad = t.filter(number % 7 == 0).groupBy("session_id").agg((F.min("ord") + F.lit(0.5)).alias("ord"))
    lines = lines.withColumn("ord", F.col("ord").cast("double")).unionByName(bad.withColumn("value", F.lit(BAD_LINE)))
    # a session stays inside one file (hash partitioning never splits a key),
    # its lines in order; a flat folder of a few files lists fast
    (lines.repartition("session_id").sortWithinPartitions("session_id", "ord")
     .select("value").write.mode("overwrite").text(path))


def _write_snapshots_json(spark: SparkSession, sf_dir: str, path: str) -> None:
    from spanlake.operators.prompts import assign_prompt_versions, snapshot_rows, write_snapshots
    rows = snapshot_rows(assign_prompt_versions(load_table(spark, sf_dir, "env_snapshots")))
    write_snapshots(rows, path, mode="overwrite")


_FILE_WRITERS = {"transcripts_jsonl": _write_transcripts_jsonl, "snapshots_json": _write_snapshots_json}


def derived_path(spark: SparkSession, sf_dir: str, name: str, rows, by: str | None = None) -> str:
    """Folder of the result of `rows()`, written once per data folder, in
    partitions of the column `by` if one is named."""
    def write(folder: str) -> None:
        w = rows().hint("rebalance", by).write.partitionBy(by) if by else rows().write
        w.parquet(folder)

    return _publish(spark, table_path(spark, sf_dir, name), write)


def bucketed_spans(spark: SparkSession, sf_dir: str, buckets: int = 8) -> DataFrame:
    """The span table bucketed by trace, written once per data folder."""
    from spanlake.sources.layouts import read_bucketed, write_bucketed
    path = _publish(spark, table_path(spark, sf_dir, f"spans_bucketed_{buckets}"),
                    lambda folder: write_bucketed(load_table(spark, sf_dir, "spans"), folder, buckets))
    return read_bucketed(spark, path, buckets)


def derived_folder(spark: SparkSession, sf_dir: str, name: str, rows) -> DataFrame:
    return spark.read.parquet(derived_path(spark, sf_dir, name, rows))


def file_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of raw files (JSON Lines transcripts, snapshot JSON) written once
    from the derived tables, for the file readers S4 and S5."""
    return _publish(spark, table_path(spark, sf_dir, name), lambda folder: _FILE_WRITERS[name](spark, sf_dir, folder))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a derived table, writing it first if this data folder has none yet."""
    if name not in _DERIVERS:
        return _raw(spark, sf_dir, name)
    return spark.read.parquet(materialise(spark, sf_dir, name))
