"""Table schemas (span table, dimensions, snapshots, logs)."""

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()

# Request-metadata key holding a trace's session id (FIXTURES.md §2).
SESSION_KEY = "trace.session"
MAP_SS = T.MapType(S, S, True)

EVENT = T.StructType([
    T.StructField("name", S),
    T.StructField("timestamp_ms", L),
    T.StructField("attributes", MAP_SS),
])

# One row per span. `timestamp` is stored as TIMESTAMP_NTZ holding UTC wall-clock
# time so results never depend on the reader's session time zone.
SPAN = T.StructType([
    T.StructField("request_id", S, False),
    T.StructField("trace_id", S),
    T.StructField("span_id", S, False),
    T.StructField("span_name", S),
    T.StructField("span_type", S),
    T.StructField("parent_span_id", S),
    T.StructField("start_time_ms", L),
    T.StructField("end_time_ms", L),
    T.StructField("status", S),
    T.StructField("attributes", MAP_SS),
    T.StructField("events", T.ArrayType(EVENT)),
    T.StructField("request_metadata", MAP_SS),
    T.StructField("execution_order", I),
    T.StructField("inputs", S),
    T.StructField("outputs", S),
    T.StructField("tags", MAP_SS),
    T.StructField("experiment_id", S),
    T.StructField("timestamp", T.TimestampNTZType()),
])
SPAN_COLUMNS = [f.name for f in SPAN.fields]
SCALAR_SPAN_COLUMNS = [f.name for f in SPAN.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType))]

EXPERIMENT = T.StructType([
    T.StructField("experiment_id", S, False),
    T.StructField("name", S),
    T.StructField("artifact_location", S),
    T.StructField("lifecycle_stage", S),
    T.StructField("creation_time", T.TimestampNTZType()),
    T.StructField("last_update_time", T.TimestampNTZType()),
    T.StructField("tags", MAP_SS),
])

RUN = T.StructType([
    T.StructField("run_id", S, False),
    T.StructField("experiment_id", S),
    T.StructField("run_name", S),
    T.StructField("status", S),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("artifact_uri", S),
    T.StructField("lifecycle_stage", S),
    T.StructField("params", MAP_SS),
    T.StructField("metrics", T.MapType(S, T.DoubleType())),
])

# Environment snapshot written at session start (one JSON object per session).
# The field names are those of the snapshot files being read.
SNAPSHOT = T.StructType([
    T.StructField("session_id", S),
    T.StructField("git_sha", S),
    T.StructField("git_dirty", S),
    T.StructField("claude_md_hash", S),
    T.StructField("claude_md_content", S),
    T.StructField("skills_hash", S),
    T.StructField("skills_prompts", MAP_SS),
    T.StructField("prompt_name", S),
    T.StructField("prompt_version", I),
    T.StructField("snapshot_timestamp", S),
])

TAG_LOG = T.StructType([
    T.StructField("trace_id", S),
    T.StructField("seq", L),
    T.StructField("key", S),
    T.StructField("value", S),
])

FEEDBACK_LOG = T.StructType([
    T.StructField("trace_id", S),
    T.StructField("name", S),
    T.StructField("value", S),
    T.StructField("source_type", S),
    T.StructField("source_id", S),
    T.StructField("create_ms", L),
    T.StructField("rationale", S),
])
