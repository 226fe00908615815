"""Span lineage, trace trees and trace summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions.exprs import fmt_utc, preview, status_or_ok, tag_not_equals
from spanlake.schema import SESSION_KEY

COMPANION_TYPE = "env_snapshot"  # fixed value: tag cc_env.type of companion traces


def trace_summary(spans: DataFrame, with_payload: bool = True, with_session: bool = True) -> DataFrame:
    """One row per trace from its root span.

    Root = a span without parent, earliest first (a trace with only dangling
    parents falls back to its earliest span). `min(struct)` is an ordinary
    partial aggregate, so a trace with very many spans is combined map-side
    instead of being gathered in one task. Catalyst cannot prune fields inside
    the struct, so callers that do not need request/response pass
    `with_payload=False` (and `with_session=False` when they do not need the
    session) and the scan never reads the JSON payload / metadata map columns.
    """
    fields = [
        F.col("parent_span_id").isNotNull().alias("has_parent"),
        F.col("start_time_ms").alias("start"),
        F.col("span_id").alias("span_id"),
        F.col("end_time_ms").alias("end"),
        F.col("status").alias("status"),
        F.col("span_name").alias("name"),
        F.col("request_id").alias("request_id"),
        F.col("experiment_id").alias("experiment_id"),
    ]
    if with_session:
        fields.append(F.col("request_metadata")[SESSION_KEY].alias("session_id"))
    if with_payload:
        fields += [F.col("inputs").alias("inputs"), F.col("outputs").alias("outputs")]
    g = spans.groupBy("trace_id").agg(
        F.min(F.struct(*fields)).alias("r"),
        F.count(F.lit(1)).alias("span_count"),
        F.count_if(F.coalesce(F.col("status") == "ERROR", F.lit(False))).alias("error_span_count"),
    )
    payload = ([F.col("r.inputs").alias("request"), F.col("r.outputs").alias("response")] if with_payload else [])
    return g.select(
        "trace_id",
        F.col("r.request_id").alias("request_id"),
        F.col("r.experiment_id").alias("experiment_id"),
        F.col("r.span_id").alias("root_span_id"),
        F.col("r.name").alias("root_span_name"),
        F.col("r.start").alias("timestamp_ms"),
        F.col("r.end").alias("end_time_ms"),
        status_or_ok("r.status").alias("status"),
        *payload,
        "span_count", "error_span_count",
        *([F.col("r.session_id").alias("session_id")] if with_session else []),
    )


def trace_tags(spans: DataFrame, tag_log: DataFrame | None = None) -> DataFrame:
    """Tag map of every trace: the one stored with its first span that has any
    (by start, then id), with the tag log laid over it: the last write of a key
    replaces the stored value. Log rows of traces without spans have no effect."""
    has_any = F.when(F.size("tags") > 0, F.struct("start_time_ms", "span_id"))
    stored = spans.groupBy("trace_id").agg(F.min_by("tags", has_any).alias("tags"))
    none = F.create_map().cast("map<string,string>")
    if tag_log is None:
        return stored.select("trace_id", F.coalesce("tags", none).alias("tags"))
    from spanlake.operators.annotations import tag_maps
    late = tag_maps(tag_log).withColumnRenamed("tags", "_late")
    late_map = F.coalesce("_late", none)
    kept = F.map_filter(F.coalesce("tags", none), lambda k, _: ~F.array_contains(F.map_keys(late_map), k))
    return stored.join(late, "trace_id", "left").select("trace_id", F.map_concat(kept, late_map).alias("tags"))


def list_recent_traces(spans: DataFrame, max_results: int = 10) -> DataFrame:
    """Id, UTC time, status and a 60-character input preview, newest first.

    The newest traces are found without payloads; only their root spans' inputs
    are then read (of a root delivered twice, the smaller input)."""
    top = (trace_summary(spans, with_payload=False, with_session=False)
           .select("trace_id", "root_span_id", "timestamp_ms", "status")
           .orderBy(F.desc("timestamp_ms"), "trace_id").limit(max_results))
    roots = spans.select(F.col("trace_id").alias("_trace"), F.col("span_id").alias("_span"), "inputs")
    at_root = F.col("_trace").eqNullSafe(F.col("trace_id")) & F.col("_span").eqNullSafe(F.col("root_span_id"))
    return (roots.join(F.broadcast(top), at_root)      # max_results rows
            .groupBy("trace_id", "timestamp_ms", "status").agg(F.min("inputs").alias("request"))
            .orderBy(F.desc("timestamp_ms"), "trace_id").limit(max_results)
            .select("trace_id", fmt_utc("timestamp_ms").alias("timestamp"), "status",
                    preview("request").alias("input_preview")))


def most_recent_session_trace(spans: DataFrame, tag_log: DataFrame | None = None) -> DataFrame:
    """Newest trace that is not a companion env_snapshot trace, by its stored
    tags and the tag log (tags lacking the key are kept: null-safe inequality)."""
    s = trace_summary(spans, with_payload=False, with_session=False).join(trace_tags(spans, tag_log), "trace_id", "left")
    return (s.filter(tag_not_equals("cc_env.type", COMPANION_TYPE))
            .orderBy(F.desc("timestamp_ms"), "trace_id").limit(1).select("trace_id"))


def _cut(df: DataFrame, workdir: str | None, name: str) -> DataFrame:
    """Cut the lineage: write the round's state as a parquet table in the shared
    scratch folder and read it back (reliable checkpoint() when no folder)."""
    if workdir is None:
        return df.checkpoint(eager=True)
    path = f"{workdir}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def trace_tree(spans: DataFrame, workdir: str | None = None) -> DataFrame:
    """Depth, top span and name path of every span, by pointer jumping.

    A span whose parent is NULL or not in its trace is a top (depth 0). Each
    round every unfinished span jumps to its ancestor's ancestor, so a chain of
    depth d finishes in about log2(d) rounds; each round is one join keyed by
    (trace_id, span id) and its result is checkpointed to cut the lineage.
    Spans that hang off a parent cycle never reach a top: depth, top and path
    stay NULL. A span id delivered several times in a trace counts once (the
    row with the smallest parent, then name, NULL last), so a round never makes
    more rows than it reads. While any span can still reach a top, the pending
    one nearest to it does so in the next round: a round that finishes none
    proves that the rest hangs off cycles, and the loop needs no cap.
    Returns trace_id, span_id, depth, root_span_id, path ('/'-joined names).
    Round states are cut with reliable checkpoint() (into spark.checkpoint.dir);
    with `workdir` ("auto" = a fresh folder in the shared scratch area) they are
    written as parquet tables instead.
    """
    if workdir == "auto":
        from spanlake.session import scratch_dir
        workdir = scratch_dir(spans.sparkSession, "tree", unique=True)
    first = F.min(F.struct(F.col("parent_span_id").isNull().alias("no_p"), F.col("parent_span_id").alias("p"),
                           F.col("span_name").isNull().alias("no_n"), F.col("span_name").alias("n")))
    nodes = (spans.groupBy("trace_id", "span_id").agg(first.alias("f"))
             .select("trace_id", "span_id", F.col("f.p").alias("parent_span_id"), F.col("f.n").alias("span_name")))
    known = spans.select(F.col("trace_id").alias("k_trace"), F.col("span_id").alias("k_id")).distinct()
    n = nodes.join(known, (nodes.trace_id == known.k_trace) & (nodes.parent_span_id == known.k_id), "left")
    is_top = F.col("k_id").isNull()
    state = n.select(
        "trace_id", "span_id",
        F.when(is_top, F.lit(None).cast("string")).otherwise(F.col("parent_span_id")).alias("anc"),
        F.when(is_top, F.lit(0)).otherwise(F.lit(1)).alias("dist"),
        F.col("span_name").alias("path"),
        F.when(is_top, F.col("span_id")).alias("top"),
    )
    state = _cut(state, workdir, "round-0")
    done = state.filter(F.col("anc").isNull())
    pending = state.filter(F.col("anc").isNotNull())
    remaining = pending.count()
    rounds = 0
    while remaining:
        rounds += 1
        a = (done.unionByName(pending)
             .select(F.col("trace_id").alias("a_trace"), F.col("span_id").alias("a_id"),
                     F.col("anc").alias("a_anc"), F.col("dist").alias("a_dist"),
                     F.col("path").alias("a_path"), F.col("top").alias("a_top")))
        j = pending.join(a, (pending.trace_id == a.a_trace) & (pending.anc == a.a_id), "inner")
        step = j.select(
            "trace_id", "span_id",
            F.col("a_anc").alias("anc"),
            (F.col("dist") + F.col("a_dist")).alias("dist"),
            F.concat(F.col("a_path"), F.lit("/"), F.col("path")).alias("path"),
            F.col("a_top").alias("top"),
        )
        step = _cut(step, workdir, f"round-{rounds}")
        done = done.unionByName(step.filter(F.col("anc").isNull()))
        pending = step.filter(F.col("anc").isNotNull())
        left = pending.count()
        if left == remaining:  # no progress: the rest hangs off a cycle
            break
        remaining = left
    out = done.select("trace_id", "span_id", F.col("dist").alias("depth"),
                      F.col("top").alias("root_span_id"), "path")
    # whatever is still pending hangs off a cycle: no depth, top or path
    cyclic = pending.select(
        "trace_id", "span_id", F.lit(None).cast("int").alias("depth"),
        F.lit(None).cast("string").alias("root_span_id"), F.lit(None).cast("string").alias("path"))
    return out.unionByName(cyclic)
