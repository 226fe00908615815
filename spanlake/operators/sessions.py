"""Session transcripts, skip filter and environment enrichment.

The reference runs these per Stop event inside a hook process. Here they are
bulk jobs over all sessions: every step is a per-session aggregate or an
equi-join on session/trace ids, so a session with a huge transcript is combined
map-side instead of being gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.functions.exprs import epoch_ntz, iso_utc, prompt_uri, skill_invocation_name, strip_ws

# Fixed values that must equal the reference's.
SKIP_SKILLS = ("feedback-trace", "tag-trace")
ENV_TAG_PREFIX = "cc_env."
ENV_TAG_KEYS = ("git_sha", "git_dirty", "claude_md_hash", "skills_hash", "snapshot_timestamp")
COMPANION_TYPE = "env_snapshot"
FALSY_JSON = ("null", "{}", "[]", '""', "false", "0", "0.0")


# ---- S4: transcripts ---------------------------------------------------------

def read_transcripts(spark: SparkSession, path: str, glob: str | None = "*.jsonl") -> DataFrame:
    """JSON Lines transcripts -> (session_id, ord, type, is_tool_result, text, parse_ok).

    The session comes from the entry's `sessionId` field when present, else a
    `session_id=` partition directory, else the file name `<session>.jsonl`.
    Blank lines are skipped. Entry order is the file order, kept as (file,
    split start, position in split): splits of one file are read by different
    tasks, so no task must see a whole file. An unparsable line marks its
    session `parse_ok = false`: the session of the last line before it in its
    file that names one (`carried_session`), else that of the file.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path)
    has_session = "session_id" in raw.columns
    from_file = (F.col("session_id").cast("string") if has_session
                 else F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.jsonl)?$", 1))
    df = raw.select(
        "value",
        from_file.alias("_file_session"),
        F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                 F.monotonically_increasing_id().alias("i")).alias("ord"),
    ).filter(strip_ws("value") != "")
    df = df.withColumn("v", F.try_parse_json("value"))
    df = carried_session(df.withColumn("_named", F.try_variant_get(F.col("v"), "$.sessionId", "string")))
    session = F.coalesce("_named", "_carried", "_file_session")
    tool = F.try_variant_get(F.col("v"), "$.toolUseResult", "variant")
    content = F.try_variant_get(F.col("v"), "$.message.content", "variant")
    parts = F.try_variant_get(content, "$", "array<variant>")
    part_text = F.array_join(
        F.transform(
            F.filter(parts, lambda p: F.coalesce(
                F.schema_of_variant(p).startswith("OBJECT") & (F.try_variant_get(p, "$.type", "string") == "text"),
                F.lit(False))),
            lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit(""))),
        "\n")
    text = (F.when(content.isNull(), F.lit(""))
            .when(parts.isNotNull(), part_text)
            .otherwise(F.coalesce(F.try_variant_get(content, "$", "string"), F.to_json(content))))
    return df.select(
        session.alias("session_id"), "ord",
        F.try_variant_get(F.col("v"), "$.type", "string").alias("type"),
        F.coalesce(~F.to_json(tool).isin(list(FALSY_JSON)), F.lit(False)).alias("is_tool_result"),
        text.alias("text"),
        F.col("v").isNotNull().alias("parse_ok"),
    )


def carried_session(lines: DataFrame) -> DataFrame:
    """Lines (`ord` = file, split start, place; `_named` = the session they
    name; `v` = parsed line) with `_carried`: for an unparsable line the
    session of the last line before it in the file that names one.

    Lines that parse are not shuffled. The bad lines are scanned together with
    the (place, session) of the good ones per split, and a split's last session
    is carried on to the file's later splits by one row per split, so that no
    task sees a file. A line's place is its task's, so `lines` must be a scan."""
    bad = F.col("v").isNull()
    f, b, i = (F.col(f"ord.{c}").alias(f"_{c}") for c in "fbi")
    keys = lines.select(f, b, i, "_named", bad.alias("_bad")).filter(F.col("_bad") | F.col("_named").isNotNull())
    inside = Window.partitionBy("_f", "_b").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = keys.withColumn("_in", F.last("_named", ignorenulls=True).over(inside)).filter("_bad").select("_f", "_b", "_i", "_in")
    splits = keys.groupBy("_f", "_b").agg(F.max_by("_named", F.when(F.col("_named").isNotNull(), F.col("_i"))).alias("_last"))
    before = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_f", "_b", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    found = near.join(splits, ["_f", "_b"]).select("_f", "_b", "_i", F.coalesce("_in", "_before").alias("_carried"))
    same = (F.col("ord.f") == found["_f"]) & (F.col("ord.b") == found["_b"]) & (F.col("ord.i") == found["_i"])
    poor = lines.filter(bad).join(found, same, "left").drop("_f", "_b", "_i")
    return lines.filter(~bad).withColumn("_carried", F.lit(None).cast("string")).unionByName(poor)


def transcripts_to_jsonl(entries: DataFrame) -> DataFrame:
    """Render flat transcript rows as JSON Lines (one `value` per entry), the
    way the host writes them: every entry names its `sessionId`; odd entries
    carry list-form content with a non-text part; tool results carry a
    `toolUseResult` object."""
    list_content = F.array(
        F.struct(F.lit("text").alias("type"), F.col("text").alias("text")),
        F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text")),
    )
    tool = F.struct(F.lit("ok").alias("stdout"))

    def line(content, with_tool):
        fields = [F.col("type").alias("type"), F.col("session_id").alias("sessionId")]
        if with_tool:
            fields.append(tool.alias("toolUseResult"))
        fields.append(F.struct(F.col("type").alias("role"), content.alias("content")).alias("message"))
        return F.to_json(F.struct(*fields))

    odd = F.col("ord") % 2 == 1
    tr = F.coalesce(F.col("is_tool_result"), F.lit(False))
    value = (F.when(odd & tr, line(list_content, True)).when(odd, line(list_content, False))
             .when(tr, line(F.col("text"), True)).otherwise(line(F.col("text"), False)))
    return entries.select("session_id", "ord", value.alias("value"))


# ---- E1: skip filter ---------------------------------------------------------

def skip_decisions(entries: DataFrame, stop_events: DataFrame | None = None,
                   skip_skills=SKIP_SKILLS) -> DataFrame:
    """E1 (+W2): per session, is its last non-tool-result user entry an
    invocation of a skip-listed skill?

    One aggregate per session: max_by over qualifying entries (a partial
    aggregate, not a backward scan of the file). A session with no qualifying
    entry, an unparsable line, or `stop_hook_active` is never skipped.
    Returns session_id, skill_name, skipped.
    """
    qual = (F.col("type") == "user") & ~F.coalesce(F.col("is_tool_result"), F.lit(False))
    ok = F.col("parse_ok") if "parse_ok" in entries.columns else F.lit(True)
    g = entries.groupBy("session_id").agg(
        F.max_by(F.when(qual, F.col("text")), F.when(qual, F.col("ord"))).alias("last_text"),
        F.count_if(qual).alias("n_qual"),
        F.min(ok).alias("parse_ok"),
    )
    name = F.when(F.col("n_qual") > 0, skill_invocation_name("last_text"))
    out = g.select("session_id", name.alias("skill_name"), "parse_ok")
    skipped = F.col("parse_ok") & F.coalesce(F.col("skill_name").isin(list(skip_skills)), F.lit(False))
    if stop_events is not None:
        out = out.join(stop_events.select("session_id", "stop_hook_active"), "session_id", "left")
        skipped = skipped & ~F.coalesce(F.col("stop_hook_active"), F.lit(False))
    return out.select("session_id", "skill_name", skipped.alias("skipped"))


# ---- J4 / W1: latest trace per session -----------------------------------------

def session_traces(spans: DataFrame) -> DataFrame:
    """(trace_id, session_id, timestamp_ms): the root span's session (request
    metadata) from the same single aggregate that finds the root."""
    from spanlake.operators.lineage import trace_summary
    return trace_summary(spans, with_payload=False).select("trace_id", "session_id", "timestamp_ms")


def latest_trace_per_session(traces: DataFrame) -> DataFrame:
    """Newest trace of each session (ties: smallest trace_id), as a partial
    aggregate: min(struct(-timestamp, trace_id))."""
    best = F.min(F.struct((-F.col("timestamp_ms")).alias("neg"), F.col("trace_id").alias("trace_id")))
    return (traces.filter(F.col("session_id").isNotNull()).groupBy("session_id").agg(best.alias("b"))
            .select("session_id", F.col("b.trace_id").alias("trace_id"), (-F.col("b.neg")).alias("timestamp_ms")))


def _orderable(df: DataFrame, column: str) -> F.Column:
    """The column, or a map's sorted entries, which can be compared."""
    is_map = df.schema[column].dataType.typeName() == "map"
    return F.array_sort(F.map_entries(column)).alias(column) if is_map else F.col(column)


def consume_snapshots(snapshots: DataFrame, order: str = "snapshot_ms") -> DataFrame:
    """E5 (batch): one snapshot per session - the sidecar present at the first
    Stop is the last one written before it; later duplicates are dropped."""
    cols = [c for c in snapshots.columns if c != "session_id"]
    return (snapshots.groupBy("session_id")
            .agg(F.max_by(F.struct(*cols), F.struct(order, *[_orderable(snapshots, c) for c in cols if c != order])).alias("s"))
            .select("session_id", "s.*"))


def first_stop_after_snapshot(traces: DataFrame, snapshots: DataFrame, bucket_ms: int = 86_400_000) -> DataFrame:
    """E5, first-Stop form: each snapshot is consumed by the session's first
    trace that starts at or after it, unless a newer snapshot of the session
    comes first (the newer one replaces it; the older is never used).

    The session's snapshots and traces are merged into one time-ordered event
    list and each snapshot looks at the next event (`bucketed_lead`), so there
    is no snapshot x trace pairing and a long session is split over time
    buckets. Returns session_id, snapshot_ms, trace_id, trace_start_ms (NULL
    when the snapshot was never consumed)."""
    from spanlake.functions.scans import bucketed_lead
    snaps = snapshots.select("session_id", F.col("snapshot_ms").alias("ts"), F.lit(0).alias("kind"),
                             F.lit(None).cast("string").alias("trace_id"))
    stops = traces.filter(F.col("session_id").isNotNull()).select(
        "session_id", F.col("timestamp_ms").alias("ts"), F.lit(1).alias("kind"), "trace_id")
    ev = snaps.unionByName(stops).withColumn("tie", F.coalesce("trace_id", F.lit("")))
    led = bucketed_lead(ev, "session_id", ["ts", "kind", "tie"], ["kind", "trace_id", "ts"],
                        F.floor(F.col("ts") / F.lit(bucket_ms)))
    hit = F.coalesce(F.col("next_kind") == 1, F.lit(False))
    return led.filter(F.col("kind") == 0).select(
        "session_id", F.col("ts").alias("snapshot_ms"),
        F.when(hit, F.col("next_trace_id")).alias("trace_id"),
        F.when(hit, F.col("next_ts")).alias("trace_start_ms"))


def snapshot_at_stop(traces: DataFrame, snapshots: DataFrame, bucket_ms: int = 86_400_000) -> DataFrame:
    """The snapshot pending at each Stop: the latest of its session taken at or
    before it. A running maximum over the merged events, per (session, bucket)
    plus the largest snapshot of the session's earlier buckets, so a long
    session is split over time buckets. Stops without one give no row.
    Returns session_id, trace_id, snapshot_ms, trace_start_ms."""
    snaps = snapshots.select("session_id", F.col("snapshot_ms").alias("ts"), F.col("snapshot_ms").alias("snap"),
                             F.lit(None).cast("string").alias("trace_id"))
    stops = traces.filter(F.col("session_id").isNotNull()).select(
        "session_id", F.col("timestamp_ms").alias("ts"), F.lit(None).cast("long").alias("snap"), "trace_id")
    ev = snaps.unionByName(stops).withColumn("_b", F.floor(F.col("ts") / F.lit(bucket_ms)))
    inside = Window.partitionBy("session_id", "_b").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("session_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ev.groupBy("session_id", "_b").agg(F.max("snap").alias("_m"))
               .select("session_id", "_b", F.max("_m").over(before).alias("_carried")))
    return (ev.withColumn("_in", F.max("snap").over(inside)).join(carried, ["session_id", "_b"])
            .filter(F.col("snap").isNull())
            .select("session_id", "trace_id", F.coalesce("_in", "_carried").alias("snapshot_ms"),
                    F.col("ts").alias("trace_start_ms"))
            .filter(F.col("snapshot_ms").isNotNull()))


# ---- E2 / E3 / J5: enrichment ------------------------------------------------------

def enrich_traces(traces: DataFrame, snapshots: DataFrame,
                  skipped: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """E2+E3 (E5, J5): the trace of the first Stop after a snapshot gets its five
    cc_env.* values and, when name and version are set, the prompt URI.

    `skipped` (trace_id) are the traces whose Stop E1 skips: they are neither
    enriched nor consume a snapshot. Returns (enriched, unmatched snapshots:
    replaced by a newer one, or without a Stop after them). Snapshots need
    session_id, git_sha, git_dirty, claude_md_hash, skills_hash, snapshot_ms,
    prompt_name, prompt_version; of several rows of one session and millisecond
    the largest is the last. A trace without a snapshot is not in `enriched`.
    """
    stops = traces if skipped is None else traces.join(skipped.select("trace_id"), "trace_id", "left_anti")
    keys = ["session_id", "snapshot_ms"]
    cols = [c for c in snapshots.columns if c not in keys]
    best = F.max_by(F.struct(*cols), F.struct(*[_orderable(snapshots, c) for c in cols]))
    snap = snapshots.groupBy(*keys).agg(best.alias("s")).select(*keys, "s.*")
    used = first_stop_after_snapshot(stops, snap.select(*keys)).select(*keys, "trace_id")
    j = snap.join(used, keys, "left")
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))  # noqa: E731  (X13)
    enriched = j.filter(F.col("trace_id").isNotNull()).select(
        "session_id", "trace_id",
        none("git_sha").alias("git_sha"), none("git_dirty").alias("git_dirty"),
        none("claude_md_hash").alias("claude_md_hash"), none("skills_hash").alias("skills_hash"),
        F.coalesce(iso_utc("snapshot_ms"), F.lit("none")).alias("snapshot_timestamp"),
        "prompt_name", "prompt_version",
        prompt_uri("prompt_name", "prompt_version").alias("prompt_uri"),
    )
    return enriched, j.filter(F.col("trace_id").isNull()).select(*snapshots.columns)


def enrichment_tag_rows(enriched: DataFrame, seq: F.Column | None = None) -> DataFrame:
    """E2/E3 as tag-log rows (trace_id, seq, key, value), ready to union into the log."""
    seq = F.lit(0).cast("bigint") if seq is None else seq
    rows = [F.struct(F.lit(ENV_TAG_PREFIX + k).alias("key"), F.col(k).alias("value")) for k in ENV_TAG_KEYS]
    rows.append(F.struct(F.lit(ENV_TAG_PREFIX + "prompt_uri").alias("key"), F.col("prompt_uri").alias("value")))
    return (enriched.select("trace_id", seq.alias("seq"), F.explode(F.array(*rows)).alias("kv"))
            .select("trace_id", "seq", "kv.key", "kv.value").filter(F.col("value").isNotNull()))


def companion_traces(enriched: DataFrame) -> DataFrame:
    """One env_snapshot companion trace per enriched trace with a prompt
    URI, with its tags and the back-reference tag for the session trace.
    Deterministic companion id instead of "newest trace anywhere" (R9)."""
    e = enriched.filter(F.col("prompt_uri").isNotNull())
    cid = F.concat(F.lit("tr-env-"), F.substring(F.sha2(F.concat(F.lit("env_snapshot|"), F.col("trace_id")), 256), 1, 32))
    return e.select(
        cid.alias("companion_trace_id"),
        "session_id",
        F.col("trace_id").alias("session_trace_id"),
        "git_sha", "claude_md_hash", "prompt_uri",
        F.lit(COMPANION_TYPE).alias("companion_type"),
    )


def companion_spans(companions: DataFrame, traces: DataFrame) -> DataFrame:
    """The companions as rows of the span table: one root span per companion
    trace (name env_snapshot, type UNKNOWN), of the experiment of its session
    trace, at the Stop, which is the end of that trace's root (its start when
    open). `companions` from `companion_traces`, `traces` with trace_id,
    experiment_id, timestamp_ms and end_time_ms (T12). The stored tag map is
    empty: the tags are log rows (`companion_tag_rows`)."""
    from spanlake.schema import SPAN
    cid = F.col("companion_trace_id")
    stop = F.greatest("timestamp_ms", F.coalesce("end_time_ms", "timestamp_ms"))
    seconds = (stop.cast("decimal(20,3)") / F.lit(1000)).cast("decimal(18,6)")
    result = F.to_json(F.struct("session_id", "session_trace_id", "git_sha", "claude_md_hash"))
    t = traces.select(F.col("trace_id").alias("session_trace_id"), "experiment_id", "timestamp_ms", "end_time_ms")
    values = {
        "request_id": F.concat(F.lit("rq-"), cid), "trace_id": cid, "span_id": F.concat(F.lit("sp-"), cid),
        "span_name": F.lit(COMPANION_TYPE), "span_type": F.lit("UNKNOWN"), "start_time_ms": stop, "end_time_ms": stop,
        "status": F.lit("OK"), "attributes": F.create_map(), "events": F.array(), "request_metadata": F.create_map(),
        "execution_order": F.lit(1), "outputs": result, "tags": F.create_map(), "experiment_id": F.col("experiment_id"),
        "timestamp": epoch_ntz() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds),
    }
    return companions.join(t, "session_trace_id", "left").select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SPAN.fields])


def companion_tag_rows(companions: DataFrame, seq: F.Column | None = None) -> DataFrame:
    """E4/J6 as tag-log rows (trace_id, seq, key, value): type, session and
    session trace on the companion, and the back-reference on the session trace."""
    seq = F.lit(0).cast("bigint") if seq is None else seq

    def row(trace, key, value):
        return F.struct(F.col(trace).alias("trace_id"), F.lit(ENV_TAG_PREFIX + key).alias("key"), F.col(value).alias("value"))

    rows = F.array(row("companion_trace_id", "type", "companion_type"), row("companion_trace_id", "session_id", "session_id"),
                   row("companion_trace_id", "session_trace_id", "session_trace_id"),
                   row("session_trace_id", "snapshot_trace_id", "companion_trace_id"))
    return companions.select(seq.alias("seq"), F.explode(rows).alias("r")).select("r.trace_id", "seq", "r.key", "r.value")
