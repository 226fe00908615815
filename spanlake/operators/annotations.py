"""Tags and human feedback.

Tags and assessments are append-only logs. The current tag map of a trace is
"last write wins per (trace, key)": a `max_by` partial aggregate, then a
per-trace map bounded by the number of distinct keys (not by writes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions.exprs import split_kv, tag_equals, tag_not_equals

HAS_FEEDBACK = "has_feedback"       # fixed tag keys used by the feedback command
FEEDBACK_TAG_PREFIX = "feedback_"
HUMAN = "HUMAN"


def latest_tag_values(tag_log: DataFrame) -> DataFrame:
    """(trace_id, key, value) with the last write per key: the highest seq,
    of writes with the same seq the largest value."""
    return tag_log.groupBy("trace_id", "key").agg(F.max_by("value", F.struct("seq", "value")).alias("value"))


def tag_maps(tag_log: DataFrame) -> DataFrame:
    """(trace_id, tags MAP) without DUPLICATED_MAP_KEY: keys are unique after dedup."""
    return latest_tag_values(tag_log).groupBy("trace_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("tags"))


def tag_requests_to_log(requests: DataFrame, default_target: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """T8 command in bulk. `requests` = (batch_id, trace_id, seq, pair).

    A request without trace_id tags `default_target` (one row with trace_id,
    e.g. `lineage.most_recent_session_trace`, T7). A batch with any pair
    lacking '=' is rejected whole (atomic, our choice; the reference applies
    earlier pairs, then aborts). Returns (tag log rows, rejected batches with
    the number of invalid pairs and the first one)."""
    if default_target is not None:
        target = F.broadcast(default_target.select(F.col("trace_id").alias("_default")).limit(1))  # one row
        requests = (requests.join(target, how="left")
                    .withColumn("trace_id", F.coalesce("trace_id", "_default")).drop("_default"))
    s = requests.withColumn("_kv", split_kv("pair"))
    bad_batches = s.filter(~F.col("_kv.valid")).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_invalid"), F.min("pair").alias("first_invalid"))
    good = s.join(bad_batches.select("batch_id"), "batch_id", "left_anti")
    log = good.select("trace_id", "seq", F.col("_kv.key").alias("key"), F.col("_kv.value").alias("value"))
    return log, bad_batches


def feedback_tags(feedback_log: DataFrame, seq_offset: int = 0) -> DataFrame:
    """Tag rows implied by feedback: has_feedback='true' and feedback_<name>=<value>."""
    fb = feedback_log.select("trace_id", (F.col("create_ms") + F.lit(seq_offset)).alias("seq"), "name", "value")
    flag = fb.select("trace_id", "seq", F.lit(HAS_FEEDBACK).alias("key"), F.lit("true").alias("value"))
    named = fb.select("trace_id", "seq", F.concat(F.lit(FEEDBACK_TAG_PREFIX), "name").alias("key"), "value")
    return flag.unionByName(named)


def tag_writes(tag_log: DataFrame, feedback_log: DataFrame) -> DataFrame:
    """Explicit tags and the tags implied by feedback as one log in the
    columns of a tag log, `seq` being (time, source, sequence). The clock is the
    store's, in ms: `create_ms` of feedback and `write_ms` of the tag log; at the
    same time an explicit tag is the later write. Tags without a time (no such
    column, or null in it) count as written before all feedback; their own
    sequence numbers are compared among tags only."""
    time = F.col("write_ms") if "write_ms" in tag_log.columns else F.lit(None)
    order = lambda at, source, seq: F.struct(at.cast("long").alias("at"), F.lit(source).alias("source"), seq.cast("long").alias("seq"))
    tags = tag_log.select("trace_id", order(time, 1, F.col("seq")).alias("seq"), "key", "value")
    implied = feedback_tags(feedback_log).select("trace_id", order(F.col("seq"), 0, F.col("seq")).alias("seq"), "key", "value")
    return tags.unionByName(implied)


def log_feedback(feedback_log: DataFrame, new: DataFrame, default_target: DataFrame | None = None) -> DataFrame:
    """Append assessments (many per trace are kept). New rows without a
    trace_id go to `default_target` (one row, e.g. the latest session trace);
    source defaults to HUMAN. The has_feedback tag rows come from
    `feedback_tags` over the result."""
    if default_target is not None:
        target = F.broadcast(default_target.select(F.col("trace_id").alias("_default")).limit(1))  # one row
        new = new.join(target, how="left").withColumn("trace_id", F.coalesce("trace_id", "_default")).drop("_default")
    if "source_type" in new.columns:
        new = new.withColumn("source_type", F.coalesce("source_type", F.lit(HUMAN)))
    else:
        new = new.withColumn("source_type", F.lit(HUMAN))
    return feedback_log.unionByName(new, allowMissingColumns=True)


def latest_assessments(feedback_log: DataFrame) -> DataFrame:
    """Latest value per (trace, name) with its count (V4 uses this as labels)."""
    return feedback_log.groupBy("trace_id", "name").agg(
        F.max_by(F.struct("value", "source_type", "source_id"),
                 F.struct("create_ms", "value", "source_type", "source_id")).alias("latest"),
        F.count(F.lit(1)).alias("n"))


def feedback_summary(feedback_log: DataFrame) -> DataFrame:
    """Per trace: number of assessments, latest quality/toxic values, has_feedback."""
    return feedback_log.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("n_assessments"),
        F.max_by("value", F.when(F.col("name") == "quality", F.struct("create_ms", "value"))).alias("latest_quality"),
        F.max_by("value", F.when(F.col("name") == "toxic", F.struct("create_ms", "value"))).alias("latest_toxic"),
        F.count_if(F.col("source_type") == HUMAN).alias("n_human"),
    ).withColumn(HAS_FEEDBACK, F.lit("true"))


def traces_with_feedback(traces: DataFrame, feedback_log: DataFrame) -> DataFrame:
    """Every trace with its feedback count (0 when none) and a has-feedback flag."""
    counts = feedback_log.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n_feedback"))
    return (traces.join(counts, "trace_id", "left")
            .select("trace_id", F.coalesce("n_feedback", F.lit(0)).alias("n_feedback"),
                    F.col("n_feedback").isNotNull().alias("has_feedback")))


def search_by_tag(trace_tags: DataFrame, key: str, value: str) -> DataFrame:
    """tag.key = 'value'."""
    return trace_tags.filter(tag_equals(key, value))


def search_excluding_tag(trace_tags: DataFrame, key: str, value: str) -> DataFrame:
    """tag.key != 'value', keeping traces without the key."""
    return trace_tags.filter(tag_not_equals(key, value))


def search_by_metadata(spans: DataFrame, key: str, value: str) -> DataFrame:
    """F8: metadata.key = 'value' on request_metadata."""
    return spans.filter(F.coalesce(F.col("request_metadata")[key] == F.lit(value), F.lit(False)))


def feedback_search_counts(traces: DataFrame, tag_log: DataFrame, feedback_log: DataFrame,
                           name: str = "quality", positive: str = "good", negative: str = "poor") -> DataFrame:
    """The round trip of the feedback test as one aggregate over the store:
    traces tagged has_feedback, positive and negative ratings, and all traces."""
    tags = tag_maps(tag_writes(tag_log, feedback_log))
    t = traces.select("trace_id").join(tags, "trace_id", "left")
    key = FEEDBACK_TAG_PREFIX + name
    return t.agg(
        F.count_if(tag_equals(HAS_FEEDBACK, "true")).alias("has_feedback"),
        F.count_if(tag_equals(key, positive)).alias("positive"),
        F.count_if(tag_equals(key, negative)).alias("negative"),
        F.count(F.lit(1)).alias("all_traces"),
    )


def search_traces(traces: DataFrame, predicate=None, order_by=None, max_results: int | None = None) -> DataFrame:
    """The store's search as a DataFrame: predicate, order (default newest
    first by timestamp_ms, then trace_id) and an optional limit (top-k)."""
    out = traces if predicate is None else traces.filter(predicate)
    order_by = order_by or [F.desc("timestamp_ms"), F.asc("trace_id")]
    out = out.orderBy(*order_by)
    return out.limit(max_results) if max_results else out
