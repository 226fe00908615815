"""Filter traces down to chosen spans and re-parent what remains.

The reference loops over requested traces and makes one remote call per span.
Here the whole request list is one job: a join of the request frame with the
span table, a filter, one aggregate for the root of each new trace, and one
self-join for the parent test. Nothing is collected per trace.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.functions.exprs import attributes_match, map_or_empty, split_kv, status_or_ok
from spanlake.schema import EVENT, SPAN_COLUMNS

INT_MAX = 2147483647
SALTS = 256            # shares of a trace that meet their root separately


def requests_frame(spark: SparkSession, trace_ids: list[str]) -> DataFrame:
    """A request list (order and duplicates kept) as a frame (request_key, trace_id)."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(trace_ids)], "request_key long, trace_id string")


def lookup_traces(spans: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of every requested trace (one copy per request) and the
    requests whose trace does not exist (the 'not found, skipping' report)."""
    found = requests.join(spans, "trace_id", "inner")
    # distinct first: a partial aggregate shrinks the span side before the shuffle
    missing = requests.join(spans.select("trace_id").distinct(), "trace_id", "left_anti")
    return found, missing


def filter_spans(spans: DataFrame, span_names=None, attributes: dict | None = None) -> DataFrame:
    """name in list AND every (k, v) equals attributes[k]; None/empty = no restriction."""
    return spans.filter(attributes_match(span_names, attributes))


def parse_attribute_pairs(pairs: list[str]) -> dict[str, str]:
    """X5 for a command line: key before the first '=', value after it (a later
    pair wins); all pairs without '=' are named in one error."""
    parts = [p.partition("=") for p in pairs]
    broken = [key for key, sign, _ in parts if not sign]
    if broken:
        raise ValueError(f"attribute criteria without '=': {', '.join(map(repr, broken))}")
    return {key: value for key, _, value in parts}


def split_pairs(df: DataFrame, pair_col: str = "pair") -> tuple[DataFrame, DataFrame]:
    """X5 in bulk: (valid rows with key/value, rejected rows)."""
    s = df.withColumn("_kv", split_kv(pair_col))
    ok = s.filter("_kv.valid").select("*", F.col("_kv.key").alias("key"), F.col("_kv.value").alias("value")).drop("_kv")
    bad = s.filter(~F.col("_kv.valid")).drop("_kv")
    return ok, bad


def _order_key():
    return F.struct(F.col("start_time_ms").alias("s"),
                    F.coalesce(F.col("execution_order"), F.lit(INT_MAX)).alias("o"),
                    F.col("span_id").alias("i"))


def parent_in_matched(matched: DataFrame, group=("trace_id",)) -> DataFrame:
    """For each matched span, its parent's sort key when the parent matched too."""
    g = list(group)
    p = matched.select(*[F.col(c).alias(f"p_{c}") for c in g],
                       F.col("span_id").alias("p_span_id"), _order_key().alias("p_key"))
    cond = [matched[c] == p[f"p_{c}"] for c in g] + [matched.parent_span_id == p.p_span_id]
    return matched.join(p, cond, "left").drop(*[f"p_{c}" for c in g])


def reparent(matched: DataFrame, group=("trace_id",)) -> DataFrame:
    """New parent of each matched span inside its group.

    Root = earliest matched span (start, then execution_order, then span_id);
    its parent becomes NULL. Any other span keeps its parent only when that
    parent matched and sorts before it; otherwise it hangs off the root (never
    off the nearest matching ancestor). The rank the reference walks in order
    is replaced by comparing sort keys directly, so there is no window over a
    whole trace: the root is a partial aggregate and the parent test a join.
    A trace is dealt over SALTS shares by span id, each with a row of its own
    for the root, so that the spans of a huge trace don't meet in one task; a
    small trace has a row per share that it uses, never more than spans.
    Adds columns: new_parent_span_id (source ids), is_root, root_span_id.
    """
    g = list(group)
    keyed = matched.withColumns({"_key": _order_key(), "_salt": F.pmod(F.xxhash64("span_id"), F.lit(SALTS)).cast("int")})
    shares = keyed.groupBy(*g, "_salt").agg(F.min("_key").alias("_first"))
    root = shares.groupBy(*g).agg(F.min("_first").alias("_root"))
    roots = shares.select(*g, "_salt").join(root, g)
    j = parent_in_matched(keyed, g).join(roots, [*g, "_salt"])
    is_root = F.col("_key") == F.col("_root")
    keep = F.col("p_key").isNotNull() & (F.col("p_key") < F.col("_key"))
    new_parent = (F.when(is_root, F.lit(None).cast("string"))
                  .when(keep, F.col("parent_span_id"))
                  .otherwise(F.col("_root.i")))
    return j.select(*matched.columns,
                    new_parent.alias("new_parent_span_id"), is_root.alias("is_root"),
                    F.col("_root.i").alias("root_span_id"))


def criteria_fingerprint(span_names=None, attributes=None) -> str:
    doc = json.dumps({"span_names": list(span_names or []), "attributes": dict(sorted((attributes or {}).items()))},
                     sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(doc.encode()).hexdigest()[:16]


def new_trace_id(source_trace_id, request_key, fingerprint: str):
    """T3 identity: deterministic (the reference's ids are random), so a rerun
    after a lost executor or a retried job produces the same ids."""
    seed = F.concat_ws("|", source_trace_id, request_key.cast("string"), F.lit(fingerprint))
    return F.concat(F.lit("tr-f-"), F.substring(F.sha2(seed, 256), 1, 32))


def new_span_id(trace_id_col, source_span_id):
    return F.concat(F.lit("sp-f-"), F.substring(F.sha2(F.concat_ws("|", trace_id_col, source_span_id), 256), 1, 16))


def filter_and_create_traces(spans: DataFrame, requests: DataFrame, span_names=None,
                             attributes: dict | None = None, experiment_id: str | None = None) -> DataFrame:
    """The spans of the new, filtered traces in the span-table schema,
    plus `request_key` and `source_trace_id`, `source_span_id`.

    Per request: trace missing -> skipped; no matching span -> skipped. Copied:
    name, type, inputs, attributes, start, outputs, status (default OK), end.
    Not copied: events, source tags, request metadata. New trace tags:
    source_trace_id and filtered='true'. Experiment: `experiment_id` unless
    None/'' else the source span's.
    """
    # The matched set and its re-parenting depend only on the trace, not on the
    # request, so they are computed once per requested trace (semi-join with
    # the distinct ids) and fanned out to the requests (J2) at the end.
    wanted = requests.select("trace_id").distinct()
    matched = filter_spans(spans, span_names, attributes).join(wanted, "trace_id", "left_semi")
    r = reparent(matched, group=("trace_id",)).join(requests.select("request_key", "trace_id"), "trace_id")
    fp = criteria_fingerprint(span_names, attributes)
    tid = new_trace_id(F.col("trace_id"), F.col("request_key"), fp)
    exp = F.lit(experiment_id) if experiment_id else F.col("experiment_id")
    out = r.select(
        "request_key",
        F.col("trace_id").alias("source_trace_id"),
        F.col("span_id").alias("source_span_id"),
        tid.alias("new_trace_id"),
        "span_name", "span_type", "new_parent_span_id", "start_time_ms", "end_time_ms", "status",
        "attributes", "inputs", "outputs", "experiment_id", "timestamp", "is_root",
    )
    return out.select(
        "request_key", "source_trace_id", "source_span_id", "is_root",
        F.col("new_trace_id").alias("request_id"),
        F.col("new_trace_id").alias("trace_id"),
        new_span_id(F.col("new_trace_id"), F.col("source_span_id")).alias("span_id"),
        "span_name", "span_type",
        F.when(F.col("new_parent_span_id").isNotNull(),
               new_span_id(F.col("new_trace_id"), F.col("new_parent_span_id"))).alias("parent_span_id"),
        "start_time_ms", "end_time_ms",
        status_or_ok().alias("status"),
        map_or_empty("attributes").alias("attributes"),
        F.array().cast(f"array<{EVENT.simpleString()}>").alias("events"),
        F.create_map().cast("map<string,string>").alias("request_metadata"),
        F.lit(None).cast("int").alias("execution_order"),
        "inputs", "outputs",
        F.create_map(F.lit("source_trace_id"), F.col("source_trace_id"),
                     F.lit("filtered"), F.lit("true")).alias("tags"),
        exp.alias("experiment_id"),
        "timestamp",
    )


def created_traces(new_spans: DataFrame) -> DataFrame:
    """The returned id list of T1: one row per new trace, in request order."""
    return (new_spans.groupBy("request_key", "source_trace_id", "trace_id", "experiment_id")
            .agg(F.count(F.lit(1)).alias("span_count"))
            .orderBy("request_key", "source_trace_id"))


def run_filter_job(spans: DataFrame, requests: DataFrame, span_names=None, attribute_pairs=None,
                   experiment_id: str | None = None) -> DataFrame:
    """T5: the job entry (command-line shape) needs at least one criterion."""
    attributes = parse_attribute_pairs(attribute_pairs) if attribute_pairs else None
    if not span_names and not attributes:
        raise ValueError("a filter job without criteria would copy whole traces: give span_names or attribute_pairs")
    return filter_and_create_traces(spans, requests, span_names, attributes, experiment_id)


def write_filtered_traces(new_spans: DataFrame, path: str) -> None:
    """Append the new spans to a span table, partitioned by experiment."""
    (new_spans.select(*SPAN_COLUMNS).write.mode("append")
     .partitionBy("experiment_id").parquet(path))
