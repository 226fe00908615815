"""Evaluation operators.

Scorers are expressions where possible. A user-supplied Python judge runs
through `mapInPandas` on Arrow batches of trace summaries (V2), never per row
on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanlake.functions.scans import bucketed_lead

VERSIONS_PER_TASK = 1000
SAMPLE_SIZE = 50          # fixed value: the reference's discovery sample size
EXAMPLES_PER_ISSUE = 3    # fixed value: example trace ids shown per issue


def sample_traces(traces: DataFrame, n: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """V1: deterministic sample of n traces: the n smallest sha2(seed|trace_id).
    A top-k (per-partition heap), so it is one pass with no global sort."""
    h = F.sha2(F.concat(F.lit(f"{seed}|"), F.col("trace_id")), 256)
    return traces.withColumn("_h", h).orderBy("_h", "trace_id").limit(n).drop("_h")


def rule_scores(summary: DataFrame, feedback: DataFrame | None = None, max_seconds: float | None = None) -> DataFrame:
    """V2 built-in scorers over trace summaries: failed spans, negative latest
    human feedback and, only when `max_seconds` is given, root-span latency.
    Wall-clock time is not a failure by default: a coding-agent session idles
    while it waits for the user. Returns trace_id, passed, category, rationale."""
    dur = (F.col("end_time_ms") - F.col("timestamp_ms")).cast("double") / F.lit(1000.0)
    slow = F.coalesce(dur > max_seconds, F.lit(False)) if max_seconds is not None else F.lit(False)
    s = summary
    neg = F.lit(False)
    if feedback is not None:
        q = (feedback.filter(F.col("name") == "quality")
             .groupBy("trace_id").agg(F.max_by("value", F.struct("create_ms", "value")).alias("q")))
        s = s.join(q, "trace_id", "left")
        neg = F.coalesce(F.col("q") == "poor", F.lit(False))
    category = (F.when(F.col("error_span_count") > 0, F.lit("errors"))
                .when(slow, F.lit("slow"))
                .when(neg, F.lit("negative_feedback")))
    rationale = (F.when(F.col("error_span_count") > 0,
                        F.format_string("%d of %d spans failed", F.col("error_span_count"), F.col("span_count")))
                 .when(slow, F.format_string("root span took %.3f s", dur))
                 .when(neg, F.lit("latest human quality rating is poor"))
                 .otherwise(F.lit("no failure signal")))
    return s.select("trace_id", category.isNull().alias("passed"), category.alias("category"),
                    rationale.alias("rationale"))


def judge_traces(summary: DataFrame, judge: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """V2 pluggable judge: `judge(batch)` gets a pandas frame of trace summaries
    and returns columns trace_id, passed (bool), category, rationale. Runs on
    Arrow batches inside the executors."""
    def run(batches):
        for pdf in batches:
            out = judge(pdf)
            yield out[["trace_id", "passed", "category", "rationale"]]
    return summary.mapInPandas(run, "trace_id string, passed boolean, category string, rationale string")


def issue_summary(scores: DataFrame, k: int = EXAMPLES_PER_ISSUE, spans: DataFrame | None = None) -> DataFrame:
    """V3 / A10: per failure category: trace count, frequency among all scored
    traces, confidence (share of failing traces in the category, 0-100), the
    first k example trace ids, a description (its commonest rationale) and, with
    `spans`, the root causes: the k operations that failed in most of its
    traces. Examples and causes use a row_number <= k filter, which Spark plans
    as a per-partition group limit before the shuffle, so a huge category never
    ships all its ids."""
    total = scores.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(~F.col("passed")).alias("n_failed"))
    failing = scores.filter(~F.col("passed"))
    counts = failing.groupBy("category").agg(F.count_distinct("trace_id").alias("n_traces"))
    w = Window.partitionBy("category").orderBy("trace_id")
    ex = (failing.select("category", "trace_id").withColumn("_rn", F.row_number().over(w))
          .filter(F.col("_rn") <= k).groupBy("category")
          .agg(F.array_join(F.array_sort(F.collect_list("trace_id")), ",").alias("example_trace_ids")))
    told = failing.groupBy("category", "rationale").agg(F.count(F.lit(1)).alias("n")).groupBy("category").agg(
        F.max_by("rationale", F.struct("n", "rationale")).alias("description"))
    counts = counts.join(told, "category")
    causes = []
    if spans is not None:
        failed = spans.filter(F.col("status") == "ERROR").select("trace_id", "span_name").distinct()
        each = failing.select("category", "trace_id").distinct().join(failed, "trace_id").groupBy("category", "span_name").agg(F.count(F.lit(1)).alias("n"))
        most = Window.partitionBy("category").orderBy(F.desc("n"), "span_name")
        named = each.withColumn("_rn", F.row_number().over(most)).filter(F.col("_rn") <= k).groupBy("category").agg(
            F.array_sort(F.collect_list(F.struct("_rn", "span_name"))).alias("_c"))
        counts = counts.join(named, "category", "left")
        causes = [F.coalesce(F.array_join("_c.span_name", ","), F.lit("")).alias("root_causes")]
    j = counts.join(ex, "category").crossJoin(F.broadcast(total))  # `total` is one row
    return j.select(
        F.col("category").alias("name"), "n_traces",
        (F.col("n_traces").cast("double") / F.col("n_total")).alias("frequency"),
        F.floor(F.col("n_traces") * F.lit(100) / F.col("n_failed")).cast("int").alias("confidence"),
        "example_trace_ids", "description", *causes)


def evaluation_dataset(traces: DataFrame, feedback: DataFrame, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """V4: traces with their latest human labels and a reproducible split by hash."""
    lab = feedback.groupBy("trace_id").agg(
        F.max_by("value", F.when(F.col("name") == "quality", F.struct("create_ms", "value"))).alias("quality_label"),
        F.max_by("value", F.when(F.col("name") == "toxic", F.struct("create_ms", "value"))).alias("toxic_label"))
    return (traces.select("trace_id").join(lab, "trace_id", "inner")
            .withColumn("split", F.when(held_out("trace_id", test_share, seed), "test").otherwise("train")))


def held_out(key: str, test_share: float = 0.2, seed: int = 42) -> Column:
    """True for the rows of the test part: by SHA-256 of seed and key, the same
    on every partitioning and in every engine; a null key is never held out."""
    bucket = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")), 256), 1, 8), 16, 10).cast("bigint") % 1000
    return F.coalesce(bucket < int(test_share * 1000), F.lit(False))


def aggregated_metrics(spans: DataFrame, by: str = "experiment_id") -> DataFrame:
    """V5: latency, tokens and errors per group. Tokens come from the
    `tokens` attribute, unparsable values ignored."""
    from spanlake.functions.exprs import avg_seconds, error_count
    tokens = F.col("attributes")["tokens"].try_cast("bigint")
    return spans.groupBy(by).agg(
        F.count_distinct("trace_id").alias("n_traces"), F.count(F.lit(1)).alias("n_spans"),
        avg_seconds().alias("avg_span_seconds"), F.sum(tokens).alias("total_tokens"),
        error_count().alias("error_spans"))


def binary_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """V6: accuracy, precision, recall, F1 in one pass; 0/0 -> 0.0."""
    t, p = F.col(y_true) == 1, F.col(y_pred) == 1
    g = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
               F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))
    d = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec, rec = d(tp, tp + fp), d(tp, tp + fn)
    return g.select("tp", "fp", "fn", "tn",
                    d(tp + tn, tp + fp + fn + tn).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
                    F.when((prec + rec) == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec)).alias("f1_score"))


def train_and_evaluate(df: DataFrame, features: str = "embedding", label: str = "label", seed: int = 42, key: str = "vec_id"):
    """V7: 80/20 split by a hash of the row's key (`held_out`), standardise,
    random forest (100 trees, depth 10), predict. Returns the test-set predictions (id columns kept) and the fitted model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector
    data = df.withColumn("features_raw", array_to_vector(F.col(features).cast("array<double>")))
    test_part = held_out(key, seed=seed)
    train, test = data.filter(~test_part), data.filter(test_part)
    pipe = Pipeline(stages=[
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=100, maxDepth=10, seed=seed),
    ])
    model = pipe.fit(train)
    return model.transform(test), model


def traces_for_commit(enriched: DataFrame, git_sha: str | None = None) -> DataFrame:
    """Traces per commit / instruction version (tags cc_env.git_sha,
    claude_md_hash); with `git_sha` only that commit."""
    e = enriched.filter(F.col("git_sha") != "none")
    if git_sha is not None:
        e = e.filter(F.col("git_sha") == git_sha)
    return e.groupBy("git_sha", "claude_md_hash").agg(F.count(F.lit(1)).alias("n_traces"))


def quality_by_version(enriched: DataFrame, summary: DataFrame, feedback: DataFrame) -> DataFrame:
    """Per prompt version: traces, error rate, rated traces, share rated
    good, and the error-rate change from the previous version that has traces
    (a scan of a prompt's versions, split into ranges of versions)."""
    q = (feedback.filter(F.col("name") == "quality").groupBy("trace_id")
         .agg(F.max_by("value", F.struct("create_ms", "value")).alias("quality")))
    j = (enriched.filter(F.col("prompt_version").isNotNull())
         .select("trace_id", "prompt_name", "prompt_version")
         .join(summary.select("trace_id", "error_span_count"), "trace_id")
         .join(q, "trace_id", "left"))
    g = j.groupBy("prompt_name", "prompt_version").agg(
        F.count(F.lit(1)).alias("n_traces"),
        (F.count_if(F.col("error_span_count") > 0).cast("double") / F.count(F.lit(1))).alias("error_rate"),
        F.count("quality").alias("n_rated"),
        F.when(F.count("quality") > 0,
               F.count_if(F.col("quality") == "good").cast("double") / F.count("quality")).alias("good_rate"))
    # Downwards, the next version is the previous one; a prompt of very many versions is split into ranges.
    down = g.withColumn("_down", -F.col("prompt_version"))
    led = bucketed_lead(down, "prompt_name", ["_down"], ["error_rate"], F.floor(F.col("_down") / F.lit(VERSIONS_PER_TASK)), prefix="_previous_")
    return led.withColumn("error_rate_delta", F.col("error_rate") - F.col("_previous_error_rate")).drop("_down", "_previous_error_rate")
