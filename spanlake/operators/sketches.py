"""Mergeable sketches beside the exact forms.

Percentiles and distinct counts over a long history need not read it again:
each day (or hour) of spans is sketched once, the sketches are stored by
day, and any range of days is answered by merging them. The exact forms stay
what they are (`scans.grouped_percentiles`, `monitoring.column_profile`);
a sketch is its own query and names its error bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.functions.exprs import duration_ms

KLL_K = 400                 # rank error under 1 % with probability 0.99
RANK_BOUND = 0.012
HLL_LG_K = 12
HLL_BOUND = 3 * 1.04 / 2 ** (HLL_LG_K / 2)      # three standard errors, relative


def _day() -> F.Column:
    return F.coalesce(F.date_format("timestamp", "yyyy-MM-dd"), F.lit("none")).alias("day")


def write_days(sketches: DataFrame, path: str) -> None:
    """Store sketches by day; days that come again are replaced, others kept."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored sketches of a range of days (both ends included)."""
    df = spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))
    if first is not None:
        df = df.filter(F.col("day") >= first)
    return df if last is None else df.filter(F.col("day") <= last)


# ---- A6: percentiles ----------------------------------------------------------------

def duration_sketches(spans: DataFrame, by: str = "span_type") -> DataFrame:
    """(day, group, n, sketch): a KLL sketch of the durations in ms of every day
    and group; spans without an end are left out. Partial sketches are merged,
    so a hot group is not one task."""
    d = spans.select(_day(), F.col(by), duration_ms().alias("ms")).filter(F.col("ms").isNotNull())
    return d.groupBy("day", by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("ms", F.lit(KLL_K)).alias("sketch"))


def merged_percentiles(sketches: DataFrame, probs: dict[str, float], by: str = "span_type") -> DataFrame:
    """(group, n, one bigint estimate per alias) over all days given."""
    m = sketches.groupBy(by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("s"))
    return m.select(by, "n", *[F.kll_sketch_get_quantile_bigint("s", F.lit(p)).alias(a) for a, p in probs.items()])


def rank_errors(spans: DataFrame, estimates: DataFrame, probs: dict[str, float], by: str = "span_type") -> DataFrame:
    """(group, n, one double per alias): how far the estimate's exact rank is
    from the one asked for. Equal values cover a range of ranks; inside it the
    error is 0. One pass over the durations with the estimates beside them."""
    e = estimates.select(F.col(by).alias("_g"), *[F.col(a).alias(f"_{a}") for a in probs])
    d = spans.select(by, duration_ms().alias("ms")).filter(F.col("ms").isNotNull())
    j = d.join(e, d[by].eqNullSafe(e["_g"]))
    counts = [c for a in probs for c in (F.count_if(F.col("ms") < F.col(f"_{a}")).alias(f"lo_{a}"), F.count_if(F.col("ms") <= F.col(f"_{a}")).alias(f"hi_{a}"))]
    r = j.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *counts)
    return r.select(by, "n", *[F.greatest(F.lit(0.0), F.col(f"lo_{a}") / F.col("n") - p, p - F.col(f"hi_{a}") / F.col("n")).alias(a) for a, p in probs.items()])


# ---- C2: distinct values ----------------------------------------------------------------

def distinct_sketches(df: DataFrame, columns: list[str]) -> DataFrame:
    """(day, column_name, n_rows, n_nulls, sketch): a HyperLogLog sketch per day
    and column, all columns in one scan and one row per day through the shuffle."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), F.hll_sketch_agg(F.col(c).cast("string"), HLL_LG_K).alias(f"{c}__hll")]
    days = df.groupBy(_day().alias("day")).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"{c}__nulls").alias("n_nulls"),
                     F.col(f"{c}__hll").alias("sketch")) for c in columns]
    return days.select("day", F.explode(F.array(*rows)).alias("r")).select("day", "r.*")


def approx_distinct(sketches: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_nulls, n_distinct) estimated over all days given."""
    m = sketches.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.hll_union_agg("sketch").alias("s"))
    return m.select("column_name", "n_rows", "n_nulls", F.hll_sketch_estimate("s").alias("n_distinct"))
