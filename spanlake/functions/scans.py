"""Ordered scans per key that do not put a hot key in one task.

A window `partitionBy(key).orderBy(t)` sends every row of a key to a single
task. When one key can hold a large share of the data, these helpers split
the key by a bucket that is monotone in the order (e.g. the hour or day of the
timestamp): the row-level window runs per (key, bucket), a one-row-per-bucket
summary is combined by a small window over buckets, and a join on
(key, bucket) adds the offsets back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["bucketed_row_number", "change_versions", "bucketed_lead", "grouped_percentiles"]


def bucketed_row_number(df: DataFrame, key: str, order: list[str], bucket: Column, out: str = "seq") -> DataFrame:
    """row_number() over (partition by key order by `order`), computed per
    (key, bucket) plus the row count of the key's earlier buckets.
    `bucket` must not decrease along `order` within a key."""
    w = Window.partitionBy(key, "_b").orderBy(*order)
    x = df.withColumn("_b", bucket).withColumn("_r", F.row_number().over(w))
    counts = x.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(key).orderBy("_b")
    counts = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (x.join(counts.select(key, "_b", "_off"), [key, "_b"])
            .withColumn(out, (F.col("_off") + F.col("_r")).cast("int")).drop("_b", "_r", "_off"))


def change_versions(df: DataFrame, key: str, order: list[str], value: str,
                    bucket: Column, out: str = "version") -> DataFrame:
    """Running count of value changes per key in `order` (gaps and islands):
    a row opens a new version iff its value differs from the previous row's.

    (1) lag and running count inside (key, bucket); (2) per-bucket first/last
    value and change count (a partial aggregate); (3) a window over the bucket
    rows of a key gives each bucket its offset and whether its first row
    changes; (4) join back. Adds `out` (int) and `is_new_version`.
    """
    w = Window.partitionBy(key, "_b").orderBy(*order)
    x = (df.withColumn("_b", bucket)
         .withColumn("_prev", F.lag(value).over(w)))
    x = x.withColumn("_chg", F.when(F.col("_prev").isNull(), F.lit(0))
                     .otherwise((F.col(value) != F.col("_prev")).cast("int")))
    x = x.withColumn("_cum", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ordk = F.struct(*order)
    summ = x.groupBy(key, "_b").agg(F.min_by(value, ordk).alias("_first"), F.max_by(value, ordk).alias("_last"),
                                     F.sum("_chg").alias("_n"))
    wb = Window.partitionBy(key).orderBy("_b")
    prev_last = F.lag("_last").over(wb)
    summ = summ.withColumn("_fchg", F.when(prev_last.isNull(), F.lit(1))
                           .otherwise((F.col("_first") != prev_last).cast("int")))
    summ = summ.withColumn("_base", F.coalesce(
        F.sum(F.col("_fchg") + F.col("_n")).over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = x.join(summ.select(key, "_b", "_fchg", "_base"), [key, "_b"])
    ver = (F.col("_base") + F.col("_fchg") + F.col("_cum")).cast("int")
    new = F.when(F.col("_prev").isNull(), F.col("_fchg") == 1).otherwise(F.col("_chg") == 1)
    return j.withColumn(out, ver).withColumn("is_new_version", new) \
            .drop("_b", "_prev", "_chg", "_cum", "_fchg", "_base")


def bucketed_lead(df: DataFrame, key: str, order: list[str], cols: list[str], bucket: Column,
                  prefix: str = "next_") -> DataFrame:
    """lead(c, 1) over (partition by key order by `order`) for each c in `cols`,
    computed per (key, bucket); the last row of a bucket takes the first row
    of the key's next non-empty bucket (a partial `min_by` per bucket and a
    window over the few bucket rows of a key). `bucket` must not decrease
    along `order` within a key. Adds `prefix + c` columns."""
    w = Window.partitionBy(key, "_b").orderBy(*order)
    x = df.withColumn("_b", bucket)
    for c in cols:
        x = x.withColumn(prefix + c, F.lead(c).over(w))
    x = x.withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    firsts = x.groupBy(key, "_b").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
    firsts = firsts.withColumn("_next_first", F.lead("_first").over(Window.partitionBy(key).orderBy("_b")))
    j = x.join(firsts.select(key, "_b", "_next_first"), [key, "_b"])
    for c in cols:
        j = j.withColumn(prefix + c, F.when(F.col("_last"), F.col("_next_first")[c]).otherwise(F.col(prefix + c)))
    return j.drop("_b", "_last", "_next_first")


def grouped_percentiles(df: DataFrame, group: str, value: str, probs: dict[str, float], count: str | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation per group, as `percentile`
    gives them; null values are left out, a null group is a group. With `count`
    a row stands for so many equal rows.

    Counts per (group, value) are partial aggregates. Ranks come from running
    counts inside (group, bucket) plus the counts of the group's lower buckets;
    the bucket is logarithmic in the value, so a group has a few thousand
    buckets at most and no task holds all distinct values of a group.
    Returns `group` and one double column per alias of `probs`."""
    v = F.col("_v")
    size = F.floor(F.log2(F.abs(v) + F.lit(1.0)) * F.lit(64.0))
    bucket = F.when(v < 0, -size).otherwise(size)
    weight = F.lit(1) if count is None else F.col(count)
    # a struct key: equal also where the group is null
    rows = df.select(F.struct(F.col(group).alias("g")).alias("_g"), F.col(value).cast("double").alias("_v"), weight.alias("_w"))
    # one exchange by (group, bucket) serves the cells, the running counts and the join
    hist = (rows.filter(v.isNotNull()).withColumn("_b", bucket)
            .groupBy("_g", "_b", "_v").agg(F.sum("_w").alias("_c")).repartition("_g", "_b"))
    below = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cells = (hist.groupBy("_g", "_b").agg(F.sum("_c").alias("_n"))
             .select("_g", "_b", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"),
                     F.sum("_n").over(Window.partitionBy("_g")).alias("_total")))
    inside = Window.partitionBy("_g", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (hist.withColumn("_run", F.sum("_c").over(inside)).join(cells, ["_g", "_b"])
              .withColumn("_to", F.col("_before") + F.col("_run")).withColumn("_from", F.col("_to") - F.col("_c")))
    picks, out = [F.max("_total").alias("_total")], []
    for i, (alias, p) in enumerate(probs.items()):
        at = (F.col("_total") - 1).cast("double") * F.lit(float(p))
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), v)).alias(f"_{end}{i}"))
        out.append(F.when(F.floor(at) == F.ceil(at), F.col(f"_lo{i}"))
                   .otherwise((F.ceil(at) - at) * F.col(f"_lo{i}") + (at - F.floor(at)) * F.col(f"_hi{i}")).alias(alias))
    return ranked.groupBy("_g").agg(*picks).select(F.col("_g.g").alias(group), *out)
