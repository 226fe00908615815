"""Stored sketches: a day is replaced alone, ranges merge, errors stay in bounds."""

import datetime as dt

from pyspark.sql import functions as F

from spanlake.operators import sketches as K
from tests.conftest import make_spans


def spans(spark, day, n, factor=1):
    start = 1_700_000_000_000
    return make_spans(spark, [{"span_id": f"d{day}s{i}", "span_type": "A" if i % 3 else "B", "start_time_ms": start, "end_time_ms": start + factor * (i * i % 997),
                               "timestamp": dt.datetime(2024, 1, day, i % 24)} for i in range(n)])


def test_days_are_replaced_and_merged(spark, tmp_path):
    path, probs = str(tmp_path / "s"), {"p50": 0.5, "p99": 0.99}
    first, second, again = spans(spark, 1, 900), spans(spark, 2, 600), spans(spark, 2, 1200, factor=7)
    for s in (first, second, again):
        K.write_days(K.duration_sketches(s), path)
    both = first.unionByName(again)
    stored = K.read_days(spark, path)
    est = K.merged_percentiles(stored, probs)
    assert {r.span_type: r.n for r in est.collect()} == {"A": 1400, "B": 700}
    errors = K.rank_errors(both, est, probs).collect()
    assert len(errors) == 2 and all(r[a] <= K.RANK_BOUND for r in errors for a in probs)
    one = K.merged_percentiles(K.read_days(spark, path, "2024-01-01", "2024-01-01"), probs)
    assert {r.span_type: r.n for r in one.collect()} == {"A": 600, "B": 300}
    wrong = est.withColumn("p50", F.col("p50") * 3)
    assert max(r.p50 for r in K.rank_errors(both, wrong, probs).collect()) > K.RANK_BOUND


def test_distinct_estimates(spark, tmp_path):
    path = str(tmp_path / "d")
    for s in (spans(spark, 1, 3000), spans(spark, 2, 2000), spans(spark, 2, 3000)):
        K.write_days(K.distinct_sketches(s, ["span_id", "span_type", "parent_span_id"]), path)
    got = {r.column_name: r for r in K.approx_distinct(K.read_days(spark, path)).collect()}
    assert abs(got["span_id"].n_distinct - 6000) <= 6000 * K.HLL_BOUND
    assert got["span_type"].n_distinct == 2 and got["parent_span_id"].n_distinct == 0 and got["parent_span_id"].n_nulls == 6000
