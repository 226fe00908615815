"""Explicit tags and feedback in one order."""

from spanlake.operators import annotations as A

FEEDBACK = [("t1", "quality", "good", 1000), ("t2", "quality", "poor", 1000), ("t3", "quality", "good", 1000), ("t4", "quality", "good", 1000)]
# A tag's sequence number is no time: t1's is far above, t2's far below the feedback's time.
TAGS = [("t1", 9_999_999, "feedback_quality", "poor", 500), ("t2", 1, "feedback_quality", "good", 2000),
        ("t3", 1, "feedback_quality", "poor", 1000), ("t4", 9_999_999, "feedback_quality", "poor", None), ("t4", 5, "k", "old", 1), ("t4", 4, "k", "new", 2)]


def logs(spark):
    return (spark.createDataFrame(TAGS, "trace_id string, seq long, key string, value string, write_ms long"),
            spark.createDataFrame(FEEDBACK, "trace_id string, name string, value string, create_ms long"))


def latest(log):
    return {(r["trace_id"], r["key"]): r["value"] for r in A.latest_tag_values(log).collect()}


def test_later_write_wins_by_time(spark):
    got = latest(A.tag_writes(*logs(spark)))
    assert got == {("t1", "feedback_quality"): "good", ("t2", "feedback_quality"): "good", ("t3", "feedback_quality"): "poor",
                   ("t4", "feedback_quality"): "good", ("t4", "k"): "new", **{(f"t{i}", "has_feedback"): "true" for i in range(1, 5)}}


def test_tags_without_time_come_first(spark):
    tags, feedback = logs(spark)
    got = latest(A.tag_writes(tags.drop("write_ms"), feedback))
    assert [got[f"t{i}", "feedback_quality"] for i in range(1, 5)] == ["good", "poor", "good", "good"]
    assert got["t4", "k"] == "old"


def test_counts_follow_the_order(spark):
    tags, feedback = logs(spark)
    traces = spark.createDataFrame([(f"t{i}",) for i in range(1, 6)], "trace_id string")
    assert tuple(A.feedback_search_counts(traces, tags, feedback).first()) == (4, 3, 1, 5)
    assert tuple(A.feedback_search_counts(traces, tags.limit(0), feedback.limit(0)).first()) == (0, 0, 0, 5)
