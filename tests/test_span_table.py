"""The versioned span table: versions, change feed, folds and writers that die."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from spanlake.sources.span_table import AFTER, BEFORE, DELETE, INSERT, SpanTable, move
from tests.conftest import make_spans


def spans(spark, *ids, trace="t"):
    return make_spans(spark, [{"trace_id": trace, "span_id": i, "timestamp": dt.datetime(2024, 1, 1 + k)} for k, i in enumerate(ids)]).coalesce(1)


def ids(df):
    return sorted(r.span_id for r in df.collect())


def test_versions_and_change_feed(spark, tmp_path):
    t = SpanTable(spark, str(tmp_path / "t"))
    assert t.version() == 0 and t.read().count() == 0
    assert t.append(spans(spark, "a", "b")) == 1
    assert t.append(spans(spark, "c", trace="u").withColumn("tags", F.create_map(F.lit("k"), F.lit("old")))) == 2
    tags = lambda v: spark.createDataFrame([("u", "k", v), ("none", "k", "x")], "trace_id string, key string, value string")
    assert t.upsert_tags(tags("new")) == 3
    assert t.upsert_tags(tags("new")) == 4                       # nothing differs: a version without rows
    assert t.delete(F.col("span_id") == "a") == 5
    assert t.append(spans(spark, "a")) == 6                      # back again
    for _ in range(2):
        assert ids(t.read(2)) == ids(t.read(4)) == ["a", "b", "c"] and ids(t.read(5)) == ["b", "c"] and ids(t.read()) == ["a", "b", "c"]
        assert [r.tags for r in t.read(2).filter("span_id = 'c'").collect()] == [{"k": "old"}]
        assert [r.tags for r in t.read().filter("span_id = 'c'").collect()] == [{"k": "new"}]
        feed = sorted((r.version, r.change, r.span_id, r.tags.get("k")) for r in t.changes(2, 6).collect())
        assert feed == [(3, AFTER, "c", "new"), (3, BEFORE, "c", "old"), (5, DELETE, "a", None), (6, INSERT, "a", None)]
        t.fold()                                                 # changes no answer
    t.append(spans(spark, "d"))
    t.fold()
    t.vacuum(0)
    assert ids(t.read()) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="vacuumed"):
        t.changes(2)
    with pytest.raises(ValueError, match="no version|vacuumed"):
        t.read(3)


def test_fifty_batches_leave_few_files(spark, tmp_path):
    t = SpanTable(spark, str(tmp_path / "t"))
    for k in range(50):
        t.append(spans(spark, f"s{k:02d}"), batch=k)
        if k % 8 == 7:
            t.vacuum(1)
            t.fold()
    assert ids(t.read()) == [f"s{k:02d}" for k in range(50)] and t.batch() == 49
    files = [f for d, _, names in os.walk(tmp_path) for f in names if f.endswith((".parquet", ".json"))]
    assert len(files) < 45
    base, later = t._state()
    assert len(base["folders"]) <= 4 and len(later) == 2


def test_writers_that_die_change_nothing(spark, tmp_path, monkeypatch):
    t = SpanTable(spark, str(tmp_path / "t"))
    t.append(spans(spark, "a"))
    t.append(spans(spark, "b"))

    def die(name, entry):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(t, "_publish", die)                            # the folder is written, the entry is not
        for job in (t.fold, lambda: t.append(spans(spark, "c")), lambda: t.delete(F.lit(True))):
            with pytest.raises(OSError, match="gone"):
                job()
    assert ids(t.read()) == ["a", "b"] and t.version() == 2
    t.fold()
    with monkeypatch.context() as m:                             # a vacuum that stops after the entries
        m.setattr(t, "_fs", type("Fs", (), {"exists": t._fs.exists, "listStatus": t._fs.listStatus, "open": t._fs.open,
                                            "delete": lambda self, path, deep: deep or SpanTable(spark, t.path)._fs.delete(path, deep)})())
        t.vacuum(0)
    assert ids(SpanTable(spark, t.path).read()) == ["a", "b"]


def test_two_writers_cannot_make_one_version(spark, tmp_path):
    one, two = (SpanTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.append(spans(spark, "a"))
    two.version = lambda: 0                                      # has not seen it
    with pytest.raises(Exception, match="(?i)exists"):
        two.append(spans(spark, "b"))
    assert ids(one.read()) == ["a"]


def test_a_move_that_was_cut_off_is_finished(spark, tmp_path):
    live, archive = (SpanTable(spark, str(tmp_path / d)) for d in ("live", "archive"))
    live.append(spans(spark, "a", "b", "c"))
    old = F.col("timestamp") < F.lit("2024-01-03").cast("timestamp_ntz")
    archive.append(live.read().drop("version").filter(old), 1)   # and then the job died
    move(live, archive, old, 1)
    assert ids(live.read()) == ["c"] and ids(archive.read()) == ["a", "b"]
    live.append(spans(spark, "d"))
    move(live, archive, old, 2)
    assert ids(live.read()) == ["c"] and ids(archive.read()) == ["a", "b", "d"]
    live.append(spans(spark, "e"))
    with pytest.raises(RuntimeError, match="not in the archive"):
        move(live, archive, old, 2)                              # an id that was used: nothing is deleted
    assert ids(live.read()) == ["c", "e"]


def test_an_update_joins_keys_and_regroups_no_rows(spark, tmp_path):
    t = SpanTable(spark, str(tmp_path / "t"))
    t.append(spans(spark, "a", "b"))
    t.delete(F.col("span_id") == "a")
    plan = t.read()._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert len(aggregates) == 1 and "inputs" not in aggregates[0]


def test_a_fold_shuffles_no_rows(spark, tmp_path, monkeypatch):
    t = SpanTable(spark, str(tmp_path / "t"))
    t.append(spans(spark, "a", "b"))
    t.append(spans(spark, "c"))
    written, folder = [], SpanTable._folder
    monkeypatch.setattr(SpanTable, "_folder", lambda self, rows: written.append(rows) or folder(self, rows))
    t.fold()
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert "Sort" in plan and "Exchange" not in plan
    assert ids(t.read()) == ["a", "b", "c"]
