"""Sources and sinks: S5/S6 snapshot files, S7 skill files, S8 filtered-trace
sink, C3/C4 partitioned writes, S11 named views."""

import json

from pyspark.sql import functions as F

from tests.conftest import make_spans


def test_s5_reads_snapshots_and_drops_corrupt(spark, tmp_path):
    from spanlake.operators.prompts import read_snapshots
    good = {"session_id": "s1", "git_sha": "abc", "git_dirty": "false", "claude_md_hash": "h",
            "claude_md_content": "x", "skills_hash": "none", "skills_prompts": {}, "prompt_name": None,
            "prompt_version": None, "snapshot_timestamp": "2024-01-01T00:00:00+00:00"}
    (tmp_path / "env_s1.json").write_text(json.dumps(good) + "\n")
    (tmp_path / "env_s2.json").write_text("{not json\n")
    got = read_snapshots(spark, str(tmp_path)).collect()
    assert [r.session_id for r in got] == ["s1"]


def test_s6_s5_round_trip(spark, tmp_path):
    from spanlake.operators.prompts import read_snapshots, write_snapshots
    from spanlake.schema import SNAPSHOT
    row = ("s1", "abc", "true", "h", "c", "k", {"a/SKILL.md": "x"}, "p", 2, "2024-01-03T04:05:06+00:00")
    df = spark.createDataFrame([row], SNAPSHOT)
    write_snapshots(df, str(tmp_path / "snaps"))
    back = read_snapshots(spark, str(tmp_path / "snaps")).collect()[0]
    assert back.session_id == "s1" and back.prompt_version == 2 and back.skills_prompts == {"a/SKILL.md": "x"}


def test_s7_skill_scan_hash(spark, tmp_path):
    import hashlib
    from spanlake.operators.prompts import scan_skill_files, skills_hash
    root = tmp_path / "proj" / "skills"
    for name, body in (("beta", "B\r\nline"), ("alpha", "A")):
        (root / name).mkdir(parents=True)
        (root / name / "SKILL.md").write_bytes(body.encode())
    (root / "alpha" / "notes.md").write_text("ignored")
    (root / "bad").mkdir()
    (root / "bad" / "SKILL.md").write_bytes(b"\xff\xfe\xfa")
    parts = scan_skill_files(spark, [("skills", f"file:{root}"), ("dup", str(root)), ("gone", str(root / "none"))])
    got = sorted((r.key, r.content) for r in parts.collect())
    assert got == [("skills/alpha/SKILL.md", "A"), ("skills/beta/SKILL.md", "B\nline")]
    h = skills_hash(parts.withColumn("project", F.lit("p"))).collect()[0].skills_hash
    want = hashlib.sha256("skills/alpha/SKILL.md\nA\0skills/beta/SKILL.md\nB\nline".encode()).hexdigest()
    assert h == want


def test_s8_filtered_trace_sink(spark, tmp_path):
    from spanlake.operators.filtering import filter_and_create_traces, requests_frame, write_filtered_traces
    spans = make_spans(spark, [
        {"trace_id": "a", "span_id": "r", "span_name": "keep"},
        {"trace_id": "a", "span_id": "c", "span_name": "keep", "parent_span_id": "r"},
        {"trace_id": "a", "span_id": "d", "span_name": "drop", "parent_span_id": "r"},
    ])
    new = filter_and_create_traces(spans, requests_frame(spark, ["a"]), ["keep"], experiment_id="9")
    write_filtered_traces(new, str(tmp_path / "out"))
    from spanlake.sources.spans import read_spans
    back = read_spans(spark, str(tmp_path / "out"))
    rows = {r.span_name + str(r.parent_span_id is None): r for r in back.collect()}
    assert back.count() == 2 and {r.experiment_id for r in back.collect()} == {"9"}
    root = [r for r in back.collect() if r.parent_span_id is None][0]
    child = [r for r in back.collect() if r.parent_span_id is not None][0]
    assert child.parent_span_id == root.span_id and child.trace_id == root.trace_id


def test_c3_c4_partitioned_writes(spark, tmp_path):
    import datetime as dt
    from spanlake.operators.monitoring import write_partitioned, write_retention
    spans = make_spans(spark, [{"span_id": f"s{i}", "timestamp": dt.datetime(2024, 1, 1 + i)} for i in range(10)])
    write_partitioned(spans, str(tmp_path / "p"))
    assert sorted(p.name for p in (tmp_path / "p").iterdir() if p.name.startswith("span_date="))[0] == "span_date=2024-01-01"
    write_retention(spans, str(tmp_path / "live"), str(tmp_path / "arch"), "2024-01-11 00:00:00", days=7)
    assert spark.read.parquet(str(tmp_path / "live")).count() == 7
    assert spark.read.parquet(str(tmp_path / "arch")).count() == 3


def test_s11_views(spark):
    from spanlake.operators.dashboards import register_views
    spans = make_spans(spark, [{"span_id": "a"}, {"span_id": "b", "parent_span_id": "a", "status": "ERROR"}])
    names = register_views(spans, "2024-01-05", prefix="t_")
    assert spark.table("t_trace_lineage").filter("span_id = 'b'").collect()[0].parent_span_name == "n0"
    assert spark.table("t_error_traces").count() == 1 and len(names) == 4


def test_s5_session_from_file_name(spark, tmp_path):
    from spanlake.operators.prompts import read_snapshots
    (tmp_path / "env_abc.json").write_text(json.dumps({"git_sha": "none"}) + "\n")
    assert [r.session_id for r in read_snapshots(spark, str(tmp_path)).collect()] == ["abc"]


def test_s4_bad_lines_belong_to_the_session_before_them(spark, tmp_path):
    """A shared file of many sessions, read in splits of a few lines: only the
    sessions with a bad line inside are marked."""
    from spanlake.operators.sessions import read_transcripts, skip_decisions
    call = "Base directory for this skill: /a/tag-trace"
    line = lambda s: json.dumps({"type": "user", "sessionId": s, "message": {"role": "user", "content": call}})
    lines, marked = ["{bad at the start"], set()
    for k in range(200):
        lines += [line(f"s{k}"), json.dumps({"type": "user", "message": {"role": "user", "content": call}}).replace("user\", \"m", "system\", \"m")]
        if k % 9 == 0:
            lines += ["", "{cut off", "   ", "also bad"]
            marked.add(f"s{k}")
    (tmp_path / "shared.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "alone.jsonl").write_text("not json\n" + json.dumps({"type": "user", "message": {"content": call}}) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        entries = read_transcripts(spark, str(tmp_path))
        assert entries.rdd.getNumPartitions() > 20
        bad = {r.session_id: r.n for r in entries.filter("NOT parse_ok").groupBy("session_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert bad == {**dict.fromkeys(marked, 2), "shared": 1, "alone": 1}
        got = {r.session_id: r.skipped for r in skip_decisions(entries).collect()}
        assert {s for s, skipped in got.items() if skipped} == {f"s{k}" for k in range(200)} - marked
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_prompts_hash_equals_the_grouped_digest(spark):
    from spanlake.operators.prompts import prompts_hash, skills_hash
    files = {"b/SKILL.md": "B\n", "a/SKILL.md": "\u00e9", "a/x/SKILL.md": ""}
    df = spark.createDataFrame([("p", files), ("none", {})], "project string, prompts map<string,string>")
    got = {r.project: r.h for r in df.select("project", prompts_hash(F.col("prompts")).alias("h")).collect()}
    parts = spark.createDataFrame([("p", k, v) for k, v in files.items()], "project string, key string, content string")
    assert got == {"p": skills_hash(parts).first().skills_hash, "none": "none"}
