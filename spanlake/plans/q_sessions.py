"""Registered session / environment / prompt queries: S4-S6, E1-E10, J4-J6, W2, A9."""

from pyspark.sql import functions as F

from spanlake.operators import prompts as P
from spanlake.operators import sessions as SS
from spanlake.operators.annotations import search_by_tag
from spanlake.operators.lineage import most_recent_session_trace, trace_summary, trace_tags
from spanlake.plans.fixture_sql import with_tables
from spanlake.plans.q_lineage import ROOT_CTE
from spanlake.plans.registry import query, spans, table
from spanlake.sources.fixtures import derived_folder, file_table

LAST_CTE = r"""
last AS (SELECT session_id, arg_max(text, ord) FILTER (WHERE type = 'user' AND NOT is_tool_result) AS last_text,
  count(*) FILTER (WHERE type = 'user' AND NOT is_tool_result) AS n_qual FROM transcripts GROUP BY session_id),
ls AS (SELECT session_id, n_qual, regexp_replace(last_text, '^\s+', '') AS t FROM last),
nm AS (SELECT session_id, CASE WHEN n_qual > 0 AND starts_with(t, 'Base directory for this skill:') THEN
  string_split(regexp_replace(substr(split_part(t, chr(10), 1), 31), '^\s+|\s+$', '', 'g'), '/')[-1] END AS skill_name
  FROM ls)"""
E1_SQL = "SELECT session_id, skill_name, coalesce(skill_name IN ('feedback-trace', 'tag-trace'), false) AS skipped FROM nm"


@query("e1_skip_filter", with_tables(E1_SQL, "transcripts", extra=LAST_CTE))
def e1(spark, sf):
    return SS.skip_decisions(table(spark, sf, "transcripts"))


S4_SQL = """SELECT session_id, skill_name, coalesce(skill_name IN ('feedback-trace', 'tag-trace'), false)
 AND CAST(substr(session_id, 6) AS BIGINT) % 7 <> 0 AS skipped FROM nm"""      # every seventh session has a bad line


@query("s4_transcript_reader", with_tables(S4_SQL, "transcripts", extra=LAST_CTE))
def s4(spark, sf):
    return SS.skip_decisions(SS.read_transcripts(spark, file_table(spark, sf, "transcripts_jsonl"), glob=None))


@query("w2_last_user_entry", with_tables("SELECT session_id, last_text FROM last WHERE n_qual > 0", "transcripts",
                                         extra=LAST_CTE))
def w2(spark, sf):
    t = table(spark, sf, "transcripts")
    q = t.filter((F.col("type") == "user") & ~F.col("is_tool_result"))
    return q.groupBy("session_id").agg(F.max_by("text", "ord").alias("last_text"))


SUMMARY_SESSION = ROOT_CTE
LATEST_CTE = SUMMARY_SESSION + """,
latest AS (SELECT session_id, trace_id, timestamp_ms FROM
  (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY timestamp_ms DESC, trace_id) AS rn FROM summary
   WHERE session_id IS NOT NULL) WHERE rn = 1)"""


@query("j4_latest_trace_per_session", with_tables("SELECT * FROM latest", "spans", extra=LATEST_CTE))
def j4(spark, sf):
    return SS.latest_trace_per_session(SS.session_traces(spans(spark, sf)))


VERSIONS_CTE = """
ne AS (SELECT *, lag(instructions) OVER (PARTITION BY project ORDER BY snapshot_ms, session_id) AS prev
  FROM env_snapshots WHERE instructions <> ''),
ch AS (SELECT *, CASE WHEN prev IS NULL OR prev <> instructions THEN 1 ELSE 0 END AS changed FROM ne),
vv AS (SELECT session_id, snapshot_ms, changed, CAST(sum(changed) OVER (PARTITION BY project ORDER BY snapshot_ms, session_id
  ROWS UNBOUNDED PRECEDING) AS INT) AS prompt_version FROM ch),
versions AS (SELECT e.*, v.prompt_version, coalesce(v.changed = 1, false) AS is_new_version,
  CASE WHEN v.prompt_version IS NOT NULL THEN 'main.default.claude_md.' || e.project END AS prompt_name,
  CASE WHEN e.git_sha IS NOT NULL AND e.git_sha <> 'none' THEN 'git:' || substr(e.git_sha, 1, 8) ELSE 'no-git' END
   AS commit_message
  FROM env_snapshots e LEFT JOIN vv v ON e.session_id = v.session_id AND e.snapshot_ms = v.snapshot_ms)"""


def _versions(spark, sf):
    return P.assign_prompt_versions(table(spark, sf, "env_snapshots"))


@query("e7_prompt_versions", with_tables("""
SELECT session_id, snapshot_ms, project, prompt_name, prompt_version, is_new_version, commit_message FROM versions""",
    "env_snapshots", extra=VERSIONS_CTE))
def e7(spark, sf):
    return _versions(spark, sf).select("session_id", "snapshot_ms", "project", "prompt_name", "prompt_version",
                                       "is_new_version", "commit_message")


def _enrich(spark, sf):
    """E1 -> E5 -> E2/E3. A transcript is as of its session's latest Stop, so
    that is the Stop which a skip decision takes out."""
    env = _versions(spark, sf).withColumnRenamed("instructions_hash", "claude_md_hash").drop("instructions", "skills_prompts")
    traces = SS.session_traces(spans(spark, sf))
    skips = SS.skip_decisions(table(spark, sf, "transcripts")).filter("skipped").select("session_id")
    skipped = SS.latest_trace_per_session(traces).join(skips, "session_id").select("trace_id")
    return SS.enrich_traces(traces, env, skipped)


def _enriched(spark, sf):
    """The enriched traces, written once per data folder for what builds on them."""
    return derived_folder(spark, sf, "enriched", lambda: _enrich(spark, sf)[0])


ENRICH_CTE = LATEST_CTE + "," + LAST_CTE + "," + VERSIONS_CTE + """,
stops AS (SELECT s.* FROM summary s WHERE s.session_id IS NOT NULL AND s.trace_id NOT IN
  (SELECT l.trace_id FROM latest l JOIN nm ON nm.session_id = l.session_id
   WHERE nm.skill_name IN ('feedback-trace', 'tag-trace'))),
used AS (SELECT v.*, (SELECT arg_min(s.trace_id, (s.timestamp_ms, s.trace_id)) FROM stops s
   WHERE s.session_id = v.session_id AND s.timestamp_ms >= v.snapshot_ms
    AND NOT EXISTS (SELECT 1 FROM env_snapshots n WHERE n.session_id = v.session_id
     AND n.snapshot_ms > v.snapshot_ms AND n.snapshot_ms <= s.timestamp_ms)) AS trace_id FROM versions v),
enriched AS (SELECT v.session_id, v.trace_id, coalesce(v.git_sha, 'none') AS git_sha,
  coalesce(v.git_dirty, 'none') AS git_dirty, coalesce(v.instructions_hash, 'none') AS claude_md_hash,
  coalesce(v.skills_hash, 'none') AS skills_hash,
  strftime(make_timestamp(v.snapshot_ms * 1000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS snapshot_timestamp,
  v.prompt_name, v.prompt_version,
  CASE WHEN v.prompt_name IS NOT NULL AND v.prompt_name <> '' AND v.prompt_version IS NOT NULL
       AND v.prompt_version <> 0 THEN 'prompts:/' || v.prompt_name || '/' || v.prompt_version END AS prompt_uri
  FROM used v WHERE v.trace_id IS NOT NULL)"""


@query("e2_env_enrichment", with_tables("""
SELECT session_id, trace_id, git_sha, git_dirty, claude_md_hash, skills_hash, snapshot_timestamp FROM enriched""",
    "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def e2(spark, sf):
    enriched, _ = _enrich(spark, sf)
    return enriched.select("session_id", "trace_id", "git_sha", "git_dirty", "claude_md_hash", "skills_hash",
                           "snapshot_timestamp")


@query("e3_prompt_uri", with_tables("SELECT trace_id, prompt_uri FROM enriched", "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def e3(spark, sf):
    enriched, _ = _enrich(spark, sf)
    return enriched.select("trace_id", "prompt_uri")


@query("j5_unmatched_snapshots", with_tables("SELECT session_id, snapshot_ms FROM used WHERE trace_id IS NULL",
                                             "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def j5(spark, sf):
    _, unmatched = _enrich(spark, sf)
    return unmatched.select("session_id", "snapshot_ms")


COMPANION_SQL = """
SELECT 'tr-env-' || substr(sha256('env_snapshot|' || trace_id), 1, 32) AS companion_trace_id, session_id,
 trace_id AS session_trace_id, git_sha, claude_md_hash, prompt_uri, 'env_snapshot' AS companion_type
FROM enriched WHERE prompt_uri IS NOT NULL"""


@query("e4_companion_traces", with_tables(COMPANION_SQL, "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def e4(spark, sf):
    enriched = _enriched(spark, sf)
    return SS.companion_traces(enriched)


@query("j6_companion_crossref", with_tables(f"""
SELECT c.session_trace_id AS trace_id, c.companion_trace_id AS snapshot_trace_id, e.session_id
FROM ({COMPANION_SQL}) c JOIN enriched e ON e.trace_id = c.session_trace_id""",
    "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def j6(spark, sf):
    enriched = _enriched(spark, sf)
    comp = SS.companion_traces(enriched)
    return comp.join(enriched.select(F.col("trace_id").alias("session_trace_id"), "session_id"),
                     ["session_trace_id", "session_id"]) \
               .select(F.col("session_trace_id").alias("trace_id"),
                       F.col("companion_trace_id").alias("snapshot_trace_id"), "session_id")


COMPANION_TAGS_SQL = f"""
SELECT companion_trace_id AS trace_id, 'cc_env.type' AS key, 'env_snapshot' AS value FROM ({COMPANION_SQL})
UNION ALL SELECT companion_trace_id, 'cc_env.session_id', session_id FROM ({COMPANION_SQL})
UNION ALL SELECT companion_trace_id, 'cc_env.session_trace_id', session_trace_id FROM ({COMPANION_SQL})
UNION ALL SELECT session_trace_id, 'cc_env.snapshot_trace_id', companion_trace_id FROM ({COMPANION_SQL})"""
COMPANION_SPANS_SQL = f"""
SELECT c.companion_trace_id AS trace_id, greatest(s.timestamp_ms, coalesce(s.end_time_ms, s.timestamp_ms)) AS start_time_ms,
 s.experiment_id, '{{"session_id":"' || c.session_id || '","session_trace_id":"' || c.session_trace_id || '","git_sha":"'
 || c.git_sha || '","claude_md_hash":"' || c.claude_md_hash || '"}}' AS outputs
FROM ({COMPANION_SQL}) c JOIN summary s ON s.trace_id = c.session_trace_id"""


def _store_with_companions(spark, sf):
    """(spans, tag log) after the enrichment: companions are traces, tags are writes."""
    s = spans(spark, sf)
    enriched = _enriched(spark, sf)
    comp = SS.companion_traces(enriched)
    found = SS.companion_spans(comp, trace_summary(s, with_payload=False, with_session=False))
    written = SS.enrichment_tag_rows(enriched).unionByName(SS.companion_tag_rows(comp))
    log = table(spark, sf, "tag_log").select("trace_id", "seq", "key", "value").unionByName(written)
    return s.unionByName(found), log, found, comp


@query("e4_companion_spans", with_tables(f"""
SELECT 'rq-' || trace_id AS request_id, trace_id, 'sp-' || trace_id AS span_id, 'env_snapshot' AS span_name,
 'UNKNOWN' AS span_type, start_time_ms, start_time_ms AS end_time_ms, 'OK' AS status, experiment_id, outputs,
 make_timestamp(start_time_ms * 1000) AS timestamp FROM ({COMPANION_SPANS_SQL})""",
    "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def e4_spans(spark, sf):
    _, _, found, _ = _store_with_companions(spark, sf)
    return found.select("request_id", "trace_id", "span_id", "span_name", "span_type", "start_time_ms", "end_time_ms",
                        "status", "experiment_id", "outputs", "timestamp")


@query("e4_companion_tags", with_tables(COMPANION_TAGS_SQL, "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def e4_tags(spark, sf):
    _, _, _, comp = _store_with_companions(spark, sf)
    return SS.companion_tag_rows(comp).drop("seq")


@query("e2_search_by_env_tag", with_tables("SELECT DISTINCT trace_id FROM enriched WHERE git_dirty = 'true'",
                                           "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def e2_search(spark, sf):
    """F6 over tags that the enrichment wrote to the log."""
    store, log, _, _ = _store_with_companions(spark, sf)
    return search_by_tag(trace_tags(store, log), "cc_env.git_dirty", "true").select("trace_id")


@query("t7_excludes_companions", with_tables(f"""
SELECT trace_id FROM summary WHERE trace_id NOT IN (SELECT companion_trace_id FROM ({COMPANION_SQL}))
ORDER BY timestamp_ms DESC, trace_id LIMIT 1""", "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def t7_companions(spark, sf):
    """T7 over a store that holds companion traces, tagged through the log."""
    store, log, _, _ = _store_with_companions(spark, sf)
    return most_recent_session_trace(store, log)


@query("e5_consume_once", with_tables("""
SELECT session_id, arg_max(snapshot_ms, snapshot_ms) AS snapshot_ms, arg_max(git_sha, snapshot_ms) AS git_sha
FROM env_snapshots GROUP BY session_id""", "env_snapshots"))
def e5(spark, sf):
    return SS.consume_snapshots(table(spark, sf, "env_snapshots")).select("session_id", "snapshot_ms", "git_sha")


@query("e6_instruction_hash", """
SELECT 'sess-' || CAST(doc_id AS VARCHAR) AS session_id,
 CASE WHEN text IS NULL OR text = '' THEN 'none' ELSE sha256(text) END AS claude_md_hash FROM documents""")
def e6(spark, sf):
    """The whole text of each document as a session's instructions."""
    docs = table(spark, sf, "documents")
    return docs.select(F.concat(F.lit("sess-"), F.col("doc_id").cast("string")).alias("session_id"),
                       P.content_hash(F.when(F.col("text") != "", F.col("text"))).alias("claude_md_hash"))


IDS_PER_SNAPSHOT = 400


@query("a9_skills_hash", f"""
SELECT source || '/' || CAST(doc_id // {IDS_PER_SNAPSHOT} AS VARCHAR) AS project,
 sha256(string_agg(CAST(doc_id AS VARCHAR) || chr(10) || text, chr(0) ORDER BY CAST(doc_id AS VARCHAR))) AS skills_hash,
 count(*) AS n_parts
FROM documents GROUP BY 1""")
def a9(spark, sf):
    """Documents stand for skill files; a project snapshot holds a few of them,
    so the groups stay small while their number grows with the table."""
    docs = table(spark, sf, "documents")
    snapshot = F.floor(F.col("doc_id") / F.lit(float(IDS_PER_SNAPSHOT))).cast("string")
    parts = docs.select(F.concat("source", F.lit("/"), snapshot).alias("project"),
                        F.col("doc_id").cast("string").alias("key"), F.col("text").alias("content"))
    return P.skills_hash(parts, groups=parts)


@query("e8_traces_by_commit", with_tables("""
SELECT git_sha, claude_md_hash, count(*) AS n_traces FROM enriched WHERE git_sha <> 'none'
GROUP BY git_sha, claude_md_hash""", "spans", "env_snapshots", "transcripts", extra=ENRICH_CTE))
def e8(spark, sf):
    from spanlake.operators.evaluation import traces_for_commit
    enriched = _enriched(spark, sf)
    return traces_for_commit(enriched)


E9_CTE = """
qv AS (SELECT e.prompt_name, e.prompt_version, s.trace_id, s.error_span_count > 0 AS failed,
  (SELECT arg_max(f.value, f.create_ms) FROM feedback_log f WHERE f.trace_id = s.trace_id AND f.name = 'quality') AS quality
  FROM enriched e JOIN summary s ON s.trace_id = e.trace_id WHERE e.prompt_version IS NOT NULL),
g AS (SELECT prompt_name, prompt_version, count(*) AS n_traces,
  CAST(count(*) FILTER (WHERE failed) AS DOUBLE) / count(*) AS error_rate,
  count(quality) AS n_rated,
  CASE WHEN count(quality) > 0 THEN CAST(count(*) FILTER (WHERE quality = 'good') AS DOUBLE) / count(quality) END AS good_rate
  FROM qv GROUP BY prompt_name, prompt_version)"""


@query("e9_quality_by_version", with_tables("""
SELECT *, error_rate - lag(error_rate) OVER (PARTITION BY prompt_name ORDER BY prompt_version) AS error_rate_delta
FROM g""", "spans", "env_snapshots", "feedback_log", "transcripts", extra=ENRICH_CTE + ",\n" + E9_CTE))
def e9(spark, sf):
    from spanlake.operators.evaluation import quality_by_version
    from spanlake.operators.lineage import trace_summary
    enriched = _enriched(spark, sf)
    s = spans(spark, sf)
    return quality_by_version(enriched, trace_summary(s, with_payload=False, with_session=False), table(spark, sf, "feedback_log"))


E10_RAW = """
raw AS (SELECT session_id, CASE WHEN git_sha = 'none' THEN NULL ELSE git_sha || chr(10) END AS head,
  CASE WHEN git_dirty = 'true' THEN ' M README.md' || chr(10) WHEN git_dirty = 'false' THEN chr(10) END AS porcelain
  FROM env_snapshots)"""


def _raw_git(env):
    return env.select(
        "session_id",
        F.when(F.col("git_sha") == "none", F.lit(None).cast("string")).otherwise(F.concat("git_sha", F.lit("\n")))
        .alias("head"),
        F.when(F.col("git_dirty") == "true", F.lit(" M README.md\n")).when(F.col("git_dirty") == "false", F.lit("\n"))
        .alias("porcelain"))


@query("e10_snapshot_normalise", with_tables(r"""
SELECT session_id, CASE WHEN coalesce(regexp_replace(head, '^\s+|\s+$', '', 'g') <> '', false)
   THEN regexp_replace(head, '^\s+|\s+$', '', 'g') ELSE 'none' END AS git_sha,
 CASE WHEN coalesce(regexp_replace(head, '^\s+|\s+$', '', 'g') <> '', false) THEN
   CASE WHEN coalesce(regexp_replace(porcelain, '^\s+|\s+$', '', 'g') <> '', false) THEN 'true' ELSE 'false' END
   ELSE 'none' END AS git_dirty
FROM raw""", "env_snapshots", extra=E10_RAW))
def e10(spark, sf):
    return P.normalise_snapshot(_raw_git(table(spark, sf, "env_snapshots"))).select("session_id", "git_sha", "git_dirty")


@query("s5_s6_snapshot_files", with_tables("""
SELECT session_id, git_sha, git_dirty, instructions_hash AS claude_md_hash, instructions AS claude_md_content,
 skills_hash, skills_text AS skills_prompts, prompt_name, prompt_version,
 strftime(make_timestamp(snapshot_ms * 1000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS snapshot_timestamp
FROM versions""", "env_snapshots", extra=VERSIONS_CTE))
def s5_s6(spark, sf):
    snaps = P.read_snapshots(spark, file_table(spark, sf, "snapshots_json"))
    prompts = F.array_join(F.transform(F.array_sort(F.map_entries("skills_prompts")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), " | ")
    return snaps.select("session_id", "git_sha", "git_dirty", "claude_md_hash", "claude_md_content", "skills_hash",
                        prompts.alias("skills_prompts"), "prompt_name", "prompt_version", "snapshot_timestamp")


@query("e5_first_stop_after_snapshot", with_tables("""
SELECT session_id, snapshot_ms, CASE WHEN nk = 1 THEN nt END AS trace_id, CASE WHEN nk = 1 THEN nts END AS trace_start_ms
FROM (SELECT *, lead(kind) OVER w AS nk, lead(trace_id) OVER w AS nt, lead(ts) OVER w AS nts
      FROM (SELECT session_id, snapshot_ms AS ts, 0 AS kind, snapshot_ms, CAST(NULL AS VARCHAR) AS trace_id
            FROM env_snapshots
            UNION ALL SELECT session_id, timestamp_ms, 1, NULL, trace_id FROM summary WHERE session_id IS NOT NULL) ev
      WINDOW w AS (PARTITION BY session_id ORDER BY ts, kind, coalesce(trace_id, ''))) l
WHERE kind = 0""", "spans", "env_snapshots", extra=SUMMARY_SESSION))
def e5_first_stop(spark, sf):
    return SS.first_stop_after_snapshot(SS.session_traces(spans(spark, sf)), table(spark, sf, "env_snapshots"))


@query("w5_first_root", """
SELECT path, arg_min(label, ordinal) AS label, min(ordinal) AS ordinal FROM (
 SELECT '/projects/' || coalesce(source, 'none') || '/' || (n_chars % 97) AS path, lang || '-' || doc_id AS label, doc_id AS ordinal FROM documents)
GROUP BY path""")
def w5(spark, sf):
    """Roots as sessions name them, some with a slash too many; the first one named keeps the path."""
    slash = F.when(F.col("doc_id") % 3 == 0, "//").otherwise("/")
    roots = table(spark, sf, "documents").select(
        F.concat(F.lit("/projects"), slash, F.coalesce("source", F.lit("none")), F.lit("/"), F.col("n_chars") % 97, F.when(F.col("doc_id") % 2 == 0, "/").otherwise("")).alias("path"),
        F.concat("lang", F.lit("-"), "doc_id").alias("label"), F.col("doc_id").alias("ordinal"))
    return P.first_per_path(roots)
