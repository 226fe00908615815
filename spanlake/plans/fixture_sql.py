"""DuckDB forms of the derived tables, for the independent SQL oracle.

Each oracle statement starts with ``WITH <table> AS (...)`` for the derived
tables it reads (FIXTURES.md §2; both dialects give equal row sets).
"""

SPANS = """
e AS (SELECT event_id, ts, user_id, event_type, value, props, CAST(json_extract_string(props,'$.k') AS INT) AS k, (epoch_us(ts)//1000) AS ms0,
   concat('tr-',user_id,'-',CAST(floor((dayofmonth(ts)-1)/7.0) AS INT)) AS trace_id FROM events),
s AS (SELECT e.*, row_number() OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS seq FROM e),
p AS (SELECT a.*, b.event_id AS parent_event FROM s a LEFT JOIN s b ON a.trace_id=b.trace_id AND a.seq>1 AND b.seq=CAST(floor(a.seq/2.0) AS INT)),
q AS (SELECT p.*, ms0 + CASE WHEN event_id%97=0 THEN 864000000 ELSE 0 END AS st FROM p),
spans AS (
SELECT concat('rq-',trace_id) AS request_id, trace_id, concat('sp-',event_id) AS span_id,
 concat(event_type,'_',k%4) AS span_name,
 CASE WHEN seq=1 THEN 'WORKFLOW' WHEN event_type='view' THEN 'PREPROCESSING' WHEN event_type='signup' THEN 'FEATURE_ENGINEERING' WHEN event_type='click' THEN 'INFERENCE' WHEN event_type='purchase' THEN 'TRAINING' ELSE 'EVALUATION' END AS span_type,
 CASE WHEN seq=1 THEN NULL WHEN event_id%89=0 THEN concat('sp-missing-',event_id) ELSE concat('sp-',parent_event) END AS parent_span_id,
 st AS start_time_ms, CASE WHEN k=98 THEN NULL ELSE st + CAST(floor(value*100) AS BIGINT) END AS end_time_ms,
 CASE WHEN k<8 THEN 'ERROR' WHEN k=99 THEN NULL ELSE 'OK' END AS status,
 CAST(seq AS INT) AS execution_order, concat('sess-',user_id) AS session_id,
 CAST(k AS VARCHAR) AS attr_k, event_type AS attr_event_type, CAST(k*10+5 AS VARCHAR) AS attr_tokens,
 props AS inputs, concat('{"k2": ',k*2,'}') AS outputs, CAST(user_id%5 AS VARCHAR) AS experiment_id, ts AS timestamp
FROM q)"""

ENV_SNAPSHOTS = """
env_snapshots AS (
SELECT concat('sess-',doc_id//3) AS session_id, source AS project,
 CASE WHEN doc_id%17=0 THEN 'none' ELSE substr(sha256(CAST(CAST(floor(doc_id/10.0) AS INT) AS VARCHAR)),1,40) END AS git_sha,
 CASE WHEN doc_id%17=0 THEN 'none' WHEN doc_id%4=0 THEN 'true' ELSE 'false' END AS git_dirty,
 instructions, CASE WHEN instructions='' THEN 'none' ELSE sha256(instructions) END AS instructions_hash,
 CASE WHEN doc_id%5=0 THEN 'none' ELSE sha256(concat('extra/',source,'/SKILL.md',chr(10),'About ',source,chr(0),'skills/',lang,'/SKILL.md',chr(10),
  'Write in ',lang,chr(10),text)) END AS skills_hash,
 CASE WHEN doc_id%5=0 THEN '' ELSE concat('extra/',source,'/SKILL.md=About ',source,' | skills/',lang,'/SKILL.md=Write in ',lang,chr(10),text) END AS skills_text,
 unnest(CASE WHEN doc_id%7=0 THEN [taken, taken+30000] ELSE [taken] END) AS snapshot_ms
FROM (SELECT *, 1704067200000 + doc_id*60000 + (doc_id%3)*777600000 AS taken,
  CASE WHEN doc_id%13=0 THEN '' WHEN doc_id%2=1 THEN first_value(text) OVER (PARTITION BY source, lang ORDER BY doc_id) ELSE text END AS instructions
 FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents)))"""

TRANSCRIPTS = """
u_last AS (SELECT conv_id, max(turn) AS lu FROM conversations WHERE role='user' GROUP BY conv_id),
transcripts AS (
SELECT concat('sess-',c.conv_id) AS session_id, c.turn AS ord, c.role AS type,
 coalesce(c.role='user' AND c.turn=u_last.lu AND c.conv_id%5=3, false) AS is_tool_result,
 CASE WHEN c.role='user' AND c.turn=u_last.lu AND c.conv_id%5=0 THEN concat('Base directory for this skill: /opt/skills/feedback-trace', chr(10), c.text)
  WHEN c.role='user' AND c.turn=u_last.lu AND c.conv_id%5=1 THEN concat(chr(10), '  Base directory for this skill: /opt/skills/tag-trace ', chr(10), c.text)
  WHEN c.role='user' AND c.turn=u_last.lu AND c.conv_id%5=2 THEN concat('Base directory for this skill: /opt/skills/other', chr(10), c.text)
  WHEN c.role='user' AND c.turn=0 AND c.conv_id%5=4 THEN concat('Base directory for this skill: /opt/skills/tag-trace', chr(10), c.text)
  ELSE c.text END AS text
FROM conversations c LEFT JOIN u_last ON c.conv_id=u_last.conv_id)"""

TAG_LOG = """
tag_log AS (
SELECT concat('tr-',user_id,'-',CAST(floor((dayofmonth(ts)-1)/7.0) AS INT)) AS trace_id, event_id AS seq, event_type AS key, CAST(json_extract_string(props,'$.k') AS VARCHAR) AS value FROM events)"""

FEEDBACK_LOG = """
feedback_log AS (
SELECT concat('tr-',doc_id%50,'-',doc_id%4) AS trace_id, 'quality' AS name, CASE WHEN quality=1 THEN 'good' ELSE 'poor' END AS value, 'HUMAN' AS source_type, concat('user_',doc_id%7) AS source_id, doc_id*1000 AS create_ms FROM labels
UNION ALL SELECT concat('tr-',doc_id%50,'-',doc_id%4), 'toxic', CASE WHEN toxic=1 THEN 'true' ELSE 'false' END, 'CODE', 'rule', doc_id*1000+1 FROM labels)"""

_PARTS = {
    "spans": SPANS,
    "env_snapshots": ENV_SNAPSHOTS,
    "transcripts": TRANSCRIPTS,
    "tag_log": TAG_LOG,
    "feedback_log": FEEDBACK_LOG,
}


def with_tables(body: str, *tables: str, extra: str = "", recursive: bool = False) -> str:
    """Prefix a statement with the CTEs of the derived tables it reads."""
    ctes = [_PARTS[t].strip() for t in tables]
    if extra:
        ctes.append(extra.strip())
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + body.strip()


def percentile_ctes(source: str, group: str, value: str, probs: dict[str, float], name: str = "pct") -> str:
    """CTEs computing exact linear-interpolation percentiles the way Spark's
    PERCENTILE does: position = (n-1)*p, (hi-pos)*v[lo] + (pos-lo)*v[hi].
    Result CTE `{name}` has one row per group with one column per alias."""
    probs_rows = ", ".join(f"('{a}', CAST({p!r} AS DOUBLE))" for a, p in probs.items())
    cols = ", ".join(f"max(CASE WHEN alias = '{a}' THEN v END) AS {a}" for a in probs)
    return f"""
{name}_r AS (SELECT {group} AS g, CAST({value} AS DOUBLE) AS x,
   row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS i,
   count({value}) OVER (PARTITION BY {group}) AS n
  FROM {source} WHERE {value} IS NOT NULL),
{name}_q AS (SELECT r.g, q.alias, CAST(max(r.n) - 1 AS DOUBLE) * max(q.p) AS pos,
   max(CASE WHEN r.i = floor(CAST(r.n - 1 AS DOUBLE) * q.p) THEN r.x END) AS v_lo,
   max(CASE WHEN r.i = ceil(CAST(r.n - 1 AS DOUBLE) * q.p) THEN r.x END) AS v_hi
  FROM {name}_r r CROSS JOIN (VALUES {probs_rows}) q(alias, p) GROUP BY r.g, q.alias),
{name}_v AS (SELECT g, alias, CASE WHEN floor(pos) = ceil(pos) THEN v_lo
   ELSE (ceil(pos) - pos) * v_lo + (pos - floor(pos)) * v_hi END AS v FROM {name}_q),
{name} AS (SELECT g, {cols} FROM {name}_v GROUP BY g)"""
