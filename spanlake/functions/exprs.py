"""Column expressions shared by the operators.

Everything here is a native Catalyst expression (no Python at run time), so it
stays inside whole-stage code generation and is pushed down where possible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_or_name", "ntz_to_instant", "instant_to_ntz", "duration_ms", "duration_s", "avg_seconds", "is_error", "error_count",
    "error_rate_pct", "ms_to_ts", "fmt_utc", "iso_utc", "preview", "split_kv",
    "sha_or_none", "commit_message", "prompt_uri", "status_or_ok", "map_or_empty",
    "map_text", "lstrip_ws", "strip_ws", "skill_invocation_name", "tag_equals",
    "tag_not_equals", "attributes_match", "epoch_ntz",
]

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

# Fixed values that must equal the reference's.
SKILL_PREFIX = "Base directory for this skill:"
UTC_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
PREVIEW_LENGTH = 60


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_ms(start="start_time_ms", end="end_time_ms") -> Column:
    return col_or_name(end) - col_or_name(start)


def duration_s(start="start_time_ms", end="end_time_ms") -> Column:
    """`(end - start) / 1000.0` as DOUBLE (a decimal literal would make it DECIMAL(27,6))."""
    return duration_ms(start, end).cast("double") / F.lit(1000.0)


def avg_seconds(ms: Column | None = None) -> Column:
    """Mean duration in seconds from an exact integer sum.

    Same value as AVG((end-start)/1000.0) up to rounding, but it does not depend
    on the order partial sums are combined in, so it is identical on every run,
    partitioning and engine.
    """
    ms = duration_ms() if ms is None else ms
    return F.sum(ms).cast("double") / F.count(ms) / F.lit(1000.0)


def is_error(status="status") -> Column:
    return col_or_name(status) == F.lit("ERROR")


def error_count(status="status") -> Column:
    """SUM(CASE WHEN status='ERROR' THEN 1 ELSE 0 END): NULL status is not an
    error (count_if counts only TRUE)."""
    return F.count_if(is_error(status))


def error_rate_pct(status="status") -> Column:
    return error_count(status).cast("double") * F.lit(100.0) / F.count(F.lit(1))


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ in UTC, independent of the session time zone."""
    return F.timestamp_add("MILLISECOND", col_or_name(ms), epoch_ntz())


def ntz_to_instant(ts) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> TIMESTAMP instant (event time for
    watermarks), without going through the session time zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch_ntz(), col_or_name(ts)))


def instant_to_ntz(ts) -> Column:
    """TIMESTAMP instant -> UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col_or_name(ts)), epoch_ntz())


def fmt_utc(ms) -> Column:
    """Epoch ms -> 'YYYY-MM-DD HH:MM:SS UTC'."""
    return F.date_format(ms_to_ts(ms), UTC_FORMAT)


def iso_utc(ms) -> Column:
    """Epoch ms -> ISO-8601 with +00:00 offset (microseconds only when non-zero)."""
    ts = ms_to_ts(ms)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.concat(F.lit("."), F.lpad((F.pmod(col_or_name(ms), F.lit(1000)) * 1000).cast("string"), 6, "0"))
    return F.concat(whole, F.when(F.pmod(col_or_name(ms), F.lit(1000)) == 0, F.lit("")).otherwise(frac), F.lit("+00:00"))


def preview(text, length: int = PREVIEW_LENGTH) -> Column:
    """NULL/'' -> ''; newlines -> spaces; longer than `length` code points -> prefix + '...'."""
    t = F.replace(F.coalesce(col_or_name(text), F.lit("")), F.lit("\n"), F.lit(" "))
    return F.when(F.length(t) > length, F.concat(F.substring(t, 1, length), F.lit("..."))).otherwise(t)


def split_kv(pair) -> Column:
    """'key=value' split on the first '='; struct(key, value, valid)."""
    p = col_or_name(pair)
    parts = F.split(p, "=", 2)
    valid = F.coalesce(F.instr(p, "=") > 0, F.lit(False))
    return F.struct(
        F.when(valid, parts.getItem(0)).alias("key"),
        F.when(valid, parts.getItem(1)).alias("value"),
        valid.alias("valid"),
    )


def sha_or_none(content) -> Column:
    """SHA-256 hex of the UTF-8 content, 'none' when absent."""
    return F.coalesce(F.sha2(col_or_name(content), 256), F.lit("none"))


def commit_message(sha) -> Column:
    s = col_or_name(sha)
    return F.when(s.isNotNull() & (s != "none"), F.concat(F.lit("git:"), F.substring(s, 1, 8))).otherwise(F.lit("no-git"))


def prompt_uri(name, version) -> Column:
    """prompts:/{name}/{version} when both are truthy (non-empty name, non-zero version)."""
    n, v = col_or_name(name), col_or_name(version)
    ok = n.isNotNull() & (n != "") & v.isNotNull() & (v != 0)
    return F.when(ok, F.concat(F.lit("prompts:/"), n, F.lit("/"), v.cast("string")))


def status_or_ok(status="status") -> Column:
    return F.coalesce(col_or_name(status), F.lit("OK"))


def map_or_empty(m) -> Column:
    return F.coalesce(col_or_name(m), F.create_map().cast("map<string,string>"))


def map_text(m) -> Column:
    """Deterministic text form of a string map: 'k=v' sorted by key, joined by ','."""
    entries = F.array_sort(F.map_entries(map_or_empty(m)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


# Fixed values that must equal the reference's: the characters str.strip() takes as white space.
WHITE_SPACE = r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def lstrip_ws(text) -> Column:
    """str.lstrip(): all leading Unicode white space."""
    return F.regexp_replace(col_or_name(text), f"^{WHITE_SPACE}+", "")


def strip_ws(text) -> Column:
    return F.regexp_replace(col_or_name(text), f"^{WHITE_SPACE}+|{WHITE_SPACE}+\\z", "")


def skill_invocation_name(text) -> Column:
    """Skill name of a 'Base directory for this skill: /path/name' entry, else NULL.

    lstrip, prefix test, first line, text after the first ':', strip, basename
    (a trailing '/' gives '').
    """
    t = lstrip_ws(text)
    first_line = F.substring_index(t, "\n", 1)
    path = strip_ws(F.substring(first_line, len(SKILL_PREFIX) + 1, 1 << 30))
    return F.when(t.startswith(SKILL_PREFIX), F.substring_index(path, "/", -1))


def tag_equals(key: str, value: str, tags="tags") -> Column:
    """tag.k = 'v' (a missing key or NULL map is not a match)."""
    return F.coalesce(col_or_name(tags)[key] == F.lit(value), F.lit(False))


def tag_not_equals(key: str, value: str, tags="tags") -> Column:
    """tag.k != 'v' keeping rows that lack the key (null-safe)."""
    return ~col_or_name(tags)[key].eqNullSafe(F.lit(value))


def attributes_match(span_names=None, attributes: dict | None = None,
                     name_col="span_name", attr_col="attributes") -> Column:
    """Span membership + attribute filter. Empty criterion = no restriction."""
    cond = F.lit(True)
    if span_names:
        cond = cond & F.coalesce(col_or_name(name_col).isin(list(span_names)), F.lit(False))
    for k, v in (attributes or {}).items():
        cond = cond & F.coalesce(map_or_empty(attr_col)[k] == F.lit(str(v)), F.lit(False))
    return cond
