"""Operator 3: secret scan with a trigram inverted index (DataFrame functions only).

For each rule a Boolean query over trigrams is derived from its pattern: a text
that matches must contain those trigrams. The index stores, for every trigram
that some query uses, its posting list of ascending ids, cut into blocks of
BLOCK consecutive ids so that a frequent trigram is many short lists. Within a
block the lists are intersected (and) and united (or) as each query says; the
ids that remain are the rule's candidates, and only those are verified with its
regular expression. A rule whose pattern has no mandatory trigram (hex runs)
scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, written


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and non-overlapping, whose group `group`
    has `least` code points or more; shorter ones are dropped after matching."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    nocase: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.nocase else "") + self.pattern

    @property
    def explicit(self) -> str:
        """The same pattern with ASCII letters of either case spelled out (for
        engines whose case folding goes beyond ASCII)."""
        return re.sub(r"\\x..|\\.|\[[^\]]*\]|[a-z]", lambda m: m[0] if len(m[0]) > 1 else f"[{m[0]}{m[0].upper()}]", self.pattern) \
            if self.nocase else self.pattern


# The base rules' patterns and lengths.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
# Well-known public token shapes.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,255}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
MOST_STRINGS = 64    # exact strings followed while deriving a query
BLOCK = 4096         # ids per block of a posting list


# ---- trigram queries: True (no constraint), a trigram, ("and", [..]) or ("or", [..]) ----

def _and(parts):
    flat = set()
    for p in parts:
        flat |= set(p[1]) if p is not True and p[0] == "and" else {p}
    flat.discard(True)
    return True if not flat else flat.pop() if len(flat) == 1 else ("and", tuple(sorted(flat, key=str)))


def _or(parts):
    parts = set(parts)
    if True in parts:
        return True
    parts = {p for p in parts if not any(q != p and _implied(p, q) for q in parts)}
    return parts.pop() if len(parts) == 1 else ("or", tuple(sorted(parts, key=str)))


def _implied(p, q) -> bool:
    """p asks for all that q asks for (plain trigrams only)."""
    return {q} <= _plain(p) if isinstance(q, str) else q[0] == "and" and set(q[1]) <= _plain(p)


def _plain(p) -> set:
    return {p} if isinstance(p, str) else set(p[1]) if p[0] == "and" else set()


def _need(strings):
    """What a text must contain if it contains one of the strings."""
    return _or([_and([s[i:i + 3] for i in range(len(s) - 2)]) for s in strings]) if strings else True


def _literals(op, arg):
    """The lower-cased characters an item can be, or None if too many."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN and all(o is C.LITERAL or o is C.RANGE and a[1] - a[0] < 8 for o, a in arg):
        return {chr(c).lower() for o, a in arg for c in (range(a[0], a[1] + 1) if o is C.RANGE else [a])}
    return None


def _derive(items) -> tuple[set[str] | None, object]:
    """(the exact strings the items match or None, what a match must contain)."""
    exact: set[str] | None = {""}
    needs = []
    run: set[str] = {""}     # the strings of the current exact stretch
    for op, arg in items:
        if op is C.SUBPATTERN:
            one, need = _derive(arg[3])
        elif op is C.BRANCH:
            sides = [_derive(x) for x in arg[1]]
            one = None if any(e is None for e, _ in sides) else set().union(*(e for e, _ in sides))
            need = _or([_and([n, _need(e) if e else True]) for e, n in sides]) if one is None else True
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            least, most, inner = arg
            e, need = _derive(inner)
            one = None
            if e is not None and most != C.MAXREPEAT and most <= 2 and len(e) <= 4:
                one = {"".join(c) for k in range(least, most + 1) for c in _products([e] * k)}
            elif least == 0:
                need = True
            elif e is not None:
                need = _and([need, _need(e)])
        else:
            one, need = _literals(op, arg), True
        needs.append(need)
        grown = {a + b for a in run for b in one} if one is not None else None
        if grown is None or len(grown) > MOST_STRINGS:
            needs.append(_need(run))
            exact, run = None, one if one is not None and grown is not None else {""}
        else:
            run = grown
    if exact is not None:
        return run, _and(needs)
    return None, _and([*needs, _need(run)])


def _products(sets):
    return reduce(lambda acc, s: [x + (y,) for x in acc for y in s], sets, [()])


def trigram_query(pattern: str):
    """The Boolean query of trigrams (lower case) that every match satisfies."""
    exact, need = _derive(_parser.parse(pattern))
    return _and([need, _need(exact)]) if exact is not None else need


def trigrams(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _postings(query, lists: Column) -> Column:
    """The ids of a block that satisfy the query, from its map of posting lists."""
    if isinstance(query, str):
        return F.coalesce(F.element_at(lists, query), F.array().cast("array<bigint>"))
    join = F.array_intersect if query[0] == "and" else F.array_union
    return reduce(join, [_postings(q, lists) for q in query[1]])


# ---- index, candidates, verification ----

def used_trigrams(rules=RULES) -> list[str]:
    return sorted(set().union(*(trigrams(trigram_query(r.pattern)) for r in rules)))


def build_index(docs: DataFrame, rules=RULES) -> DataFrame:
    """Posting lists (block, trigram, ids ascending) of the trigrams the rules
    ask for; repeated ids count once, null ids are left out."""
    used = used_trigrams(rules)
    wanted = F.array(*map(F.lit, used)) if used else F.array().cast("array<string>")
    # The one-element array binds the lower-cased text once for all trigrams.
    found = F.flatten(F.transform(F.array(F.lower("text")), lambda low: F.filter(wanted, lambda t: F.contains(low, t))))
    block = F.floor(F.col("doc_id") / F.lit(BLOCK)).cast("long")
    pairs = docs.where(F.col("doc_id").isNotNull()).select(block.alias("block"), F.explode(found).alias("trigram"), "doc_id")
    return pairs.groupBy("block", "trigram").agg(F.sort_array(F.collect_set("doc_id")).alias("ids"))    # BLOCK ids at most


def store_index(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index written to the shared folder, each file sorted by trigram, for any
    number of scans of the same documents with these rules or some of them."""
    index = build_index(id_text(docs, id_col, text_col), rules)
    return written(docs.sparkSession, index.sortWithinPartitions("trigram", "block"), "secret_index")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, may): the ids that satisfy some rule's query; bit n of `may` is rule n."""
    asked = [(no, q) for no, q in enumerate(trigram_query(r.pattern) for r in rules) if q is not True]
    none = F.array().cast("array<struct<doc_id:bigint,may:bigint>>")
    lists = (index.where(F.col("trigram").isin(used_trigrams(rules))).groupBy("block")
             .agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists")))

    def hits(no: int, query) -> Column:
        bit = F.lit(1 << no).cast("long").alias("may")
        return F.transform(_postings(query, F.col("lists")), lambda d: F.struct(d.alias("doc_id"), bit))

    found = lists.select(F.explode(F.concat(none, *(hits(no, q) for no, q in asked))).alias("f")).select("f.*")
    return found.groupBy("doc_id").agg(F.bit_or("may").alias("may"))


def scan_secrets(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
                 index: DataFrame | None = None) -> DataFrame:
    """Per input row: doc_id, row, and `spans`, an array of (start, kind no.,
    end) in code points, end exclusive, sorted by start, then rule order.

    `index` is what store_index gave for these documents and rules; without it
    one is stored first. Null text counts as empty, whole texts of any length are
    scanned; rows with a null id are scanned without the index; repeated ids
    share their candidates and are verified row by row; an empty table gives an
    empty result; other columns are ignored."""
    spark = docs.sparkSession
    base = id_text(docs, id_col, text_col)
    if index is None:
        index = store_index(docs, rules, id_col, text_col)
    may = candidates(index, rules).select(F.col("doc_id").alias("may_id"), F.lit(True).alias("may_known"), "may")
    # Rows without an id meet no list; a hash of the text spreads them over the partitions.
    base = base.select("*", F.coalesce("doc_id", F.xxhash64("text")).alias("key"), F.col("doc_id").isNotNull().alias("known"))
    joined = base.join(may, (base["key"] == may["may_id"]) & (base["known"] == may["may_known"]), "left")
    found = []
    for no, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        may = F.lit(True) if query is True else ~F.col("known") | (F.coalesce("may", F.lit(0)).bitwiseAND(1 << no) != 0)
        if rule.group == 0 and rule.pattern.endswith("]+"):
            # A run of one class: dropping short runs after the match equals asking for the length.
            pattern = rule.java[:-1] + "{%d,}" % (rule.least - len(re.match(r"\w*", rule.pattern)[0]))
            verify = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
            least = 1
        else:
            pattern, least = rule.java, rule.least
            verify = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        is_hit = may & F.col("text").rlike(pattern)
        lens = F.transform(verify, lambda m: F.length(m))
        kept = (F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(rule.group)), lambda m: F.length(m) >= least)
                if rule.group or least > 1 else F.transform(verify, lambda m: F.lit(True)))
        gaps = F.transform(F.split("text", pattern, -1), lambda g: F.length(g))
        found.append(F.when(is_hit, F.struct(F.lit(no).alias("kind"), F.arrays_zip(
            gaps.alias("gap"), lens.alias("len"), kept.alias("ok")).alias("parts"))))
    rows = joined.select("doc_id", F.monotonically_increasing_id().alias("row"), F.filter(
        F.array(*found), lambda x: x.isNotNull()).alias("found"))
    rows = written(spark, rows, "secret_matches")       # lengths only; texts go no further

    parts = (rows.where(F.size("found") > 0).select("row", F.explode("found").alias("f"))
             .select("row", F.col("f.kind").alias("kind"), F.posexplode("f.parts").alias("pos", "p")))
    # Code points up to the end of the n-th match: one document's matches of one rule.
    upto = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("end", F.sum(F.col("p.gap") + F.coalesce(F.col("p.len"), F.lit(0))).over(upto))
    spans = (parts.where("p.ok").groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        (F.col("end") - F.col("p.len")).alias("start"), "kind", "end"))).alias("spans")))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.select("doc_id", "row").join(spans, "row", "left").select(
        "doc_id", "row", F.coalesce("spans", empty).alias("spans"))


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(r.kind) for r in RULES])

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def _sql() -> str:
    def lit(s):
        return "'" + s.replace("'", "''") + "'"
    ctes, unions = [], []
    for no, r in enumerate(RULES):
        p = lit(r.explicit)
        ctes.append(f"""k{no} AS (SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, m, g,
          list_transform(s, lambda x: length(x)) AS gaps, list_transform(m, lambda x: length(x)) AS lens FROM (
          SELECT doc_id, regexp_extract_all(text, {p}) AS m, regexp_extract_all(text, {p}, {r.group}) AS g,
                 string_split_regex(text, {p}) AS s FROM t WHERE regexp_matches(text, {p})))""")
        unions.append(f"""SELECT doc_id, {no} AS no, '{r.kind}' AS kind,
          CAST(list_sum(gaps[1:i]) + coalesce(list_sum(lens[1:i - 1]), 0) AS BIGINT) AS a, lens[i] AS n
          FROM k{no} WHERE length(g[i]) >= {r.least}""")
    nl = ",\n"
    sums = ", ".join(f"count(*) FILTER (no = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))
    spell = "kind || ':' || a || ':' || (a + n)"
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{nl.join(ctes)},
u AS ({' UNION ALL '.join(unions)}),
a AS (SELECT doc_id, {sums}, string_agg({spell}, ',' ORDER BY a, no) FILTER (no < {len(BASE)}) AS base,
      string_agg({spell}, ',' ORDER BY a, no) AS spans FROM u GROUP BY doc_id)
SELECT t.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a ON a.doc_id = t.doc_id"""


OP3_SQL = _sql()
