"""Operator 11: Merkle manifest of a dataset, kept as a postorder append log.

Every row is a leaf; the leaves of a group (its tree) stand in key order, and
every FAN consecutive nodes of a level hash to their parent. The group roots,
in group order, are the leaves of one tree above.

* Aligned builders: the leaves are dealt to tasks in blocks of FAN**LEVELS, so
  a block is a whole subtree. A builder reads its leaves in order and appends
  each node when it is complete: leaves, then a parent as soon as its last
  child is there. That is postorder; a subtree is one stretch of the log, and
  its root comes last. Block roots go to the builders of the next round.
* No node stores a pointer. The place of node (level, index) in the log of a
  tree of n leaves follows from subtree sizes alone (`position`), in the whole
  log and in a builder's stretch alike; siblings are read at those places.
* Proofs go down from the top: a block's siblings above it are found once and
  handed to its members, so that a leaf costs its own siblings only.

A round shrinks the input by FAN**LEVELS, so two or three rounds do. No task
holds more than a block; the driver sees one number (the longest tree).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.common import pick, read_table, written

FAN = 8
LEVELS = 4                # levels that one builder makes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LOG = "tree string, block long, level int, idx long, pos long, n long, up boolean, root boolean, digest binary"
PATH = "tree string, block long, pos long, digest binary, n long, subroot binary, root binary, top_idx long, top_n long"
PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
         "verified boolean")


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields: `-` for null, else UTF-8 byte count, `:`, value."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
             for c in (f.cast("string") for f in fields)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def node_digest(run: bytes) -> bytes:
    """The node over a run of digests, which are hashed as hexadecimal text."""
    return hashlib.sha256(run.hex().encode()).digest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    h = 0
    while FAN ** h < n:
        h += 1
    return h


def rounds(n: int) -> int:
    return max(1, -(-height(n) // LEVELS))


def level_size(n: int, level: int) -> int:
    return -(-n // FAN ** level)


def position(level: int, idx, n: int, top: int):
    """Postorder place of the nodes idx of a level in a tree of n leaves and
    `top` levels: all nodes whose leaves end by then, less one. Below and at
    the level these cover the leaves up to the node's end; above it only those
    that end where the node begins or earlier."""
    idx = np.asarray(idx, np.int64)
    begin = idx * FAN ** level
    end = np.minimum(begin + FAN ** level, n)
    done = sum(-(-end // FAN ** j) for j in range(level + 1))
    return done + sum(begin // FAN ** j for j in range(level + 1, top + 1)) - 1


def sibling_positions(rank: int, n: int) -> list[list[int]]:
    """Log places of a leaf's siblings, level by level, left to right."""
    out, top = [], height(n)
    for level in range(top):
        first = rank // FAN * FAN
        run = [i for i in range(first, min(first + FAN, level_size(n, level))) if i != rank]
        out.append(position(level, run, n, top).tolist())
        rank //= FAN
    return out


def ranked(spark: SparkSession, rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with `rank` (place in its tree by `order`) and `n` (leaves of the
    tree). Ranges are cut by sampled splitters, equal rows too (they may stand
    in any order), so that no tree and no key is one task."""
    keys = ["tree", *order, "tie"]
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.drop("tie").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
    rows = written(spark, rows, name)
    # One row per tree and range that holds rows of it.
    runs = rows.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
                       F.sum("size").over(tree).alias("n"))
    return rows.join(runs, ["tree", "part"]).withColumn("rank", F.col("base") + F.col("at") - F.col("first")).drop(
        "at", "part", "first", "base")


def _builder(r: int):
    """A block's nodes of round r in the order in which they are complete."""
    base = r * LEVELS

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        n = table.column("n")[0].as_py()
        h = height(n)
        top = min(h, base + LEVELS)
        counts = [level_size(n, level) for level in range(top + 1)]
        runs = {level: [] for level in range(base, top)}
        levels, idxs, digests = [], [], []
        for idx, digest in zip(table.column("rank").to_pylist(), table.column("digest").to_pylist()):
            level = base
            while True:
                levels.append(level)
                idxs.append(idx)
                digests.append(digest)
                if level == top:
                    break
                run = runs[level]
                run.append(digest)
                if (idx + 1) % FAN and idx + 1 < counts[level]:
                    break
                digest = node_digest(b"".join(run))
                run.clear()
                idx //= FAN
                level += 1
        level, idx = np.array(levels), np.array(idxs, np.int64)
        pos = np.zeros(len(idx), np.int64)
        for k in range(base, top + 1):
            pos[level == k] = position(k, idx[level == k], n, h)
        up = (level == base + LEVELS) & (h > base + LEVELS)
        same = lambda c: pa.array([table.column(c)[0].as_py()] * len(idx), table.schema.field(c).type)
        return pa.table({"tree": same("tree"), "block": same("block"), "level": pa.array(level, pa.int32()), "idx": idx, "pos": pos,
                         "n": same("n"), "up": up, "root": level == h, "digest": pa.array(digests, pa.binary())})

    return run


def build(spark: SparkSession, leaves: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Per round the log of the trees over leaves (tree, rank, n, digest);
    `most` is the size of the largest tree. The rows marked `up` are not log
    entries: they hand a block's root to the next round, which logs it."""
    out, nodes = [], leaves.select("tree", "rank", "n", "digest")
    for r in range(rounds(most)):
        blocks = nodes.withColumn("block", F.floor(F.col("rank") / F.lit(FAN ** LEVELS)))
        made = written(spark, blocks.groupBy("tree", "block").applyInArrow(_builder(r), LOG), f"{name}_round{r}")
        out.append(made)
        nodes = made.where("up").select("tree", F.col("idx").alias("rank"), "n", "digest")
    return out


def _stretch(table: pa.Table, r: int):
    """(its block's first index, local tops, digests of each level's runs as
    bytes) of a builder's stretch of the log, read by closed-form places."""
    n, block = table.column("n")[0].as_py(), table.column("block")[0].as_py()
    top = min(height(n) - r * LEVELS, LEVELS)
    first = block * FAN ** LEVELS
    members = min(FAN ** LEVELS, level_size(n, r * LEVELS) - first)
    held = table.sort_by("pos").column("digest").to_pylist()
    levels = []
    for level in range(top):
        size = level_size(members, level)
        at = position(level, np.arange(size), members, top).tolist()
        levels.append([b"".join(held[p] for p in at[a:a + FAN]) for a in range(0, size, FAN)])
    return first, members, levels


def _siblings(levels: list[list[bytes]], i: int) -> list[tuple[bytes, bytes]]:
    """Digests left and right of member i and of its ancestors in the block."""
    out = []
    for runs in levels:
        run, at = runs[i // FAN], 32 * (i % FAN)
        out.append((run[:at], run[at + 32:]))
        i //= FAN
    return out


def _paths(r: int):
    """Stretches of round r and the paths above their blocks (pos null) ->
    the path above each member, itself a block of the round below."""

    def run(table: pa.Table) -> pa.Table:
        info = table.filter(pa.compute.is_null(table.column("pos"))).to_pylist()[0]
        first, members, levels = _stretch(table.filter(pa.compute.is_valid(table.column("pos"))), r)
        paths = [b"".join(left + right for left, right in _siblings(levels, i)) + info["digest"] for i in range(members)]
        out = {c: [info[c]] * members for c in table.column_names}
        out |= {"block": list(range(first, first + members)), "pos": [None] * members, "digest": paths}
        return pa.table(out, schema=table.schema)

    return run


def all_paths(log: list[DataFrame], above: DataFrame, down_to: int) -> DataFrame:
    """From the top: `above` holds per tree a path row of its topmost block,
    with `level` = the tree's height. Returns the path rows of the blocks of
    round `down_to` - 1 (of the leaves themselves for 0)."""
    names = PATH.replace(",", "").split()[::2]
    topmost = F.greatest(F.lit(0), F.ceil(F.col("level") / F.lit(LEVELS)) - 1)
    paths = None
    for r in reversed(range(down_to, len(log))):
        start = above.where(topmost == r).select(*names)
        paths = start if paths is None else start.unionByName(paths)
        nothing = {c: F.lit(None).cast(t) for c, t in (("subroot", "binary"), ("root", "binary"), ("top_idx", "long"), ("top_n", "long"))}
        stretches = log[r].where("not up").select("tree", "block", "pos", "digest", "n", *(v.alias(c) for c, v in nothing.items()))
        paths = stretches.unionByName(paths).groupBy("tree", "block").applyInArrow(_paths(r), PATH)
    rest = above.where(topmost < down_to).select(*names)
    return rest if paths is None else paths.unionByName(rest)


def _split_path(path: bytes, idx: int, n: int, level: int) -> tuple[list[tuple[bytes, bytes]], bytes]:
    """A path's (left, right) from this level of a tree to its root, and the rest."""
    out = []
    for k in range(level, height(n)):
        size = min(FAN, level_size(n, k) - idx // FAN * FAN)
        at = 32 * (idx % FAN)
        out.append((path[:at], path[at:32 * (size - 1)]))
        path = path[32 * (size - 1):]
        idx //= FAN
    return out, path


def _prove(leaves: pa.Table, right: pa.Table) -> pa.Table:
    """A block's leaves with its stretch of the log and the path above it ->
    their proofs and folded roots."""
    info = right.filter(pa.compute.is_null(right.column("pos"))).to_pylist()[0]
    first, _, levels = _stretch(right.filter(pa.compute.is_valid(right.column("pos"))), 0)
    block = first // FAN ** LEVELS
    own, rest = _split_path(info["digest"], block, info["n"], LEVELS)
    top, _ = _split_path(rest, info["top_idx"], info["top_n"], 0)
    higher = own + top
    out = {k: [] for k in ("leaf", "proof_sha256", "folded_root", "verified")}
    for rank, leaf, probe in zip(*(leaves.column(c).to_pylist() for c in ("rank", "digest", "probe"))):
        path = _siblings(levels, rank - first)
        digest = leaf if probe is None else probe
        for left, after in path + higher:
            digest = node_digest(left + digest + after)
        siblings = b"".join(left + after for left, after in path) + info["digest"]
        out["leaf"].append(leaf.hex())
        out["proof_sha256"].append(hashlib.sha256(siblings.hex().encode()).hexdigest())
        out["folded_root"].append(digest.hex())
        out["verified"].append(digest == info["root"])
    n = leaves.num_rows
    return pa.table({"doc_id": leaves.column("key"), "leaf": out["leaf"], "subroot": [info["subroot"].hex()] * n, "root": [info["root"].hex()] * n,
                     **{k: out[k] for k in ("proof_sha256", "folded_root", "verified")}}, schema=_proof_schema())


def _proof_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(c, kinds[t]) for c, t in (x.split() for x in PROOF.split(", "))])


def manifest(docs: DataFrame, tampered: Column | None = None, fields: tuple[str, ...] = FIELDS, key: str = "doc_id",
             group: str = "lang", text: str = "text") -> tuple[dict[str, list[DataFrame]], DataFrame]:
    """(logs, proofs) of docs. logs: "groups" (a tree per group) and "top" (the
    tree of their roots), each a list of written rounds with tree, level, idx,
    pos, digest and the mark `up`. proofs: one row per document with doc_id,
    leaf, subroot, root, proof_sha256, folded_root, verified.

    `tampered` (a condition on `key`) marks documents that are proven with
    their text's A-Z lower-cased, against the untampered log.

    Nulls are fields of their own (`-`), so a null text differs from an empty
    one; a null group is a tree of its own before all others; null keys come
    first in their tree and are not tampered with unless the condition says so;
    rows of equal key stand in the order of their leaves, and repeated rows are
    leaves each; very long texts are hashed where they are read and travel no
    further; an empty table gives empty results; other columns are ignored."""
    spark = docs.sparkSession
    names = dict.fromkeys([*fields, key, group, text])
    base = pick(docs, **{f"f{i}": c for i, c in enumerate(names)})
    col = {c: F.col(f"f{i}") for i, c in enumerate(names)}
    lowered = [F.translate(col[c], UPPER, LOWER) if c == text else col[c] for c in fields]
    touched = tampered(col[key]) if tampered is not None else F.lit(False)
    lang = col[group].cast("string")
    leaves = base.select(
        F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang)).alias("tree"), col[key].cast("long").alias("key"),
        leaf_digest([col[c] for c in fields]).alias("digest"),
        F.when(touched, leaf_digest(lowered)).alias("probe"))
    # Written first: cutting ranges looks at the keys once more, but not at the texts.
    leaves = written(spark, leaves, "merkle_digests")
    leaves = ranked(spark, leaves, ["key", "digest"], "merkle_leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0
    groups = build(spark, leaves, most, "merkle_groups")

    roots = groups[0].where("root and not up")
    for made in groups[1:]:
        roots = roots.unionByName(made.where("root and not up"))
    roots = roots.select("tree", "level", "n", F.col("digest").alias("subroot"))
    subroots = ranked(spark, roots.select(F.lit("top").alias("tree"), F.col("tree").alias("key"), F.col("subroot").alias("digest")), ["key"], "merkle_subroots")
    trees = subroots.agg(F.max("n")).first()[0] or 0
    top = build(spark, subroots, trees, "merkle_top")

    peak = top[-1].where("root and not up").select(
        "tree", F.lit(0).cast("long").alias("block"), F.lit(None).cast("long").alias("pos"), F.lit(b"").alias("digest"), "n",
        F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"), F.lit(None).cast("long").alias("top_idx"),
        F.lit(None).cast("long").alias("top_n"), "level")
    tops = all_paths(top, peak, 0).select(F.col("block").alias("rank"), "digest", F.col("n").alias("top_n"), "root")
    above = roots.join(subroots.select(F.col("key").alias("tree"), "rank"), "tree").join(tops, "rank").select(
        "tree", F.lit(0).cast("long").alias("block"), F.lit(None).cast("long").alias("pos"), "digest", "n", "subroot", "root",
        F.col("rank").alias("top_idx"), "top_n", "level")
    above = written(spark, above, "merkle_above")
    paths = all_paths(groups, above, 1)
    block = F.floor(F.col("rank") / F.lit(FAN ** LEVELS)).alias("block")
    nothing = {c: F.lit(None).cast(t) for c, t in (("subroot", "binary"), ("root", "binary"), ("top_idx", "long"), ("top_n", "long"))}
    stretches = groups[0].where("not up").select("tree", "block", "pos", "digest", "n", *(v.alias(c) for c, v in nothing.items()))
    right = stretches.unionByName(paths)
    proofs = leaves.select("tree", block, "rank", "key", "digest", "probe").groupBy("tree", "block").cogroup(
        right.groupBy("tree", "block")).applyInArrow(_prove, PROOF)
    return {"groups": groups, "top": top}, proofs


def proof(log: list[DataFrame], tree: str, rank: int, n: int) -> list[bytes]:
    """One leaf's siblings within its tree (the key as in the log), bottom to
    top: a look-up of the few log rows at their closed-form places."""
    at = [p for run in sibling_positions(rank, n) for p in run]
    rows = [r for made in log for r in made.where((F.col("tree") == tree) & ~F.col("up") & F.col("pos").isin(at)).select("pos", "digest").collect()]
    held = {r["pos"]: bytes(r["digest"]) for r in rows}
    return [held[p] for p in at]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = lambda key: F.crc32(key.cast("string").cast("binary")) % 3 == 0
    return manifest(read_table(spark, sf_dir, "documents"), tampered=third)[1]


# DuckDB has no crc32: its table of 256 entries is made from the polynomial.
OP11_SQL = r"""
WITH RECURSIVE
crc_table(i, k, c) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8),
crc_list AS (SELECT list(c ORDER BY i) AS t FROM crc_table WHERE k = 8),
leaves AS (
  SELECT doc_id, lang, leaf, probe, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':' ||
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS probe
    FROM (
      SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
             xor(list_reduce([4294967295::BIGINT] || [ord(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
                 LAMBDA a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS crc
      FROM documents, crc_list))
  WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
nodes(lang, level, idx, n, h) AS (
  SELECT lang, 0, idx, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 8, n),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops(level, idx, n, h) AS (
  SELECT 0, idx, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 8, n),
runs AS (SELECT lang, level, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
fold(doc_id, lang, leaf, place, level, idx, d, proof) AS (
  SELECT doc_id, lang, leaf, l.idx, 0, l.idx, coalesce(probe, leaf), '' FROM leaves l
  UNION ALL
  SELECT doc_id, f.lang, leaf, f.place, f.level + 1, f.idx // 8,
         sha256(array_to_string(hs[1:f.idx % 8] || [d] || hs[f.idx % 8 + 2:], '')),
         proof || array_to_string(hs[1:f.idx % 8] || hs[f.idx % 8 + 2:], '')
  FROM fold f JOIN runs r ON r.lang IS NOT DISTINCT FROM f.lang AND r.level = f.level AND r.run = f.idx // 8),
folded AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY lang, place ORDER BY level DESC) = 1),
climb(doc_id, lang, leaf, place, subroot, level, idx, d, proof) AS (
  SELECT doc_id, f.lang, leaf, f.place, subroot, 0, s.idx, d, proof FROM folded f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang
  UNION ALL
  SELECT doc_id, lang, leaf, place, subroot, c.level + 1, c.idx // 8,
         sha256(array_to_string(hs[1:c.idx % 8] || [d] || hs[c.idx % 8 + 2:], '')),
         proof || array_to_string(hs[1:c.idx % 8] || hs[c.idx % 8 + 2:], '')
  FROM climb c JOIN top_runs r ON r.level = c.level AND r.run = c.idx // 8),
done AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY lang, place ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, d AS folded_root, d = h AS verified
FROM done, (SELECT h FROM tops WHERE n = 1)
"""
