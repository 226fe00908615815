"""Operator 7: n-gram Jaccard self-join by chosen paths.

Every text is the set of its five-word shingles (fewer words: one shingle of
all). Texts with the same set form a class; classes are joined.

Chosen paths: in each of RUNS runs a set starts at the root and, at every node,
goes on to the children named by those of its tokens whose hash at that node
falls below 1 / (threshold * size). Two sets of similarity >= threshold choose a
common child at least once on average at every level, others soon part.
Buckets (nodes) of more than LARGE classes are split again by the same rule,
level by level up to DEPTH. All others, and what no longer parts (mutually
similar sets), are compared by brute force, in pairs of chunks of SMALL classes,
so no bucket ever meets in one task. RUNS gives the recall: a pair at
the threshold meets at depth two with probability 0.47 or more in a run, so 16
runs miss it with probability 0.53^16 < 4.1e-5 (above the threshold far less).
It survives to depth 3, 4, 5 and 6 with 0.37, 0.31, 0.26 and 0.23 only, so the
classes of buckets that were split go through more runs, 22, 28, 33 and 38 in
all by the deepest level reached: lost there with the same probability at
most, together below 1e-4 at every bucket size.

A pair that meets in several buckets is compared and counted in one of them
only: its largest common bucket. Links are counted inside the tasks; what
leaves a bucket is a number per class and one link per class to the smallest
class it is connected with there, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, written
from spanlake.llm.tokens import text_slices
from spanlake.llm.wordhash import Words, mix

WORDS = 5
THRESHOLD = (4, 5)      # 0.8, as a fraction
RUNS = 16
SMALL = 1024
LARGE = 2048
DEPTH = 6
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.StringArray, size: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its word n-grams."""
    words = Words(texts)
    h, first = words.hash, words.first
    rolled = h.copy()
    n = len(h)
    if n >= size:
        with np.errstate(over="ignore"):
            acc = np.zeros(n - size + 1, np.uint64)
            for k in range(size):
                acc = acc * _STEP + h[k:n - size + 1 + k]
            rolled = mix(acc)
    sets = []
    for i in range(len(first) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            acc = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for k in range(a, b):
                    acc = acc * _STEP + h[k]
            sets.append(mix(np.array([acc], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def choose(nodes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The children that a set chooses at each of its nodes."""
    p = THRESHOLD[1] / (THRESHOLD[0] * len(tokens))
    with np.errstate(over="ignore"):
        h = (tokens[None, :] ^ nodes[:, None]) * _STEP
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h[h <= np.uint64(min(p, 1.0) * (2**64 - 2**11))]


def survival(depth: int) -> float:
    """At least the probability that a pair at the threshold has a common node
    at this depth of a run: its common children are one on average or more, at
    worst spread as Poisson's."""
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(lost - 1)
    return 1 - lost


def runs_for(depth: int, runs: int) -> int:
    """Runs that miss a pair at this depth as seldom as `runs` at depth two."""
    return math.ceil(runs * math.log(1 - survival(2)) / math.log(1 - survival(depth)) - 1e-9)


def _roots(runs: int) -> np.ndarray:
    return mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _class_rows(runs: int):
    """Per text: its class key, size, and its nodes at depth two."""

    def run(batches):
        roots = _roots(runs)
        for batch in batches:
            for piece in text_slices(batch, "text"):
                keys, sizes, nodes = [], [], []
                for doc, tokens in zip(piece.column("doc_id").to_pylist(), shingle_sets(piece.column("text"))):
                    sizes.append(len(tokens))
                    if len(tokens):
                        keys.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                        nodes.append(np.unique(choose(choose(roots, tokens), tokens)).view(np.int64))
                    else:
                        keys.append(b"no words" + (doc or 0).to_bytes(8, "little", signed=True))
                        nodes.append(np.zeros(0, np.int64))
                ends = np.cumsum([0, *map(len, nodes)])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id"), "cls": pa.array(keys, pa.binary()), "n": pa.array(sizes, pa.int32()),
                    "nodes": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(nodes) if nodes else [], pa.int64()))})

    return run


def _split(depth: int):
    """Members of large buckets -> their children."""

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text"):
                out = {"cls": [], "rep": [], "n": [], "node": []}
                sets = shingle_sets(piece.column("text"))
                for cls, rep, n, node, tokens in zip(*(piece.column(c).to_pylist() for c in ("cls", "rep", "n", "node")), sets):
                    if xxhash.xxh3_128_digest(tokens.tobytes()) != cls:
                        continue        # another row with the same id
                    at = mix(np.array([node], np.int64).view(np.uint64) + np.uint64(depth))
                    for child in set(choose(at, tokens).view(np.int64).tolist()):
                        for k, v in zip(out, (cls, rep, n, child)):
                            out[k].append(v)
                yield pa.RecordBatch.from_pydict({"cls": pa.array(out["cls"], pa.binary()), "rep": pa.array(out["rep"], pa.int64()),
                                                  "n": pa.array(out["n"], pa.int32()), "node": pa.array(out["node"], pa.int64())})

    return run


def _more_runs(done: int, runs: int):
    """Classes -> their nodes at depth two in the runs after the first `done`."""

    def run(batches):
        roots = _roots(runs)[done:]
        for batch in batches:
            for piece in text_slices(batch, "text"):
                out = {"cls": [], "rep": [], "n": [], "node": []}
                sets = shingle_sets(piece.column("text"))
                for cls, rep, n, tokens in zip(*(piece.column(c).to_pylist() for c in ("cls", "rep", "n")), sets):
                    if xxhash.xxh3_128_digest(tokens.tobytes()) != cls:
                        continue        # another row with the same id
                    for node in set(choose(choose(roots, tokens), tokens).view(np.int64).tolist()):
                        for k, v in zip(out, (cls, rep, n, node)):
                            out[k].append(v)
                yield pa.RecordBatch.from_pydict({"cls": pa.array(out["cls"], pa.binary()), "rep": pa.array(out["rep"], pa.int64()),
                                                  "n": pa.array(out["n"], pa.int32()), "node": pa.array(out["node"], pa.int64())})

    return run


def _groups(batches, key: list[str]):
    """Whole groups from batches sorted by key, as (row range, table)."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows, bool)
        for c in key:
            v = table.column(c).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change)])
        yield table, cuts[:-1], cuts[1:]
        held = table.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held, np.array([0]), np.array([held.num_rows])


def _owned(own: list[list[tuple[int, int]]], here: tuple[int, int], n: np.ndarray, side: np.ndarray, cross: bool) -> np.ndarray:
    """Pairs (upper triangle) to compare in this bucket: sizes allow the
    threshold, no larger common bucket, and the pair spans the two chunks."""
    s = len(own)
    num, den = THRESHOLD
    mask = np.triu(np.ones((s, s), bool), 1)
    mask &= den * np.minimum(n[:, None], n[None, :]) >= num * np.maximum(n[:, None], n[None, :])
    if cross:
        mask &= side[:, None] != side[None, :]
    if not mask.any():
        return mask
    larger = [[x for x in nodes if x > here] for nodes in own]
    known = {x: i for i, x in enumerate(set().union(*larger))}
    if known:
        m = np.zeros((s, len(known)), np.float32)
        for i, nodes in enumerate(larger):
            m[i, [known[x] for x in nodes]] = 1
        mask &= (m @ m.T) == 0
    return mask


def _members(table, a, b):
    part = table.slice(a, b - a)
    own = [list(zip(x, y)) for x, y in zip(part.column("own_size").to_pylist(), part.column("own_node").to_pylist())]
    here = (part.column("size")[0].as_py(), part.column("node")[0].as_py())
    cross = part.column("lo")[0] != part.column("hi")[0]       # two chunks: only pairs across them
    return part, own, here, part.column("n").to_numpy().astype(np.int64), part.column("side").to_numpy(), cross


def _needed(batches):
    """Memberships whose bucket owns a pair of that class."""
    for table, starts, ends in _groups(batches, ["node", "lo", "hi"]):
        keep = []
        for a, b in zip(starts, ends):
            if b - a < 2:
                continue
            _, own, here, n, side, cross = _members(table, a, b)
            if set.intersection(*(set(x for x in nodes if x > here) for nodes in own)):
                continue        # all of them meet in a larger bucket
            mask = _owned(own, here, n, side, cross)
            keep += (a + np.flatnonzero(mask.any(0) | mask.any(1))).tolist()
        yield from table.take(pa.array(keep, pa.int64())).to_batches()


def _compare(batches):
    """Brute force in a bucket: links per class, and one link per class to the
    smallest class of its component there."""
    num, den = THRESHOLD
    for table, starts, ends in _groups(batches, ["node", "lo", "hi"]):
        out_cls, out_rep, out_links, out_to = [], [], [], []
        for a, b in zip(starts, ends):
            part, own, here, n, side, cross = _members(table, a, b)
            sets = shingle_sets(part.column("text"))
            keys = part.column("cls").to_pylist()
            first: dict[bytes, int] = {}
            for i, tokens in enumerate(sets):
                if keys[i] == xxhash.xxh3_128_digest(tokens.tobytes()):
                    first.setdefault(keys[i], i)
            at = sorted(first.values())
            if len(at) < 2:
                continue
            mask = _owned([own[i] for i in at], here, n[at], side[at], cross)
            tokens, who = np.concatenate([sets[i] for i in at]), np.repeat(np.arange(len(at)), n[at])
            order = np.argsort(tokens, kind="stable")
            tokens, who = tokens[order], who[order]
            fresh = np.concatenate([[True], tokens[1:] != tokens[:-1]])
            col = np.cumsum(fresh) - 1
            shared = np.bincount(col)[col] > 1
            col, who = col[shared], who[shared]
            col = np.unique(col, return_inverse=True)[1]
            common = np.zeros((len(at), len(at)), np.float64)
            for lo in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):
                some = (col >= lo) & (col < lo + 4096)
                m = np.zeros((len(at), 4096), np.float32)
                m[who[some], col[some] - lo] = 1
                common += m @ m.T
            total = n[at][:, None] + n[at][None, :]
            link = mask & ((den + num) * common >= num * total)
            link |= link.T
            degree = link.sum(1)
            label = np.arange(len(at))
            rep = np.array(part.column("rep").to_pylist(), object)[at]
            for _ in range(len(at)):          # spread the smallest index; a component needs few rounds
                new = np.minimum(label, np.where(link, label[None, :], len(at)).min(1))
                new = new[new]
                if (new == label).all():
                    break
                label = new
            for i in np.flatnonzero(degree):
                out_cls.append(keys[at[i]])
                out_rep.append(int(rep[i]))
                out_links.append(int(degree[i]))
                out_to.append(int(rep[label[i]]))
        yield pa.RecordBatch.from_pydict({"cls": pa.array(out_cls, pa.binary()), "rep": pa.array(out_rep, pa.int64()),
                                          "links": pa.array(out_links, pa.int64()), "to": pa.array(out_to, pa.int64())})


MEMBER = "node long, lo int, hi int, side int, cls binary, rep long, n int, size long, own_size array<long>, own_node array<long>"


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS,
                 small: int = SMALL, large: int = LARGE) -> tuple[DataFrame, DataFrame]:
    """(members, edges). members: one row per document with doc_id, class_id
    (smallest id with the same shingle set), class_size, n_links (other classes
    of similarity >= 0.8). edges: (a, b) class ids, whose connected components
    are those of all links.

    Null text counts as empty; texts without words are classes of their own
    without links; repeated rows fall in one class; a class known only by null
    ids takes part in no link; an empty table gives empty results; other
    columns are ignored."""
    spark = docs.sparkSession
    base = id_text(docs, id_col, text_col)
    rows = written(spark, base.mapInArrow(_class_rows(runs), "doc_id long, cls binary, n int, nodes array<long>"), "jaccard_classes")
    classes = rows.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("class_size"))
    classes = written(spark, classes, "jaccard_reps")
    # The class's own row: one per class (repeated ids are cut by the distinct).
    own_rows = rows.where("n > 0").join(classes.select(F.col("cls").alias("c2"), "rep"),
                                        (F.col("doc_id") == F.col("rep")) & (F.col("cls") == F.col("c2")))
    level = own_rows.select("cls", "rep", "n", F.explode("nodes").alias("node")).distinct()
    nodes = "cls binary, rep long, n int, node long"

    def descend(level):
        """Buckets below these nodes, the large ones of depth two (None if
        there are none), and the deepest level."""
        done, split, depth = [], None, 2
        while True:
            sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
            level = written(spark, level.join(sizes, "node"), f"jaccard_level{depth}")
            big = level.where(F.col("size") > large)
            if depth == DEPTH or big.isEmpty():
                return [*done, level], split, depth
            done.append(level.where(F.col("size") <= large))
            split = big if split is None else split
            depth += 1
            texts = big.drop("size").join(base, F.col("rep") == base["doc_id"]).select("cls", "rep", "n", "node", "text")
            level = texts.mapInArrow(_split(depth), nodes).distinct()

    done, split, deepest = descend(level)
    have = runs
    while (need := runs_for(deepest, runs)) > have:
        # A pair lost below depth two had both its classes in one of these buckets.
        again = split.select("cls", "rep", "n").distinct().join(base, F.col("rep") == base["doc_id"]).select("cls", "rep", "n", "text")
        more, _, depth = descend(again.mapInArrow(_more_runs(have, need), nodes).distinct())
        done, deepest, have = done + more, max(deepest, depth), need
    buckets = done[0]
    for more in done[1:]:
        buckets = buckets.unionByName(more)
    # A class's buckets: 1.6 or so a run, plus those of its splits.
    own = buckets.groupBy("cls").agg(F.collect_list(F.struct("size", "node")).alias("own")).select(
        F.col("cls").alias("c2"), F.col("own.size").alias("own_size"), F.col("own.node").alias("own_node"))
    members = buckets.join(own, F.col("cls") == F.col("c2"))
    # Chunks: a bucket of up to `small` is one chunk; a larger one is compared chunk against chunk.
    chunks = F.ceil(F.col("size") / small).cast("int")
    chunk = F.pmod(F.xxhash64("cls", "node"), chunks).cast("int")
    members = members.withColumn("chunks", chunks).withColumn("chunk", chunk)
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.select("node", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                             F.col("chunk").alias("side"), "cls", "rep", "n", "size", "own_size", "own_node")
    members = members.repartition("node", "lo", "hi").sortWithinPartitions("node", "lo", "hi")
    needed = written(spark, members.mapInArrow(_needed, MEMBER), "jaccard_needed")
    with_text = needed.join(base, F.col("rep") == base["doc_id"]).drop("doc_id")
    with_text = with_text.repartition("node", "lo", "hi").sortWithinPartitions("node", "lo", "hi")
    found = written(spark, with_text.mapInArrow(_compare, "cls binary, rep long, links long, to long"), "jaccard_links")
    links = found.groupBy("cls").agg(F.sum("links").alias("n_links"))
    named = classes.join(links, "cls", "left").select(
        F.col("cls").alias("c2"), F.col("rep").alias("class_id"), "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = rows.select("doc_id", "cls").join(named, F.col("cls") == F.col("c2")).select("doc_id", "class_id", "class_size", "n_links")
    edges = found.where(F.col("rep") != F.col("to")).select(F.col("rep").alias("a"), F.col("to").alias("b")).distinct()
    return out, edges


def components(edges: DataFrame) -> DataFrame:
    """(id, group) for every id of the edges: group is the smallest id of its
    connected component. Alternates large-star and small-star rounds on written
    tables until the edges are stars."""
    spark = edges.sparkSession
    e = written(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(down, "u")
        small = (joined.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = written(spark, small, "edges")
        same = new.exceptAll(e).isEmpty() and e.exceptAll(new).isEmpty()
        e = new
        if same:
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct())


def near_classes(members: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its connected
    group of links), set_id (smallest id with the same shingle set), set_size,
    n_links (other sets of similarity >= 0.8)."""
    groups = components(edges)
    return members.join(groups, F.col("class_id") == F.col("id"), "left").select(
        "doc_id", F.coalesce("group", "class_id").alias("class_id"), F.col("class_id").alias("set_id"),
        F.col("class_size").alias("set_size"), "n_links")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(*jaccard_join(read_table(spark, sf_dir, "documents")))
