"""Operator 6: benchmark decontamination with a positional inverted index.

The index is partitioned by document, as a distributed search engine's is:
each shard holds, for some documents, every distinct word (64-bit hash) with
the sorted list of its positions. Shards are rows of a written table, made in
one pass without a shuffle. A phrase is searched in every shard: its words'
lists are taken from the rarest on, shifted by the word's place in the phrase,
and intersected. A proximity search intersects lists up to a distance.

The benchmark is read in blocks of a fixed number of words, and a block is what
travels to the tasks, so what is sent stays bounded however large it grows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, written
from spanlake.llm.tokens import text_slices
from spanlake.llm.wordhash import Words

WINDOW = 10
SHARD_WORDS = 1 << 20       # a shard closes after the document that reaches this many words
BLOCK_WORDS = 1 << 20       # benchmark words searched per pass
INDEX = "part int, shard int, doc_ids array<long>, doc_starts binary, terms binary, term_starts binary, positions binary"
MERGED = "doc_id long, n_words long, n_hit long, items array<long>"
FOUND = "part int, shard int, doc_no int, doc_id long, n_words long, hits array<int>, items array<long>"


def _index_rows(shard_words: int):
    def run(batches):
        part, shard = TaskContext.get().partitionId(), 0
        docs, hashes, counts, n = [], [], [], 0

        def close():
            nonlocal shard, docs, hashes, counts, n
            words = np.concatenate(hashes)
            order = np.argsort(words, kind="stable").astype(np.uint32)
            terms, starts = np.unique(words[order], return_index=True)
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "doc_starts": [np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype("<u4").tobytes()],
                "terms": [terms.astype("<u8").tobytes()],
                "term_starts": [np.append(starts, len(order)).astype("<u4").tobytes()],
                "positions": [order.astype("<u4").tobytes()]})
            shard, docs, hashes, counts, n = shard + 1, [], [], [], 0
            return row

        for batch in batches:
            for piece in text_slices(batch, "text"):
                words = Words(piece.column("text"))
                docs += piece.column("doc_id").to_pylist()
                hashes.append(words.hash)
                counts.append(np.diff(words.first))
                n += len(words.hash)
                if n >= shard_words:
                    yield close()
        if docs:
            yield close()

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard; null text has no words. No shuffle."""
    return id_text(docs, id_col, text_col).mapInArrow(_index_rows(shard_words), INDEX)


class Shard:
    """A shard's lists, read in place."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda c, kind: np.frombuffer(batch.column(c)[row].as_buffer(), kind)
        self.part, self.shard = batch.column("part")[row].as_py(), batch.column("shard")[row].as_py()
        self.doc_ids = batch.column("doc_ids")[row].as_py()
        self.doc_starts = get("doc_starts", "<u4").astype(np.int64)
        self.terms, self.term_starts = get("terms", "<u8"), get("term_starts", "<u4").astype(np.int64)
        self.positions = get("positions", "<u4")

    def lists(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's list begins and ends (empty if it doesn't occur)."""
        at = np.minimum(np.searchsorted(self.terms, words), max(len(self.terms) - 1, 0))
        have = self.terms[at] == words if len(self.terms) else np.zeros(len(words), bool)
        return np.where(have, self.term_starts[at], 0), np.where(have, self.term_starts[at + 1] if len(self.terms) else 0, 0)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, positions, "right") - 1

    def phrase(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places where the words with these lists follow one another in one
        document: offset-adjusted intersection, rarest list first."""
        sizes = hi - lo
        order = np.argsort(sizes, kind="stable")
        k = order[0]
        at = self.positions[lo[k]:hi[k]].astype(np.int64) - k
        at = at[at >= 0]
        for k in order[1:]:
            if not len(at):
                break
            with_k = self.positions[lo[k]:hi[k]]
            place = np.searchsorted(with_k, (at + k).astype(np.uint32))
            at = at[with_k[np.minimum(place, len(with_k) - 1)] == at + k]
        return at[self.doc_of(at) == self.doc_of(at + len(lo) - 1)] if len(at) else at

    def near(self, lo: np.ndarray, hi: np.ndarray, distance: int) -> np.ndarray:
        """Places of the rarest word that have every other word within
        `distance` words, in one document, in any order."""
        order = np.argsort(hi - lo, kind="stable")
        at = self.positions[lo[order[0]]:hi[order[0]]].astype(np.int64)
        for k in order[1:]:
            if not len(at):
                break
            with_k = self.positions[lo[k]:hi[k]].astype(np.int64)
            place, doc, ok = np.searchsorted(with_k, at), self.doc_of(at), np.zeros(len(at), bool)
            for side in (np.maximum(place - 1, 0), np.minimum(place, len(with_k) - 1)):
                ok |= (np.abs(with_k[side] - at) <= distance) & (self.doc_of(with_k[side]) == doc)
            at = at[ok]
        return at


def windows_of(items: list[tuple[int | None, np.ndarray]], window: int) -> list[tuple[int | None, np.ndarray]]:
    """(item number, words) per window; an item of fewer words is one window."""
    return [(no, words[k:k + window]) for no, words in items if len(words)
            for k in range(max(1, len(words) - window + 1))]


def _search(windows: list[tuple[int | None, np.ndarray]], only: bool):
    """Per document of each shard: merged hit ranges and the items found, or,
    for the only block, their final form (one Python worker per task, not two)."""

    def run(batches):
        flat = np.concatenate([w for _, w in windows]) if windows else np.zeros(0, np.uint64)
        size = np.array([len(w) for _, w in windows], np.int64)
        first = np.cumsum(size) - size
        named = np.array([no is not None for no, _ in windows], bool)
        item = np.array([no if no is not None else 0 for no, _ in windows], np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row)
                lo, hi = shard.lists(flat)
                least = np.minimum.reduceat(hi - lo, first) if len(flat) else np.zeros(0, np.int64)
                total = int(shard.doc_starts[-1])
                cover, pairs = np.zeros(total + 1, np.int32), []
                for k in np.flatnonzero(least > 0):
                    span = slice(first[k], first[k] + size[k])
                    at = shard.phrase(lo[span], hi[span])
                    if len(at):
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + size[k], -1)
                        if named[k]:
                            pairs.append(np.stack([shard.doc_of(at), np.full(len(at), item[k])], 1))
                hit = np.cumsum(cover[:-1]) > 0
                edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
                begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
                n = len(shard.doc_ids)
                hits, items = [[] for _ in range(n)], [[] for _ in range(n)]
                for b, e in zip(begins, ends):          # a run of hits may cross documents: cut it
                    for d in range(shard.doc_of(b), shard.doc_of(e - 1) + 1):
                        s = shard.doc_starts[d]
                        cut = max(b, s) - s, min(e, shard.doc_starts[d + 1]) - s
                        if cut[0] < cut[1]:
                            hits[d] += [int(cut[0]), int(cut[1])]
                for d, i in found.tolist():
                    items[d].append(i)
                if only:
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(shard.doc_ids, pa.int64()), "n_words": pa.array(np.diff(shard.doc_starts)),
                        "n_hit": pa.array([sum(h[1::2]) - sum(h[::2]) for h in hits], pa.int64()),
                        "items": pa.array([sorted(i) for i in items], pa.list_(pa.int64()))})
                    continue
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([shard.part] * n, pa.int32()), "shard": pa.array([shard.shard] * n, pa.int32()),
                    "doc_no": pa.array(range(n), pa.int32()), "doc_id": pa.array(shard.doc_ids, pa.int64()),
                    "n_words": pa.array(np.diff(shard.doc_starts)), "hits": pa.array(hits, pa.list_(pa.int32())),
                    "items": pa.array(items, pa.list_(pa.int64()))})

    return run


def _merge(batches):
    """Several blocks' ranges of a document -> number of words hit, items."""
    for batch in batches:
        n_hit, items = [], []
        for ranges, found in zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist()):
            total = reach = 0
            for b, e in sorted(zip(ranges[::2], ranges[1::2])):
                total += max(0, e - max(b, reach))
                reach = max(reach, e)
            n_hit.append(total)
            items.append(sorted(set(found)))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"),
            "n_hit": pa.array(n_hit, pa.int64()), "items": pa.array(items, pa.list_(pa.int64()))})


def _blocks(benchmark: DataFrame, most_words: int):
    """Items (number, id, word hashes) in blocks; read row by row, so the
    driver holds one block at a time."""
    def keyed():
        held, n = [], 0
        for row in benchmark.toLocalIterator():
            words = Words(pa.array([row["text"]])).hash
            held.append((row["doc_id"], words))
            n += len(words)
            if n >= most_words:
                yield held
                held, n = [], 0
        if held:
            yield held
    return keyed()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted item ids).

    Null texts and items have no words; an item without words has no window; a
    null item id is ignored in `items` but its hits count; repeated items and
    documents are treated one by one; empty tables give no hits or no rows;
    other columns are ignored."""
    spark = docs.sparkSession
    index = written(spark, build_index(docs, id_col, text_col), "positional_index")
    items = id_text(benchmark, item_col, item_text_col)
    def windows(block):
        return windows_of(block, window)

    blocks = _blocks(items, block_words)
    block, later = next(blocks, []), next(blocks, None)
    if later is None:
        merged = index.mapInArrow(_search(windows(block), True), MERGED)
    else:
        # A block's hits are written before the next block is read: the driver holds one.
        parts = []
        while block is not None:
            parts.append(written(spark, index.mapInArrow(_search(windows(block), False), FOUND), f"positional_hits{len(parts)}"))
            block, later = later, next(blocks, None) if later is not None else None
        found = reduce(lambda a, b: a.unionByName(b), parts).groupBy("part", "shard", "doc_no", "doc_id", "n_words").agg(
            F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
        merged = found.mapInArrow(_merge, MERGED)
    return merged


def proximity(index: DataFrame, phrases: list[tuple[int, str]], distance: int) -> DataFrame:
    """(doc_id, item, n): documents in which all words of a phrase stand within
    `distance` words of an occurrence of its rarest word, and how often."""
    texts = [(no, Words(pa.array([text])).hash) for no, text in phrases]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row)
                out = []
                for no, words in texts:
                    lo, hi = shard.lists(words)
                    if len(words) and (hi > lo).all():
                        doc, n = np.unique(shard.doc_of(shard.near(lo, hi, distance)), return_counts=True)
                        out += [(shard.doc_ids[d], no, c) for d, c in zip(doc.tolist(), n.tolist())]
                cols = list(zip(*out)) or [[], [], []]
                yield pa.RecordBatch.from_pydict({k: pa.array(list(c), pa.int64()) for k, c in zip(("doc_id", "item", "n"), cols)})

    return index.mapInArrow(run, "doc_id long, item long, n long")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
