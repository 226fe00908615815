"""Operator 10: packing by non-negative least squares.

A document's ids are cut into full windows and one rest. Rests are packed by a
plan made from their length histogram alone (one number per length, so its
size does not depend on the number of documents):

1. enumerate shallow combinations of lengths (one, two or three) that fill a
   window exactly;
2. solve for repeat counts x >= 0 with the histogram, min |A x - h|, by
   accelerated projected gradient;
3. round down, and take back repeats that use more than there is;
4. pack what is left greedily (best fit, longest first), lengths in bulk.

Every document then finds its place by its rank within its length: ranks are
counted per (length, salt), so a length that a third of all documents share is
not one group.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, shuffle_partitions, written
from spanlake.llm.tokens import CACHE_PIECES, ENCODE_BYTES, append_id, default_vocabulary, encoder, text_slices

WINDOW = 4096
END_ID = 2
PIECE = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"
TRIPLE_STEP = 64       # second lengths tried in combinations of three, for each first
ROUNDS = 400


def _pieces(path: str, end_id: int, window: int, pieces: int, slice_bytes: int):
    def run(batches):
        enc = encoder(path, pieces)
        for batch in batches:
            for part in text_slices(batch, "text", slice_bytes):
                ids, offsets = append_id(*enc.encode(part.column("text")), end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                sizes = np.diff(offsets)
                n = -(-sizes // window)
                row = np.repeat(np.arange(len(sizes)), n)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = nth * window
                length = np.minimum(sizes[row] - start, window)
                at = offsets[row] + start
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(pa.array(row)), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int32()), "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": pa.array(sizes[row], pa.int64())})
        if pieces < CACHE_PIECES:          # asked to be lean: nothing stays in the worker
            enc.reset()
            pa.default_memory_pool().release_unused()

    return run


def combinations(histogram: np.ndarray, window: int) -> np.ndarray:
    """Rows of up to three lengths (0: none) that sum to the window and occur."""
    have = np.flatnonzero(histogram[:window])
    have = have[have > 0]
    ok = np.zeros(window + 1, bool)
    ok[have] = True
    a = have[have >= (window + 1) // 2]
    pairs = np.stack([a, window - a, np.zeros_like(a)], 1)[ok[window - a]]
    common = have[np.argsort(-histogram[have], kind="stable")]
    rows = [pairs]
    for a in have.tolist():
        # the commonest second lengths; the third follows
        b = common[(common <= a) & (common < window - a)][:TRIPLE_STEP]
        c = window - a - b
        good = (c <= b) & (c > 0)
        b, c = b[good], c[good]
        b, c = b[ok[c]], c[ok[c]]
        rows.append(np.stack([np.full(len(b), a), b, c], 1))
    return np.unique(np.concatenate(rows).astype(np.int64), axis=0) if rows else np.zeros((0, 3), np.int64)


def solve_counts(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares min |A x - h| by accelerated projected
    gradient; A has a column per combination."""
    if not len(combos):
        return np.zeros(0)
    h = histogram.astype(float).copy()
    h[0] = 0
    use = (combos > 0).astype(float)

    def forward(x):
        out = np.bincount(combos.ravel(), weights=(use * x[:, None]).ravel(), minlength=len(h))
        out[0] = 0
        return out

    back = lambda r: (r[combos] * use).sum(1)
    v = np.ones(len(combos))
    for _ in range(20):                       # largest eigenvalue of A'A
        v = back(forward(v))
        step = np.linalg.norm(v)
        v /= step
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(ROUNDS):
        new = np.maximum(0, y - back(forward(y) - h) / step)
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = new + (old - 1) / t * (new - x)
        x = new
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, lo, hi, sequence, offset): the pieces of that length with
    ranks lo..hi-1 go to sequences sequence + (rank - lo), at offset."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros(window + 1, np.int64)
    slots, sequence = [], 0

    def put(lengths, count):
        nonlocal sequence
        offset = 0
        for length in lengths:
            lo = int(used[length])
            slots.append((int(length), lo, lo + count, sequence, offset))
            used[length] += count
            left[length] -= count
            offset += int(length)
        sequence += count

    if left[window]:
        put([window], int(left[window]))
    combos = combinations(left, window)
    counts = np.floor(solve_counts(combos, left) + 1e-6).astype(np.int64)
    for k in np.argsort(-counts, kind="stable"):
        count = int(counts[k])
        if not count:
            break
        need = defaultdict(int)
        for length in combos[k]:
            if length:
                need[int(length)] += 1
        count = min([count] + [int(left[length]) // n for length, n in need.items()])
        if count > 0:
            put([int(x) for x in combos[k] if x], count)

    # Best fit, longest first: bins of one content and count at a time.
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)   # room -> [(lengths, how many)]
    rooms = np.zeros(window + 1, bool)
    for length in range(window - 1, 0, -1):
        n = int(left[length])
        while n:
            fit = np.flatnonzero(rooms[length:])
            if len(fit):
                room = length + int(fit[0])
                held, have = bins[room].pop()
                take = min(n, have)
                if have > take:
                    bins[room].append((held, have - take))
                rooms[room] = bool(bins[room])
            else:
                room, held = window, ()
                # as many to a new bin as fit, so that n shrinks in bulk
                per = min(n, window // length)
                take = n // per
                held = (length,) * (per - 1)
                room = window - length * (per - 1)
                n -= take * (per - 1)
            bins[room - length].append((held + (length,), take))
            rooms[room - length] = True
            n -= take
    for group in list(bins.values()):
        for held, count in group:
            put(held, count)
    return slots


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", cache_pieces: int = CACHE_PIECES, slice_bytes: int = ENCODE_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Null text counts as empty (the end id alone); rows with repeated or null
    ids are documents of their own; ties among equal lengths go by hash and id;
    an empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).mapInArrow(_pieces(vocabulary or default_vocabulary(), end_id, window, cache_pieces, slice_bytes), PIECE)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(4 * shuffle_partitions(spark))).cast("int"))
    rows = written(spark, rows, "packing_pieces")

    # At most window * salts rows; the histogram sent to the driver has one row per length.
    cells = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(window + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    slots = spark.createDataFrame(
        [tuple(map(int, s)) for s in plan(histogram, window)], "length int, lo long, hi long, sequence long, offset int")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = cells.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("row")
    ranked = (rows.withColumn("nth", F.row_number().over(within) - 1).join(base, ["length", "salt"])
              .withColumn("rank", F.col("base") + F.col("nth")))
    # The plan's size depends on the window only, not on the data.
    placed = ranked.join(F.broadcast(slots), "length").where("rank >= lo and rank < hi")
    return placed.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                         (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"),
                         F.col("offset").cast("long").alias("offset"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
