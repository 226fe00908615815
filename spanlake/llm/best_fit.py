"""Operator 12: packing by bounded-space online best-fit.

Documents are tokenized and cut only where they exceed the window. The pieces
are dealt at random into groups of about GROUP pieces, a task each. A task
takes its pieces one by one, longest first, and gives each its place for good:
the open bin with the least free space that holds it, else a new bin. At most
`open_bins` bins are open; a new one beyond that closes the fullest. Open bins
stand on a stack per free space, and an integer is the bitset of free spaces
with a bin: best fit is its lowest bit from the length up, the fullest its
lowest bit.

A group's last bins are the ones that are far from full. They are not final:
their contents go on as ready-made pieces to a next round with fewer groups,
until one group is left; so the waste does not grow with the number of tasks.
What a task holds is its pieces' lengths and the open bins.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, written
from spanlake.llm.tokens import CACHE_PIECES, ENCODE_BYTES, append_id, default_vocabulary, encoder, text_slices

WINDOW = 2048
END_ID = 0
OPEN_BINS = 4096
GROUP = 1 << 14          # pieces per task
LOOSE = (15, 16)         # bins filled less than this are packed again in the next round

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
PLACED = "group long, item long, bin long, offset int, filled int"


def _pieces(path: str, end_id: int, window: int, cache: int, slice_bytes: int):
    def run(batches):
        enc = encoder(path, cache)
        for batch in batches:
            for part in text_slices(batch, "text", slice_bytes):
                ids, offsets = append_id(*enc.encode(part.column("text")), end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                doc, nth, crc, length = [], [], [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    for k, at in enumerate(range(a, b, window)):
                        to = min(at + window, b)
                        doc.append(i)
                        nth.append(k)
                        length.append(to - at)
                        crc.append(zlib.crc32(raw[4 * at:4 * to]))
                nth = np.array(nth, np.int64)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(pa.array(doc, pa.int64())), "piece": pa.array(nth, pa.int32()),
                    "start": nth * window, "length": pa.array(length, pa.int32()), "ids_crc32": pa.array(crc, pa.int64())})

    return run


class OpenBins:
    """A fixed number of open bins; `put` gives (bin, offset)."""

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most
        self.stacks: dict[int, list[int]] = {}     # free space -> open bins
        self.free = 0                              # bitset of the free spaces with an open bin
        self.count = self.made = 0

    def _take(self, space: int) -> int:
        stack = self.stacks[space]
        number = stack.pop()
        if not stack:
            self.free ^= 1 << space
        return number

    def put(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.count == self.most:            # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
                self.count -= 1
            space, number = self.window, self.made
            self.made += 1
            self.count += 1
        left = space - length
        if left:
            self.stacks.setdefault(left, []).append(number)
            self.free |= 1 << left
        else:
            self.count -= 1                        # full
        return number, self.window - space


def _pack_group(window: int, most: int):
    """A group's items (sorted, longest first) -> their bins and offsets."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("item", "ascending")])
        bins = OpenBins(window, most)
        placed = [bins.put(n) for n in table.column("length").to_pylist()]
        at = np.array(placed, np.int64).reshape(-1, 2)
        filled = np.bincount(at[:, 0], weights=table.column("length").to_numpy(), minlength=bins.made)[at[:, 0]]
        return pa.table({"group": table.column("group"), "item": table.column("item"), "bin": at[:, 0],
                         "offset": pa.array(at[:, 1], pa.int32()), "filled": pa.array(filled, pa.int32())})

    return run


def best_fit(items: DataFrame, window: int = WINDOW, open_bins: int = OPEN_BINS, group: int = GROUP) -> DataFrame:
    """(item, sequence_id, offset) for items (item: a unique long, length: 1 to window)."""
    spark = items.sparkSession
    left, rounds = items.select("item", "length"), []
    n = left.count()
    while True:
        groups = -(-n // group) or 1
        deal = F.pmod(F.xxhash64("item", F.lit(len(rounds))), F.lit(groups)).alias("group")
        made = left.select(deal, "item", "length").groupBy("group").applyInArrow(_pack_group(window, open_bins), PLACED)
        # A bin's number is unique over groups and rounds, and is an item of the next round.
        number = (F.lit(len(rounds) << 56) + F.shiftleft(F.col("group"), 32) + F.col("bin")).alias("bin")
        made = written(spark, made.select("item", number, "offset", "filled"), f"best_fit_round{len(rounds)}")
        rounds.append(made)
        if groups == 1:
            break
        loose = made.where((F.col("offset") == 0) & (F.col("filled") * LOOSE[1] < window * LOOSE[0]))
        left, before = loose.select(F.col("bin").alias("item"), F.col("filled").alias("length")), n
        n = left.count()
        if not n or 2 * n > before:                # nothing left, or lengths of which no two fit together
            break
    # From the last round back: what a bin became an item of, else the bin itself.
    where = rounds[-1].select("item", F.col("bin").alias("sequence_id"), "offset")
    for made in reversed(rounds[:-1]):
        higher = where.select(F.col("item").alias("bin"), "sequence_id", F.col("offset").alias("base"))
        where = made.join(higher, "bin", "left").select(
            "item", F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
    return where


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID, open_bins: int = OPEN_BINS,
         group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", cache_pieces: int = CACHE_PIECES,
         slice_bytes: int = ENCODE_BYTES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty (the end id alone); rows with repeated or null
    ids are documents of their own; equal lengths go by an internal number; a
    very long text becomes full windows and one rest; an empty table gives an
    empty result; other columns are ignored."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).mapInArrow(_pieces(vocabulary or default_vocabulary(), end_id, window, cache_pieces, slice_bytes), PIECE)
    rows = written(spark, rows.withColumn("item", F.monotonically_increasing_id()), "best_fit_pieces")
    # A full window is a sequence of its own, negative so that it clashes with no bin.
    full = rows.where(F.col("length") == window).select("*", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).alias("offset"))
    rest = rows.where(F.col("length") < window)
    packed = rest.join(best_fit(rest, window, open_bins, group), "item")
    return packed.select(*full.columns).unionByName(full).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id",
        F.col("offset").cast("long").alias("offset"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
