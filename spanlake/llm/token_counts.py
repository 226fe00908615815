"""Operator 4: token counts from flat, unindexed token files.

A flat file is nothing but ids: 16-bit little-endian, documents one after
another, each closed by the end-of-document id. Spark reads a file in byte
ranges, one task per range, so neither the length of a file nor that of a
document in it is bound to one task (a document's own bytes between two end
bytes are). Each task searches its block for the end id with vector operations;
a prefix scan over the blocks of a file (bytes and separators before a block,
the last separator before it) stitches the documents that cross blocks.

The ranges are Spark's text splits, cut at the end id's first byte. That byte
may also be half of another id, and a task does not know whether its block
begins at an even byte of the file; it searches both alignments, and the prefix
scan over the blocks' lengths tells which one holds.

`write_flat` makes such files with Spark's text writer: the bytes of a
document are the row, and the end id's two bytes are the line separator, so
the writer itself lays the file down in any store. Two choices make this sound:
the end id is the vocabulary's entry for the byte 0xC0, which valid UTF-8 never
contains, so no text yields it; and each document opens with five marks from
above the vocabulary (13 bits of its id in each) that name it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, work_dir, written
from spanlake.llm.tokens import ENCODE_BYTES, default_vocabulary, encoder, text_slices

END_ID = 124            # the byte 0xC0 in word_bpe_49k; its two bytes are "|\0"
MARK, MARK_BITS, MARKS = 49_408, 13, 5
BOM_BYTES = 3           # Spark's line reader drops EF BB BF at the start of a file
# A block's own row has no `side`; the others are documents that end in the block.
FOUND = ("file string, size long, block long, side int, ordinal long, first binary, bytes long, "
         "seps array<long>, last array<long>, heads array<binary>, start long, stop long, doc_id long")


def _flat(path: str, end_id: int):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for piece in text_slices(batch, "text", ENCODE_BYTES):
                ids, offsets = enc.encode(piece.column("text"))
                if len(ids) and int(ids.max()) >= MARK:
                    raise ValueError("the vocabulary reaches into the marks")
                if (ids == end_id).any():
                    raise ValueError("the end id occurs in a text")
                ids = ids.astype("<u2")
                known = np.array([d is not None for d in piece.column("doc_id").to_pylist()])
                doc = np.array([d or 0 for d in piece.column("doc_id").to_pylist()], np.int64).view(np.uint64)
                low = (1 << MARK_BITS) - 1
                marks = np.stack([(doc >> np.uint64(MARK_BITS * k)) & np.uint64(low) for k in range(MARKS)], 1)
                marks[:, -1] |= np.where(known, 0, 1 << (MARK_BITS - 1)).astype(np.uint64)   # 64 bits use 12 of the last 13
                marks = (marks + np.uint64(MARK)).astype("<u2")
                rows = [marks[i].tobytes() + ids[offsets[i]:offsets[i + 1]].tobytes() for i in range(len(doc))]
                yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.binary())})

    return run


def write_flat(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
               id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every text as flat ids. Null text is an empty document; a null id
    is kept as null; repeated rows are documents of their own; texts of any
    length are written whole; an empty table writes no ids; other columns,
    whatever their names, are ignored. No shuffle: each input partition becomes
    a file."""
    if end_id >> 8 > 0x7F or end_id & 0xFF > 0x7F:
        raise ValueError("the end id's two bytes must be ASCII to serve as a line separator")
    rows = id_text(docs, id_col, text_col)
    rows = rows.mapInArrow(_flat(vocabulary or default_vocabulary(), end_id), "row binary")
    rows.select(F.col("row").cast("string")).write.option("lineSep", chr(end_id & 0xFF) + chr(end_id >> 8)).text(path)


class _Block:
    """The search of one block, batch by batch. Bytes are numbered from the
    block's first; `side` is the alignment, 0 for ids at its even bytes."""

    def __init__(self, file: str, size: int, block: int, end_id: int, marks: int):
        self.key = {"file": file, "size": size, "block": block}
        self.low, self.high, self.marks = end_id & 0xFF, end_id >> 8, marks
        self.fresh, self.first, self.held = True, b"", np.zeros(0, np.uint8)
        self.at = 0                                      # number of the first held byte
        self.seps, self.last, self.heads = [0, 0], [None, None], [None, None]

    def add(self, lines: pa.BinaryArray):
        """More lines: the bytes as they lie in the file. Every block but a
        file's first begins with the separator byte that closed the one before."""
        offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + len(lines) + 1].astype(np.int64)
        data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        data = np.insert(data, offsets[:-1] - offsets[0], self.low)
        if self.fresh and self.key["block"] == 0:
            data = data[1:]
        self.fresh = False
        if len(self.first) < 2 * self.marks:
            self.first += data[:2 * self.marks - len(self.first)].tobytes()
        self.held = np.concatenate([self.held, data])
        whole = len(self.held) - 2 - 2 * self.marks + 1  # hits from here on may lack a byte of the marks behind them
        if whole > 0:
            yield from self._search(whole)
            self.held, self.at = self.held[whole:], self.at + whole

    def close(self):
        n = len(self.held)
        size = self.at + n
        self.held = np.append(self.held, np.uint8(self.low))     # the next block's first byte
        yield from self._search(n)
        yield self._rows(1, first=[self.first], bytes=[size], seps=[self.seps], last=[self.last], heads=[self.heads])

    def _rows(self, n: int, **columns):
        given = {**{k: [v] * n for k, v in self.key.items()}, **columns}
        schema = {"file": pa.string(), "size": pa.int64(), "block": pa.int64(), "side": pa.int32(), "ordinal": pa.int64(), "first": pa.binary(),
                  "bytes": pa.int64(), "seps": pa.list_(pa.int64()), "last": pa.list_(pa.int64()), "heads": pa.list_(pa.binary()),
                  "start": pa.int64(), "stop": pa.int64(), "doc_id": pa.int64()}
        arrays = [c if isinstance(c := given.get(k, [None] * n), pa.Array) else pa.array(c, t) for k, t in schema.items()]
        return pa.RecordBatch.from_arrays(arrays, names=list(schema))

    def _search(self, below: int):
        """Separators that begin at the held bytes before `below`; a row for
        each document that one closes and that began in this block too, and a
        row without start for the one that began before it."""
        raw = self.held
        hits = np.flatnonzero((raw[:-1] == self.low) & (raw[1:] == self.high))
        hits = hits[hits < below]
        for side in (0, 1):
            mine = hits[(hits + self.at) % 2 == side]
            n = len(mine)
            if not n:
                continue
            begin = np.concatenate([[self.last[side] or 0], mine[:-1] + 2 + self.at]).astype(np.int64)
            known = np.ones(n, bool)
            doc = np.zeros(n, np.uint64)
            if self.marks:
                wide = np.concatenate([raw, np.zeros(2 * self.marks, np.uint8)])
                heads = wide[mine[:-1, None] + 2 + np.arange(2 * self.marks)].astype(np.uint64)
                before = np.frombuffer((self.heads[side] or b"").ljust(2 * self.marks, b"\0"), np.uint8).astype(np.uint64)
                heads = np.concatenate([before[None], heads])
                ids = heads[:, ::2] + (heads[:, 1::2] << np.uint64(8)) - np.uint64(MARK)
                known = (ids[:, -1] >> np.uint64(MARK_BITS - 1)) == 0
                for j in range(self.marks):
                    doc |= ids[:, j] << np.uint64(MARK_BITS * j)
            opened = np.ones(n, bool)
            opened[0] = self.last[side] is not None
            yield self._rows(n, side=pa.array(np.full(n, side, np.int32)), ordinal=pa.array(self.seps[side] + np.arange(n)),
                             start=pa.array(begin, mask=~opened), stop=pa.array(mine + self.at),
                             doc_id=pa.array(doc.view(np.int64), mask=~(known & opened & bool(self.marks))))
            self.seps[side] += n
            self.last[side] = int(mine[-1]) + 2 + self.at
            self.heads[side] = raw[mine[-1] + 2:mine[-1] + 2 + 2 * self.marks].tobytes()


def _scan(end_id: int, marks: int):
    def run(batches):
        block = None
        for batch in batches:
            place = batch.column("block").to_numpy()
            file = batch.column("file").dictionary_encode()
            code = file.indices.to_numpy()
            edges = np.flatnonzero((np.diff(place) != 0) | (np.diff(code) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                key = {"file": file[a].as_py(), "size": batch.column("size")[a].as_py(), "block": int(place[a])}
                if block is None or block.key != key:
                    if block is not None:
                        yield from block.close()
                    block = _Block(**key, end_id=end_id, marks=marks)
                yield from block.add(batch.column("line").slice(a, b - a))
        if block is not None:
            yield from block.close()

    return run


def _marked(head: Column, marks: int) -> Column:
    """The document id in the hexadecimal marks of a head (null: unknown)."""
    if not marks:
        return F.lit(None).cast("long")
    ids = [F.conv(F.concat(F.substring(head, 4 * k + 3, 2), F.substring(head, 4 * k + 1, 2)), 16, 10).cast("long") - MARK for k in range(marks)]
    doc = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(x, MARK_BITS * k) for k, x in enumerate(ids)])
    return F.when(ids[-1] < 1 << (MARK_BITS - 1), doc)


def _stitched(blocks: DataFrame, marks: int) -> DataFrame:
    """Per block: base (its first byte's place in the file), side, before
    (separators in earlier blocks), open_at and open_id (where the document
    that is open at its start begins, and its id), and the same behind it."""
    every = Window.partitionBy("file")
    order = every.orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("size") - F.sum("bytes").over(every)
    base = F.coalesce(F.sum("bytes").over(earlier), F.lit(0)) + F.when(missing >= BOM_BYTES, BOM_BYTES).otherwise(0)
    following = F.array_join(F.collect_list(F.hex("first")).over(order.rowsBetween(1, max(2 * marks, 1))), "")
    got = blocks.withColumn("base", base).withColumn("side", (F.col("base") % 2).cast("int")).withColumn("next", following)
    mine = lambda c: F.when(F.col("side") == 0, F.col(c)[0]).otherwise(F.col(c)[1])
    cut = lambda head: F.substring(F.concat(head, F.col("next")), 1, 4 * marks)      # noqa: E731
    got = got.select("file", "size", "block", "base", "side", mine("seps").alias("seps"), (F.col("base") + mine("last")).alias("last"),
                     F.when(mine("last").isNotNull(), cut(F.hex(mine("heads")))).alias("head"), cut(F.hex("first")).alias("top"))
    top = F.first("top").over(order)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = lambda w: [F.coalesce(F.last("last", True).over(w), F.lit(0)),                       # noqa: E731
                       _marked(F.coalesce(F.last("head", True).over(w), top), marks)]
    (open_at, open_id), (then_at, then_id) = carry(earlier), carry(upto)
    return got.select("file", "size", "block", "base", "side", F.coalesce(F.sum("seps").over(earlier), F.lit(0)).alias("before"),
                      F.sum("seps").over(every).alias("total"), open_at.alias("open_at"), open_id.alias("open_id"), then_at.alias("then_at"),
                      then_id.alias("then_id"), (F.lead("block").over(order).isNull()).alias("final"))


def count_tokens(spark: SparkSession, path: str, end_id: int = END_ID, marks: int = MARKS) -> DataFrame:
    """One row per document of the flat files under `path`: file, ordinal in
    the file, doc_id (null when the files carry no marks), start (in ids),
    n_tokens without marks and end id, closed (false for ids after the last end
    id of a file). Empty files give no rows; equal documents and ids are counted
    one by one; files and documents may be of any length, as a block is a byte
    range of a file; an odd number of bytes is an error. What travels to one task
    per file is a row of some 100 bytes per block."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", chr(end_id & 0xFF)).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                         F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    found = written(spark, lines.mapInArrow(_scan(end_id, marks), FOUND), "token_blocks")
    blocks = _stitched(found.where(F.col("side").isNull()).select("file", "size", "block", "first", "bytes", "seps", "last", "heads"), marks)
    blocks = written(spark, blocks, "token_stitches")
    even = F.when(F.col("size") % 2 == 1, F.raise_error(F.concat(F.lit("odd number of bytes: "), F.col("file")))).otherwise(F.lit(0))
    ends = found.where(F.col("side").isNotNull()).select("file", "block", "side", F.col("ordinal").alias("k"), "start", "stop", "doc_id")
    ends = ends.join(blocks, ["file", "block", "side"]).where(F.col("base") + F.col("stop") + 2 <= F.col("size"))
    began = F.when(F.col("start").isNull(), F.col("open_at")).otherwise(F.col("base") + F.col("start"))
    rows = ends.select("file", (F.col("before") + F.col("k")).alias("ordinal"),
                       F.when(F.col("start").isNull(), F.col("open_id")).otherwise(F.col("doc_id")).alias("doc_id"),
                       (began / 2).cast("long").alias("start"),
                       ((F.col("base") + F.col("stop") - began) / 2 - marks).cast("long").alias("n_tokens"), F.lit(True).alias("closed"))
    tails = blocks.where("final").where((F.col("size") + even) > F.col("then_at")).select(
        "file", F.col("total").alias("ordinal"), F.col("then_id").alias("doc_id"), (F.col("then_at") / 2).cast("long").alias("start"),
        ((F.col("size") - F.col("then_at")) / 2 - marks).cast("long").alias("n_tokens"), F.lit(False).alias("closed"))
    return rows.unionByName(tails)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "flat_tokens")
    write_flat(read_table(spark, sf_dir, "documents"), path)
    return count_tokens(spark, path).select("doc_id", "n_tokens")
