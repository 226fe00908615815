"""Operator 5: token ids in directly addressable files.

A file holds the ids of consecutive documents as directly addressable codes:
each id is cut into 8-bit chunks, lowest first. Level 0 keeps one chunk of
every id; a bit of its continuation bitmap says whether the id has more, and
the chunks of those ids, in order, are level 1, and so on. A rank directory
(one count per 512 bits) gives the place of id i on the next level, so any id
is read from a few bytes without decoding its block.

The files are rows of a Parquet table in document order: one row is a
segment of whole documents with its payload, its document ids and their first
positions. Spark writes and reads them in any store it knows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, work_dir
from spanlake.llm.tokens import ENCODE_BYTES, append_id, default_vocabulary, encoder, text_slices

END_ID = 1
SEGMENT_IDS = 1 << 19   # a segment closes after the document that reaches this many ids
RANK_BITS = 512
MAGIC = b"DAC1"
SEGMENT = "part int, segment int, first long, n_ids long, payload binary, doc_ids array<long>, doc_starts array<long>"


def dac_encode(ids: np.ndarray) -> bytes:
    """Payload: magic, number of levels, then per level its length, chunks,
    bitmap and rank directory."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        pad = np.zeros(-len(more) % RANK_BITS + len(more), np.uint32)
        pad[:len(more)] = more
        per = pad.reshape(-1, RANK_BITS).sum(1) if len(pad) else np.zeros(0, np.uint32)
        ranks = (np.cumsum(per) - per).astype("<u4")
        levels.append(struct.pack("<I", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> 8
    return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)


class DacReader:
    """Random access to a payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token segment")
        n_levels, at = struct.unpack_from("<I", payload, 4)[0], 8
        self.levels = []
        for _ in range(n_levels):
            n = struct.unpack_from("<I", payload, at)[0]
            at += 4
            chunks = np.frombuffer(payload, np.uint8, n, at)
            at += n
            bits = np.frombuffer(payload, np.uint8, (n + 7) // 8, at)
            at += len(bits)
            ranks = np.frombuffer(payload, "<u4", -(-n // RANK_BITS), at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            head = bits[block * RANK_BITS // 8:i >> 3]
            tail = int(bits[i >> 3]) & (1 << (i & 7)) - 1
            i = int(ranks[block]) + int(np.bitwise_count(head).sum()) + tail.bit_count()
            shift += 8
        return value

    def all(self) -> np.ndarray:
        out = np.zeros(len(self), np.uint32)
        at = np.arange(len(self))
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def _segments(path: str, end_id: int):
    """Rows (doc_id, text) in document order -> segment rows of this partition."""

    def run(batches):
        enc, part = encoder(path), TaskContext.get().partitionId()
        first, segment, held, docs, starts, n = 0, 0, [], [], [], 0

        def close():
            nonlocal first, segment, held, docs, starts, n
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([segment], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_ids": pa.array([n], pa.int64()),
                "payload": pa.array([dac_encode(np.concatenate(held))], pa.binary()),
                "doc_ids": pa.array([docs], pa.list_(pa.int64())), "doc_starts": pa.array([starts], pa.list_(pa.int64()))})
            first, segment, held, docs, starts, n = first + n, segment + 1, [], [], [], 0
            return row

        for batch in batches:
            for piece in text_slices(batch, "text", ENCODE_BYTES):
                ids, offsets = append_id(*enc.encode(piece.column("text")), end_id)
                at = 0
                ids_of = piece.column("doc_id").to_pylist()
                while at < len(ids_of):
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT_IDS - n, "left")))
                    to = min(to, len(ids_of))
                    docs += ids_of[at:to]
                    starts += (offsets[at:to] - offsets[at] + n).tolist()
                    held.append(ids[offsets[at]:offsets[to]])
                    n += int(offsets[to] - offsets[at])
                    if n >= SEGMENT_IDS:
                        yield close()
                    at = to
        if docs:
            yield close()

    return run


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, with `end_id` after each, in ascending id order.

    Documents are range-partitioned and sorted by id, so partition order is
    document order. Null text counts as empty (only the end id); a null id
    comes first; repeated ids keep one entry per row; an empty table writes an
    empty table of files."""
    vocabulary = vocabulary or default_vocabulary()
    rows = id_text(docs, id_col, text_col)
    rows = rows.repartitionByRange(F.asc("doc_id")).sortWithinPartitions(F.asc("doc_id"), F.asc("text"))
    rows.mapInArrow(_segments(vocabulary, end_id), SEGMENT).write.parquet(path)


def _digests(batches):
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda c: batch.column(c)[row].as_py()
            raw = memoryview(DacReader(get("payload")).all().astype("<u4").tobytes())
            starts = get("doc_starts")
            ends = starts[1:] + [get("n_ids")]
            first, part = get("first"), get("part")
            yield pa.RecordBatch.from_pydict({
                "part": [part] * len(starts), "doc_id": get("doc_ids"), "first": [first + s for s in starts],
                "n_tokens": [e - s for s, e in zip(starts, ends)],
                "ids_crc32": [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts, ends)]}, schema=schema)


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.schema(SEGMENT).parquet(path)
    # One row per partition of the writer; a running sum over them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    docs = files.mapInArrow(_digests, "part int, doc_id long, first long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read_token(spark: SparkSession, path: str, index: int) -> int:
    """The id at a global position: finds its segment by the segment heads,
    then reads it from the payload without decoding the block."""
    heads = spark.read.schema(SEGMENT).parquet(path).select("part", "segment", "first", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    at = F.lit(index) - F.col("base") - F.col("first")
    hit = heads.join(base, "part").where((at >= 0) & (at < F.col("n_ids"))).select("part", "segment", at.alias("at")).first()
    if hit is None:
        raise IndexError(index)
    row = spark.read.schema(SEGMENT).parquet(path).where((F.col("part") == hit["part"]) & (F.col("segment") == hit["segment"]))
    return DacReader(bytes(row.select("payload").first()[0]))[hit["at"]]


def op5_token_output(spark, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token_files")
    write_token_files(read_table(spark, sf_dir, "documents"), path)
    return read_token_digests(spark, path)
