"""Operator 2: removal of repeated 100-byte strings by induction from sampled suffixes.

A byte goes if a WINDOW-byte string that covers it also starts earlier. Order
is decided by sorting suffix tuples, not by one suffix array over all bytes:

* Sampled suffixes. A position is sampled if the hash of its HEAD bytes is the
  smallest of some window's; equal windows sample the same place. Each sampled
  suffix stands for the run of windows it is the leftmost minimum of.
* Sorting. Suffix tuples (head, common string of the run's windows, document,
  place) are sorted externally by Spark, which spills sorted runs and merges
  them through priority queues; equal neighbours share the whole span, so every
  tuple after the first of its span is a repeat, with all windows it stands for.
* Induction. A first tuple whose head occurs with another span shares a shorter
  prefix only. Its windows are induced from the sampled suffix in the next
  round, in runs of CHUNK windows (head: what all of them have in common), and
  then one by one. Each round sorts only what the one before left open.

Documents are written once, bucketed by row, and later rounds read them in
place: only tuples are shuffled. Equal tuples of a task are settled before the
shuffle, whole copies of a document before anything else, and heads that stand
in more than one in a hundred sampled documents are dealt by their span.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, read_table, shuffle_partitions, work_dir, written
from spanlake.llm.tokens import text_slices
from spanlake.llm.wordhash import _tables, mix, string_bytes

WINDOW = 100
HEAD = 32
CHUNK = 8
SAMPLE_DOCS = 4_000        # documents looked at for heads to deal out; no effect on results
HOT_SHARE = 100
NORMAL, HOT, DONE = 0, 1, 2
TUPLE = "part long, sub long, doc_id long, row long, item long, flag int"
OPEN = "row long, item long, flag int"
SLICE = 16 << 20
# item: first window << 14 | windows after it << 7 | sampled place - first window


def slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every `width` neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    span, y = 1, x
    while span * 2 <= width:
        y = op(y[:-span], y[span:])
        span *= 2
    n = len(x) - width + 1
    return op(y[:n], y[width - span:width - span + n]) if span < width else y


class Text:
    """Hashes of byte ranges of one text."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        _, values, self._powers, self._inverses = _tables(self.n + 1)
        self._sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values[data] * self._powers[:self.n], out=self._sums[1:])

    def range(self, a, b):
        return mix((self._sums[b] - self._sums[a]) * self._inverses[a] + (b - a).astype(np.uint64))

    def heads(self) -> np.ndarray:
        a = np.arange(self.n - HEAD + 1)
        return self.range(a, a + HEAD)

    def samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, first window, last window, head) of the sampled suffixes."""
        g = self.heads()
        width = WINDOW - HEAD + 1
        least = slide(g, width, np.minimum)
        # the leftmost minimum: the first place at or after p that holds the window's value
        picked = np.flatnonzero(slide(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]),
                                      width, np.maximum) == g)
        at = np.searchsorted(picked, np.arange(len(least)))
        wrong = np.flatnonzero(g[picked[at]] != least)
        while len(wrong):
            at[wrong] += 1
            wrong = wrong[g[picked[at[wrong]]] != least[wrong]]
        order = picked[at]
        first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
        last = np.append(first[1:], len(order)) - 1
        place = order[first]
        return place, first, last, g[place]


def _texts(piece):
    data, offsets = string_bytes(piece.column("text"))
    for k, row in enumerate(piece.column("row").to_pylist()):
        yield k, row, data[offsets[k]:offsets[k + 1]]


def _tuples(cols: dict[str, list]) -> pa.RecordBatch:
    """One batch of tuples. Of equal ones only the first stays open: the others
    have an earlier copy here and are marked done, dealt anywhere."""
    c = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in cols.items()}
    order = np.lexsort((c["item"], c["row"], c["doc_id"], c["sub"], c["part"]))
    c = {k: v[order] for k, v in c.items()}
    again = np.zeros(len(order), bool)
    again[1:] = (c["part"][1:] == c["part"][:-1]) & (c["sub"][1:] == c["sub"][:-1])
    c["flag"] = np.where(again, DONE, c["flag"]).astype(np.int32)
    c["part"] = np.where(again, mix((c["row"] * 31 + c["item"]).astype(np.uint64)).view(np.int64), c["part"])
    return pa.RecordBatch.from_pydict(c)


NULL_ID = np.iinfo(np.int64).max       # a null id comes last


def _rows_of(n, row, doc):
    return np.full(n, row, np.int64), np.full(n, NULL_ID if doc is None else doc, np.int64)


def _sample(hot: np.ndarray):
    """Documents -> tuples of their sampled suffixes."""

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE):
                cols = {k: [] for k in ("part", "sub", "doc_id", "row", "item", "flag")}
                ids = piece.column("doc_id").to_pylist()
                for k, row, data in _texts(piece):
                    if len(data) < WINDOW:
                        continue
                    text = Text(data)
                    place, first, last, head = text.samples()
                    span = text.range(first, last + WINDOW)
                    sub = mix(span ^ mix((place - first).astype(np.uint64)))
                    is_hot = np.isin(head, hot)
                    cols["part"].append(np.where(is_hot, mix(sub), head).view(np.int64))
                    cols["sub"].append(sub.view(np.int64))
                    rows, docs = _rows_of(len(place), row, ids[k])
                    cols["row"].append(rows)
                    cols["doc_id"].append(docs)
                    cols["item"].append(first << 14 | (last - first) << 7 | (place - first))
                    cols["flag"].append(np.where(is_hot, HOT, NORMAL))
                yield _tuples(cols)

    return run


def _induce(width: int):
    """Documents with open runs of windows -> tuples of runs of `width`."""

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE):
                cols = {k: [] for k in ("part", "sub", "doc_id", "row", "item", "flag")}
                ids = piece.column("doc_id").to_pylist()
                items, flags = piece.column("items").to_pylist(), piece.column("flags").to_pylist()
                for k, row, data in _texts(piece):
                    text = Text(data)
                    item, flag = np.array(items[k], np.int64), np.array(flags[k], np.int64)
                    first, more, off = item >> 14, item >> 7 & 127, item & 127
                    # Runs are cut by their distance from the sampled place, alike in every copy.
                    low, high = (off - more) // width, off // width
                    n = high - low + 1
                    which = np.repeat(np.arange(len(item)), n)
                    cell = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                    place = (first + off)[which]
                    a_full, b_full = place - (cell + 1) * width + 1, place - cell * width
                    a, b = np.maximum(a_full, first[which]), np.minimum(b_full, (first + more)[which])
                    head = text.range(place, place + HEAD)
                    core = mix(text.range(b_full, a_full + WINDOW) ^ mix(head + cell.astype(np.uint64)))
                    span = mix(text.range(a, b + WINDOW) ^ mix(head + ((place - a) * 128 + b - a).astype(np.uint64)))
                    is_hot = flag[which] == HOT
                    cols["part"].append(np.where(is_hot, mix(span), core).view(np.int64))
                    cols["sub"].append(span.view(np.int64))
                    rows, docs = _rows_of(len(a), row, ids[k])
                    cols["row"].append(rows)
                    cols["doc_id"].append(docs)
                    cols["item"].append(a << 14 | (b - a) << 7 | (place - a))
                    cols["flag"].append(flag[which])
                yield _tuples(cols)

    return run


def _settle(last: bool):
    """Sorted tuples -> repeats (DONE) and what stays open. The first tuple of
    a span is open if its head has other spans (or was dealt by span), unless
    this is the last round."""

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            part = table.column("part").to_numpy()
            cut = int(np.searchsorted(part, part[-1])) if len(part) else 0
            held = table.slice(cut)
            if cut:
                yield settle(table.slice(0, cut))
        if held is not None and held.num_rows:
            yield settle(held)

    def settle(table):
        part, sub, flag = (table.column(c).to_numpy() for c in ("part", "sub", "flag"))
        head = np.concatenate([[True], part[1:] != part[:-1]])
        fresh = head | np.concatenate([[True], sub[1:] != sub[:-1]])
        begins = np.flatnonzero(head)
        spans = np.repeat(np.add.reduceat(fresh.astype(np.int64), begins), np.diff(np.append(begins, len(part))))
        done = (flag == DONE) | ~fresh
        stays = done if last else done | (spans > 1) | (flag == HOT)
        out = table.select(["row", "item"]).append_column("flag", pa.array(np.where(done, DONE, flag).astype(np.int32)))
        return out.filter(pa.array(stays)).combine_chunks().to_batches(max_chunksize=1 << 30)[0] if stays.any() else \
            pa.RecordBatch.from_pydict({"row": pa.array([], pa.int64()), "item": pa.array([], pa.int64()), "flag": pa.array([], pa.int32())})

    return run


def _sorted_tuples(df: DataFrame) -> DataFrame:
    return df.repartition("part").sortWithinPartitions("part", "sub", "doc_id", "row", "item")


def _hot_heads(texts: DataFrame, sample_docs: int) -> np.ndarray:
    """Heads in more than one of HOT_SHARE sampled documents: at most
    HOT_SHARE times a document's number of sampled suffixes."""
    chosen = texts.select("row").orderBy(F.xxhash64("row")).limit(sample_docs)
    sample = texts.select("row", "doc_id", "text").join(F.broadcast(chosen), "row", "left_semi")

    def heads(batches):
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE):
                found = [np.unique(Text(d).samples()[3]) for _, _, d in _texts(piece) if len(d) >= WINDOW]
                yield pa.RecordBatch.from_pydict({"head": (np.concatenate(found) if found else np.zeros(0, np.uint64)).view(np.int64)})

    n = chosen.count()
    rows = (sample.mapInArrow(heads, "head long").groupBy("head").count()
            .where(F.col("count") > max(20, n // HOT_SHARE)).collect())
    return np.array([r["head"] for r in rows], np.int64).view(np.uint64)


def _remove(batches):
    """Documents with their repeats -> digests."""
    for batch in batches:
        for piece in text_slices(batch, "text", SLICE):
            items, copies = piece.column("items").to_pylist(), piece.column("copy").to_pylist()
            removed, runs, digest, size = [], [], [], []
            for k, _, data in _texts(piece):
                n = len(data)
                size.append(n)
                if copies[k] and n >= WINDOW:
                    gone = np.ones(n, bool)
                else:
                    edge = np.zeros(n + 1, np.int32)
                    item = np.array(items[k] or [], np.int64)
                    np.add.at(edge, item >> 14, 1)
                    np.add.at(edge, (item >> 14) + (item >> 7 & 127) + WINDOW, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                runs.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if n else 0)
                digest.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column("doc_id"), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(runs, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, copies, repeats): the bucketed documents (row, doc_id, text), the
    rows that repeat an earlier document whole (equal SHA-256, which cannot be
    made at will as md5 can), and items of repeated windows."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    name = f"suffix_texts_{uuid.uuid4().hex[:12]}"
    rows = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()).withColumn(
        "same", F.unhex(F.sha2("text", 256)))
    (rows.repartition(parts, "row").write.bucketBy(parts, "row")
     .option("path", work_dir(spark, "suffix_texts")).saveAsTable(name))
    texts = spark.table(name)
    first = texts.groupBy("same").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("f")).select(F.col("f.row").alias("row"))
    first = written(spark, first, "suffix_first")
    copies = texts.select("row").join(first, "row", "left_anti")

    own = texts.select("row", "doc_id", "text").join(first, "row", "left_semi")
    hot = _hot_heads(own, SAMPLE_DOCS)
    tuples = own.mapInArrow(_sample(hot), TUPLE)
    settled = written(spark, _sorted_tuples(tuples).mapInArrow(_settle(False), OPEN), "suffix_round1")
    repeats = settled.where(F.col("flag") == DONE)
    for k, width in enumerate((CHUNK, 1)):
        left = settled.where(F.col("flag") != DONE).groupBy("row").agg(F.collect_list(F.struct("item", "flag")).alias("o")).select(
            "row", F.col("o.item").alias("items"), F.col("o.flag").alias("flags"))     # one document's open runs
        tuples = texts.select("row", "doc_id", "text").join(left, "row").mapInArrow(_induce(width), TUPLE)
        settled = written(spark, _sorted_tuples(tuples).mapInArrow(_settle(width == 1), OPEN), f"suffix_round{k + 2}")
        repeats = repeats.unionByName(settled.where(F.col("flag") == DONE))
    return texts, copies, repeats


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null text counts as empty; texts under 100 bytes lose nothing, long ones are
    read whole; rows with
    the same id are ordered by an internal row number, null ids come last; an
    empty table gives an empty result; other columns are ignored."""
    texts, copies, repeats = find_repeats(docs, id_col, text_col)
    per_row = repeats.groupBy("row").agg(F.collect_list("item").alias("items"))
    joined = (texts.select("row", "doc_id", "text").join(per_row, "row", "left")
              .join(copies.withColumn("copy", F.lit(True)), "row", "left").withColumn("copy", F.coalesce("copy", F.lit(False))))
    return joined.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
