"""Operator 13: how corpus filters overlap, for every order of applying them.

Five filters look at a text: A too few words, B too few distinct words, C too
many capitals, D a forbidden symbol, E an earlier identical text anywhere.

A to D come from one pass of a byte transducer. Its transition table maps
(class of the byte before, class of this byte) to what the step emits: a word
begins, a word ends, a capital, a code point, a symbol. The state is the class
of the last byte alone, so the table is applied to a whole batch of UTF-8 at
once. Word spans go into a hash table per text that compares the bytes behind
equal hashes (a set of byte strings).

A text leaves the task as a mask of A to D and a SHA-256; E needs no join:
rows are counted per (text digest, part, mask, labels) with the smallest id,
and of a digest's few rows all fail but those at the smallest. What is left is
a count per (part, mask, labels), at most 32 masks a part, which is played
through all 120 orders. No step gathers the rows of a text, part or key.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.common import pick, read_table
from spanlake.llm.tokens import text_slices
from spanlake.llm.wordhash import string_bytes

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50      # per cent of the words
MOST_CAPITALS = 3        # per cent of the code points
SYMBOLS = b"#$%&*|"
SPREAD = 4096            # shares into which rows without an id are dealt
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"

# Byte classes = states. EDGE stands between texts.
EDGE, SPACE, PLAIN, CAPITAL, SYMBOL, TAIL = range(6)
BEGINS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16

FOUND = "doc_id long, part string, sha binary, mask int, n_words long, n_distinct long, n_capitals long, n_points long"


def byte_classes() -> np.ndarray:
    """Class of every byte value; TAIL are the bytes that continue a code point."""
    out = np.full(256, PLAIN, np.uint8)
    out[list(WHITE)] = SPACE
    out[0x41:0x5B] = CAPITAL
    out[list(SYMBOLS)] = SYMBOL
    out[0x80:0xC0] = TAIL
    return out


def transitions() -> np.ndarray:
    """What a step from one class to another emits, as table[before * 6 + now]."""
    table = np.zeros((6, 6), np.uint8)
    word = [PLAIN, CAPITAL, SYMBOL, TAIL]
    for before in range(6):
        for now in range(6):
            out = 0
            out |= BEGINS * (now in word and before not in word)
            out |= ENDS * (now not in word and before in word)
            out |= IS_CAPITAL * (now == CAPITAL)
            out |= IS_POINT * (now not in (EDGE, TAIL))
            out |= IS_SYMBOL * (now == SYMBOL)
            table[before, now] = out
    return table.ravel()


def transduce(texts: pa.StringArray, classes: np.ndarray, table: np.ndarray):
    """Per text: words, distinct words, capitals, code points, symbols."""
    data, offsets = string_bytes(texts)
    n = len(offsets) - 1
    # An EDGE before every text and after the last.
    begin = offsets[:-1] + np.arange(n) + 1
    end = begin + np.diff(offsets)
    state = np.full(len(data) + n + 1, EDGE, np.uint8)
    inside = np.ones(len(state), bool)
    inside[begin - 1] = False
    inside[-1] = False
    state[inside] = classes[data]
    emitted = table[state[:-1] * np.uint8(6) + state[1:]]      # of the step into byte 1, 2, ...
    del state, inside

    def counts(bit):
        at = np.flatnonzero(emitted & bit) + 1
        return np.searchsorted(at, end) - np.searchsorted(at, begin)

    starts, stops = np.flatnonzero(emitted & BEGINS) + 1, np.flatnonzero(emitted & ENDS) + 1
    first = np.searchsorted(starts, begin)
    last = np.searchsorted(starts, end)
    raw = data.tobytes()
    distinct = np.zeros(n, np.int64)
    for i in range(n):
        a, b, shift = first[i], last[i], i + 1
        distinct[i] = len({raw[x:y] for x, y in zip((starts[a:b] - shift).tolist(), (stops[a:b] - shift).tolist())})
    return last - first, distinct, counts(IS_CAPITAL), counts(IS_POINT), counts(IS_SYMBOL)


def _measure(batches):
    classes, table = byte_classes(), transitions()
    for batch in batches:
        for piece in text_slices(batch, "text"):
            words, distinct, capitals, points, symbols = transduce(piece.column("text"), classes, table)
            fails = [words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points, symbols > 0]
            mask = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
            sha = [hashlib.sha256(x.as_buffer()).digest() for x in piece.column("text")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column("doc_id"), "part": piece.column("part"), "sha": pa.array(sha, pa.binary()), "mask": pa.array(mask, pa.int32()),
                "n_words": words, "n_distinct": distinct, "n_capitals": capitals, "n_points": points})


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, part, sha (of the text), mask (bits 0 to 3:
    fails A, B, C, D), n_words, n_distinct, n_capitals, n_points."""
    base = pick(docs, doc_id=id_col, text=text_col, part=part_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"))
    return base.mapInArrow(_measure, FOUND)


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Documents per part, mask (bits 0 to 4: fails A to E), good and toxic."""
    marks = pick(labels, doc_id="doc_id", quality="quality", toxic="toxic").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    # Rows without an id have no label; they are spread, not sent to one task.
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).otherwise(0)
    found = measure(docs, id_col, text_col, part_col).withColumn("spread", spread)
    rows = found.join(marks.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left").select(
        "doc_id", "spread", "part", "sha", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("toxic"))
    keys = ["sha", "part", "mask", "good", "toxic"]
    # Rows of one id first, so that the copies of a text are summed before they meet.
    each = rows.groupBy("doc_id", "spread", *keys).agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    texts = each.groupBy(*keys).agg(F.sum("n").alias("n"), least.alias("least"),
                                    F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("least.doc_id").over(Window.partitionBy("sha"))
    texts = texts.withColumn("own", F.col("nameless") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0))
    either = F.explode(F.array(F.struct(F.col("own").alias("n"), F.lit(0).alias("e")),
                               F.struct((F.col("n") - F.col("own")).alias("n"), F.lit(1 << 4).alias("e"))))
    split = texts.select("part", "mask", "good", "toxic", either.alias("x"))
    return split.groupBy("part", (F.col("mask") + F.col("x.e")).alias("mask"), "good", "toxic").agg(
        F.sum("x.n").alias("n")).where("n > 0")


def order_effects(counts: DataFrame) -> DataFrame:
    """Every order of the filters played on the counts per part and mask."""
    parts = counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for k, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            steps.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bit).alias("bit"), F.lit(before).alias("before")))
            before |= bit
    s = parts.select("*", F.explode(F.array(*steps)).alias("s"))
    fails = F.col("mask").bitwiseAND(F.col("s.bit")) > 0
    there = F.col("mask").bitwiseAND(F.col("s.before")) == 0
    total = lambda what, where: F.sum(F.when(where, F.col(what)).otherwise(0)).cast("long")
    out = s.groupBy("part", "s.filter_order", "s.step").agg(
        total("n", there & ~fails).alias("kept"), total("n", there & fails).alias("removed"), total("n", ~there & fails).alias("redundant"),
        total("n", F.col("mask") == F.col("s.bit")).alias("unique_fails"), total("good", there & fails).alias("good_lost"),
        total("toxic", there & fails).alias("toxic_lost"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, filter_order (120 of them) and step (1 to 5): kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null and empty texts are the same text without words (A fails, and E if an
    earlier one is there); null parts count with empty ones; a null id is no
    earlier document and has no earlier one, and no label; rows of the same id
    and text do not precede each other; an id with several labels is good (or
    toxic) if one of them says so; very long texts are counted whole; an empty
    table has no parts and gives an empty result; other columns are ignored."""
    return order_effects(failure_counts(docs, labels, id_col, text_col, part_col))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(words) < 200)::INT
         + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * (coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false))::INT AS mask
  FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x) JOIN l d ON d.x NOT IN (a.x, b.x, c.x)
  JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT range::INT AS step FROM range(1, 6))),
r AS (
  SELECT part, filter_order, step,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT *, sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley FROM r
"""
