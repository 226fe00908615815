"""Operator 1: exact dedup by content sort (DataFrame functions only).

Every text is normalised (ASCII white space deleted) and the rows are
range-partitioned on the normalised bytes by sampled splitters; Spark's
external sort puts equal texts next to each other, and a window that compares
each row's whole text with its neighbour's closes one group per run of equals.

* The range key is (first bytes, 64-bit hash, salt): splitters stay a few
  bytes long however long the texts are, and a common first line cannot pile
  up in one range. The sort and the group comparison use the whole text.
* A text that holds more than a quarter of an average partition is hot. Its
  copies are dealt over salts, each salt's run gives one representative, and
  the representatives are sorted and compared once more. Texts are never
  shuffled again after that: the copies follow by their representative's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.llm.common import pick, shuffle_partitions, written

WHITE = " \t\n\x0b\x0c\r"
KEY_CHARS = 24


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def _runs(df: DataFrame) -> DataFrame:
    """Range partition, sort, and close runs of equal (norm, salt). Adds `rep`
    (the row that stays of the run) and `run` (its summed weight)."""
    keys = ["prefix", "hash", "salt"]
    df = df.repartitionByRange(*keys)
    whole = Window.partitionBy(*keys, "norm").orderBy(F.desc("chars"), F.asc_nulls_last("doc_id"), F.asc("row"))
    everything = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (df.withColumn("rep", F.first(F.struct("doc_id", "row", "chars")).over(everything))
              .withColumn("run", F.sum("weight").over(everything)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, row, keep_id, group_size, kept, text_sha256.
    `row` is `row_col`, a unique number of the row, or an internal one.

    Equal texts: identical after deleting ASCII white space. The row with the
    most code points in the original text stays, then the smallest id; among
    repeated rows with the same id and text exactly one stays. Null text counts
    as empty and groups with other empty texts; a null id sorts last; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    row = {"row": row_col} if row_col else {}
    base = pick(docs, doc_id=id_col, text=text_col, **row)
    if not row:
        base = base.withColumn("row", F.monotonically_increasing_id())
    base = base.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "row")
    base = base.select("doc_id", "row", F.length("text").alias("chars"), normalised(F.col("text")).alias("norm"))
    base = base.withColumn("hash", F.xxhash64("norm"))

    parts = shuffle_partitions(spark)
    total = base.count()
    limit = max(64, total // (4 * parts))
    # Fewer than 4 * parts keys can pass the limit, so this list is small at any size.
    hot = (base.groupBy("hash").count().where(F.col("count") > limit)
           .select("hash", F.ceil(F.col("count") / F.lit(limit)).cast("int").alias("salts")))
    rows = base.join(F.broadcast(hot), "hash", "left")
    spread = F.pmod(F.xxhash64("doc_id", "row"), F.col("salts")).cast("int")
    rows = (rows.withColumn("salt", F.when(F.col("salts").isNull(), F.lit(-1)).otherwise(spread))
            .withColumn("prefix", F.substring("norm", 1, KEY_CHARS))
            .withColumn("weight", F.lit(1).cast("long")))
    first = _runs(rows.select("doc_id", "row", "chars", "norm", "hash", "salt", "prefix", "weight"))
    first = first.select("doc_id", "row", "salt", "rep", "run",
                         F.when((F.col("row") == F.col("rep.row")), F.col("norm")).alias("norm"),
                         F.when((F.col("row") == F.col("rep.row")) | (F.col("salt") < 0),
                                F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"))
    first = first.withColumn("norm", F.when(F.col("salt") >= 0, F.col("norm")))
    first = written(spark, first, "exact_dedup")

    calm = first.where("salt < 0").select(
        "doc_id", "row", F.col("rep.doc_id").alias("keep_id"), F.col("run").alias("group_size"),
        (F.col("row") == F.col("rep.row")).alias("kept"), F.col("sha").alias("text_sha256"))

    # The salts of a hot text meet once more: at most (salts per text) * (hot texts) rows.
    reps = first.where("salt >= 0 and norm is not null").select(
        "doc_id", "row", F.col("rep.chars").alias("chars"), "norm", F.xxhash64("norm").alias("hash"),
        F.lit(0).alias("salt"), F.substring("norm", 1, KEY_CHARS).alias("prefix"), F.col("run").alias("weight"), "sha")
    final = _runs(reps).select(F.col("row").alias("rep_row"), F.col("rep").alias("top"),
                               F.col("run").alias("size"), F.col("sha").alias("top_sha"))
    members = first.where("salt >= 0").select("doc_id", "row", F.col("rep.row").alias("rep_row"))
    hot_rows = members.join(F.broadcast(final), "rep_row").select(
        "doc_id", "row", F.col("top.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("top.row")).alias("kept"), F.col("top_sha").alias("text_sha256"))
    return calm.unionByName(hot_rows)


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from spanlake.llm.common import read_table
    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("row")


OP1_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, length(text) AS chars, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS norm FROM t)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""
