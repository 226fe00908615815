"""Corpus pipeline: five stages over `documents`, each by an operator of spanlake.llm.

Every stage takes (spark, docs, sf_dir), works on all that the stage before
kept, and returns the columns of documents; the last returns packed pieces.
Between stages the rows are written as Parquet and read again. Stages drop by
row, not by id, so null and repeated ids are safe: null texts count as empty
(not toxic, no words, no contamination) and of equal texts one row stays. An
empty table passes through every stage; extra columns are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from spanlake.llm.common import read_table, written


def _numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number per row: the row's place in its file and the file's
    number, so that it stays the same however a job splits the files (by the
    cores registered at that moment). What is not a plain scan is written first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = written(spark, docs, "pipeline_rows")
    row, path, file, name = (f"_{x}_{uuid.uuid4().hex[:8]}" for x in ("row", "path", "file", "name"))
    meta = docs.metadataColumn("_metadata")          # the file's, also where a column has that name
    paths = sorted(r[0] for r in docs.select(meta["file_path"]).distinct().collect())
    files = spark.createDataFrame(list(zip(paths, range(len(paths)))), f"{name} string, {file} long")
    rows = docs.select("*", meta["file_path"].alias(path), meta["row_index"].alias(row))
    rows = rows.join(F.broadcast(files), F.col(path) == F.col(name))
    return rows.select(*(rows[c] for c in docs.columns), (F.shiftleft(file, 40) + F.col(row)).alias(row)), row


def _without(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    return docs.join(dropped.select(F.col(dropped.columns[0]).alias(row)), row, "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ordinal regression fitted on the labelled documents; rejects grade 1 and up."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.severity(docs, model, carry=True)
    names = [f"c{i}" for i in range(len(scored.columns))]
    return scored.toDF(*names).where(~F.col(names[-1])).select(*names[:len(docs.columns)]).toDF(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original with the smallest id stays."""
    rows, row = _numbered(spark, docs)
    found = exact_dedup.exact_dedup(rows, row_col=row)
    return _without(rows, row, found.where(~F.col("kept")).select("row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each connected group of near duplicates stays."""
    rows, row = _numbered(spark, docs)
    members, edges = jaccard_join.jaccard_join(rows, id_col=row)
    groups = jaccard_join.components(edges)
    copies = members.where(F.col("doc_id") != F.col("class_id")).select("doc_id")
    return _without(rows, row, copies.unionByName(groups.where(F.col("id") != F.col("group")).select(F.col("id").alias("doc_id"))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    rows, row = _numbered(spark, docs)
    found = decontamination.contamination(rows, read_table(spark, sf_dir, "benchmark"), id_col=row)
    return _without(rows, row, found.where(F.col("n_hit") > 0).select("doc_id"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences."""
    return packing.pack(docs, cache_pieces=200_000, slice_bytes=2 << 20)    # memory only: earlier stages share the workers


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

# Fitted models, chosen paths and tokenization are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
