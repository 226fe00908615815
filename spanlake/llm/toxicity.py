"""Operator 8: toxicity severity by cumulative-link ordinal regression.

Model: P(grade > k) = sigmoid(w . x - theta_k) with one weight vector for all
ordered thresholds theta_0 < theta_1 < theta_2; the output is the expected
severity, the sum of these probabilities (0 to 3). Features x are sparse:
log(1 + count) of words and of word beginnings of four and five bytes (stems
of inflected or compounded terms), as 64-bit hashes.

Grades: the labels are binary, so grade 0 is not toxic, and toxic texts get
grade 1, 2 or 3 by the terciles, over the training sample, of how many
toxic-only terms they hold.

Training uses at most TRAIN_ROWS labelled rows (those with the smallest hash of
their id): feature counts by class are aggregated in Spark, the FEATURES
strongest ones are kept, and the model is fitted on the sample's counts of
those alone. Every document is then scored over its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.common import id_text, pick, read_table, written
from spanlake.llm.tokens import text_slices
from spanlake.llm.wordhash import Words, mix

TRAIN_ROWS = 8_000
FEATURES = 4_096
MIN_TOXIC = 3          # a feature stands in so many toxic training texts at least
MIN_ODDS = 8.0         # and is so many times as frequent in toxic texts as in others
PREFIXES = (4, 5)
GRADES = 3
STEPS = 400
TRAIN_BYTES = 1 << 19  # text whose features are counted at a time in training (memory only)


def _features(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every word and word beginning."""
    words = Words(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
    docs, feats = [doc], [words.hash]
    for k in PREFIXES:
        at, h = words.prefix(k)
        docs.append(doc[at])
        feats.append(mix(h + np.uint64(k)))
    return np.concatenate(docs), np.concatenate(feats)


def _class_counts(batches):
    """Per slice of a batch: texts that hold a feature, toxic and others."""
    for batch in (piece for whole in batches for piece in text_slices(whole, "text", TRAIN_BYTES)):
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        doc, feat = _features(batch.column("text"))
        pairs = np.unique(np.stack([feat, doc.astype(np.uint64)], 1), axis=0)
        feat, at, n = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        bad = np.add.reduceat(toxic[pairs[:, 1].astype(np.int64)] > 0, at) if len(at) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict({"feature": feat.view(np.int64), "bad": pa.array(bad, pa.int64()), "n": pa.array(n, pa.int64())})


class Counter:
    """Counts of the chosen features per text."""

    def __init__(self, features: np.ndarray):
        self.features = features            # sorted
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(features & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def __call__(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, feature number, count) of those that occur."""
        doc, feat = _features(texts)
        hit = np.flatnonzero(self.maybe[(feat & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(hit) or not len(self.features):
            none = np.zeros(0, np.int64)
            return none, none, none
        at = np.minimum(np.searchsorted(self.features, feat[hit]), len(self.features) - 1)
        ok = self.features[at] == feat[hit]
        cell, n = np.unique(doc[hit[ok]] * len(self.features) + at[ok], return_counts=True)
        return cell // len(self.features), cell % len(self.features), n


@dataclass
class Severity:
    """A fitted model; `thresholds` ascend."""
    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) per text and threshold."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -60, 60)))


def fit_ordinal(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int,
                l2: float = 1e-3, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood with shared weights by Adam. Thresholds are a first
    value plus positive gaps, so they stay in order."""
    n = len(grade)
    p = np.concatenate([np.zeros(n_features), [1.0], np.zeros(GRADES - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, first, gaps = p[:n_features], p[n_features], p[n_features + 1:]
        theta = first + np.concatenate([[0], np.cumsum(np.log1p(np.exp(gaps)))])
        score = np.bincount(doc, value * w[feature], n) if len(doc) else np.zeros(n)
        up = 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -50, 50)))
        low = np.concatenate([np.ones((n, 1)), up], 1)
        high = np.concatenate([up, np.zeros((n, 1))], 1)
        rows = np.arange(n)
        a, b = low[rows, grade], high[rows, grade]
        mass = np.maximum(a - b, 1e-9)
        da, db = a * (1 - a), b * (1 - b)          # sigmoid slopes at the grade's two thresholds
        d_score = (da - db) / mass
        d_theta = np.zeros(GRADES)
        for k in range(GRADES):
            d_theta[k] = -(da / mass)[grade == k + 1].sum() + (db / mass)[grade == k].sum()
        g = np.zeros_like(p)
        if len(doc):
            g[:n_features] = -np.bincount(feature, value * d_score[doc], n_features) / n + l2 * w
        g[n_features] = -d_theta.sum() / n
        slope = 1 / (1 + np.exp(-gaps))
        g[n_features + 1:] = -np.cumsum(d_theta[::-1])[::-1][1:] * slope / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    theta = p[n_features] + np.concatenate([[0], np.cumsum(np.log1p(np.exp(p[n_features + 1:])))])
    return p[:n_features], theta


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, features: int = FEATURES,
          id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", toxic_col: str = "toxic") -> Severity:
    """Fit on at most `train_rows` labelled documents, one row per id. Labels that
    are null or have no document are ignored; without toxic and other examples the model
    finds nothing toxic."""
    spark = docs.sparkSession
    marks = pick(labels, doc_id=label_id_col, toxic=toxic_col).where("toxic is not null and doc_id is not null")
    marks = (marks.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(train_rows))
    sample = id_text(docs, id_col, text_col).join(F.broadcast(marks), F.col("doc_id") == F.col("label_id")).select("doc_id", "toxic", "text")
    # Of rows with one id one is used, so that the sample is as bounded as its labels.
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    sample = written(spark, sample.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth"), "toxicity_sample")
    seen = {r["toxic"] > 0: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = seen.get(True, 0), seen.get(False, 0)
    nothing = Severity(np.zeros(0, np.uint64), np.zeros(0), np.array([20.0, 21.0, 22.0]))
    if not bad or not good:
        return nothing
    counts = (sample.select("toxic", "text").mapInArrow(_class_counts, "feature long, bad long, n long")
              .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")))
    odds = ((F.col("bad") + 0.5) / bad) / ((F.col("n") - F.col("bad") + 0.5) / good)
    best = (counts.where((F.col("bad") >= min(MIN_TOXIC, bad)) & (odds >= MIN_ODDS))
            .orderBy((F.col("bad") * F.log(odds)).desc(), "feature").limit(features).collect())
    if not best:
        return nothing
    chosen = np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
    # Of the sample, only the counts of the chosen features come to the driver.
    count = Counter(chosen)

    def cells(batches):
        for batch in (piece for whole in batches for piece in text_slices(whole, "text", TRAIN_BYTES)):
            d, f, n = count(batch.column("text"))
            rows = [([], []) for _ in range(batch.num_rows)]
            for i, k, c in zip(d.tolist(), f.tolist(), n.tolist()):
                rows[i][0].append(k)
                rows[i][1].append(c)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "f": pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                "c": pa.array([r[1] for r in rows], pa.list_(pa.int64()))})

    rows = sorted(sample.mapInArrow(cells, "doc_id long, toxic int, f array<long>, c array<long>").collect(), key=lambda r: (r["doc_id"], r["f"]))
    size = np.array([len(r["f"]) for r in rows])
    doc = np.repeat(np.arange(len(rows)), size)
    feature = np.array([x for r in rows for x in r["f"]], np.int64)
    value = np.array([x for r in rows for x in r["c"]], np.int64)
    toxic = np.array([r["toxic"] > 0 for r in rows])
    terms = np.bincount(doc, value, len(rows)) if len(doc) else np.zeros(len(rows))
    cuts = np.quantile(terms[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + (terms > cuts[0]) + (terms > cuts[1]), 0)
    weights, thresholds = fit_ordinal(doc, feature, np.log1p(value), grade, len(chosen))
    return Severity(chosen, weights, thresholds)


def severity(docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: doc_id, severity (expected grade), grade (the
    number of thresholds passed with probability 1/2), toxic (grade > 0).
    With `carry`, all columns of docs instead, plus these three under names
    prefixed with `_`.

    Null and empty texts have no features and are not toxic; repeated rows are
    scored alike; an empty table gives an empty result."""
    n = len(docs.columns)
    if carry:
        rows = docs.toDF(*[f"c{i}" for i in range(n)])
        text = f"c{docs.columns.index(text_col)}"
        rows = rows.withColumn("text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    else:
        rows = id_text(docs, id_col, text_col)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["severity double", "grade int", "toxic boolean"])
    count = Counter(model.features)

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, "text"):
                doc, feature, c = count(piece.column("text"))
                score = np.bincount(doc, np.log1p(c) * model.weights[feature], piece.num_rows) if len(doc) else np.zeros(piece.num_rows)
                p = model.exceed(score)
                grade = (p >= 0.5).sum(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(f.name) for f in kept] + [pa.array(np.round(p.sum(1), 6)), pa.array(grade), pa.array(grade > 0)],
                    names=[f.name for f in kept] + ["severity", "grade", "toxic"])

    out = rows.mapInArrow(run, schema)
    return out.toDF(*docs.columns, "_severity", "_grade", "_toxic") if carry else out


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return severity(docs, train(docs, read_table(spark, sf_dir, "labels")))
