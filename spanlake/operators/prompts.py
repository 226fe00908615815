"""Instruction fingerprints, prompt versions and snapshot files.

Prompt versioning (E7) is a change-detection scan per project ordered by time,
run as a bucketed two-level scan (functions/scans.py) so a hot project is not
scanned by a single task.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.functions.exprs import commit_message, sha_or_none, strip_ws
from spanlake.functions.scans import change_versions
from spanlake.schema import SNAPSHOT

# Fixed values that must equal the reference's.
DEFAULT_PROMPT_NAME = "main.default.claude_md"
SKILL_FILE = "SKILL.md"
DAY_MS = 86_400_000


# ---- X6 / E6 / A9 ---------------------------------------------------------------

def content_hash(content: Column) -> Column:
    """SHA-256 hex of the content, 'none' when absent."""
    return sha_or_none(content)


def ordered_concat_digest(df: DataFrame, group: str, key: str, content: str) -> DataFrame:
    """Per group, SHA-256 of the parts sorted by key, each `key\\ncontent`,
    joined by NUL. Groups are hash-partitioned and sorted by key inside each
    partition (Spark's external sort spills); a Python task then streams the
    sorted rows through hashlib. Returns (group, digest, n_parts)."""
    d = (df.select(F.col(group).cast("string").alias("g"), F.col(key).cast("string").alias("k"),
                   F.col(content).cast("string").alias("c"))
         .repartition("g").sortWithinPartitions("g", "k"))

    # Defined here so it is shipped to the Python workers by value: the
    # executors do not need this package installed.
    def _digest_partition(batches):
        """Stream rows sorted by (group, key); one SHA-256 per group.

        Memory is one Arrow batch; the digest state is carried across batches, so a
        group of any size is hashed without being gathered into one row.
        """
        cur, h, n = None, None, 0
        out_g, out_h, out_n = [], [], []
        for pdf in batches:
            for g, k, c in zip(pdf["g"], pdf["k"], pdf["c"]):
                if g != cur:
                    if cur is not None:
                        out_g.append(cur); out_h.append(h.hexdigest()); out_n.append(n)
                    cur, h, n = g, hashlib.sha256(), 0
                if n:
                    h.update(b"\0")
                h.update(f"{k}\n{c}".encode("utf-8", "surrogatepass"))
                n += 1
            if len(out_g) >= 1024:
                yield pd.DataFrame({"g": out_g, "digest": out_h, "n_parts": out_n})
                out_g, out_h, out_n = [], [], []
        if cur is not None:
            out_g.append(cur); out_h.append(h.hexdigest()); out_n.append(n)
        if out_g:
            yield pd.DataFrame({"g": out_g, "digest": out_h, "n_parts": out_n})

    return d.mapInPandas(_digest_partition, "g string, digest string, n_parts long").withColumnRenamed("g", group)


def prompts_hash(prompts: Column) -> Column:
    """A9 of one snapshot's own files, a map of key to content: 'none' if empty."""
    parts = F.transform(F.array_sort(F.map_entries(prompts)), lambda e: F.concat(e["key"], F.lit("\n"), e["value"]))
    return F.when(F.size(prompts) > 0, F.sha2(F.array_join(parts, "\0"), 256)).otherwise(F.lit("none"))


def skills_hash(parts: DataFrame, groups: DataFrame | None = None, group: str = "project",
                key: str = "key", content: str = "content") -> DataFrame:
    """Skills fingerprint per group; a group without files gets 'none'."""
    dig = ordered_concat_digest(parts, group, key, content)
    if groups is None:
        return dig.select(group, F.col("digest").alias("skills_hash"), "n_parts")
    return (groups.select(group).distinct().join(dig, group, "left")
            .select(group, F.coalesce("digest", F.lit("none")).alias("skills_hash"),
                    F.coalesce("n_parts", F.lit(0)).alias("n_parts")))


# ---- S7: skill files ------------------------------------------------------------------

def qualified_path(spark: SparkSession, path: str):
    """(file system, Path with scheme and authority) of any path Spark can read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def first_per_path(roots: DataFrame, path: str = "path", ordinal: str = "ordinal") -> DataFrame:
    """W5 for a table of roots: of the rows that name one absolute path (a
    trailing slash and repeated slashes don't count) the one with the smallest
    ordinal stays (null before all), of equal ordinals the smallest other columns;
    a null path is dropped. A partial aggregate, no window over a popular path."""
    at = F.regexp_replace(F.regexp_replace(F.col(path), "/+", "/"), "(?<=.)/$", "")
    rest = [c for c in roots.columns if c not in (path, ordinal)]
    kept = roots.filter(F.col(path).isNotNull()).groupBy(at.alias("_at")).agg(F.min(F.struct(ordinal, *rest)).alias("_row"))
    return kept.select(F.col("_at").alias(path), "_row.*").select(*roots.columns)


def scan_skill_files(spark: SparkSession, roots: list[tuple[str, str]]) -> DataFrame:
    """Every SKILL.md under the roots -> (key = label/relpath, content).

    Roots are (label, path) on any file system; a path named twice (W5) counts
    under its first label, one that does not exist has no files. Listing and
    reading are distributed (binaryFile source); files that are not valid UTF-8
    are skipped, and line ends are normalised to '\\n' as a text-mode read would."""
    labels: dict[str, str] = {}
    for label, root in roots:
        fs, path = qualified_path(spark, root)
        if fs.exists(path):
            labels.setdefault(path.toString().rstrip("/"), label)
    out = spark.createDataFrame([], "key string, content string")
    text = F.col("content").cast("string")
    for base, label in labels.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", SKILL_FILE).load(base))
        rel = F.substring("path", len(base) + 2, 1 << 30)
        out = out.unionByName(files.filter(F.is_valid_utf8(text)).select(
            F.concat(F.lit(label + "/"), rel).alias("key"), F.regexp_replace(text, "\r\n?", "\n").alias("content")))
    return out


# ---- E7: prompt versions -----------------------------------------------------------------

def assign_prompt_versions(snapshots: DataFrame, project: str = "project", content: str = "instructions",
                           order: tuple[str, ...] = ("snapshot_ms", "session_id"),
                           name_prefix: str = DEFAULT_PROMPT_NAME, bucket_ms: int = DAY_MS) -> DataFrame:
    """Version per snapshot of each project's instruction text.

    New version iff the text differs from the latest registered text (A->B->A
    gives 3 versions); empty/absent text gives (NULL, NULL) and leaves the
    latest unchanged. Texts are compared by SHA-256 (the snapshot's own
    `<content>_hash` if there is one), so a query that does not return them
    does not read them. Adds prompt_name, prompt_version, is_new_version and the
    registration metadata commit_message (X10)."""
    own = f"{content}_hash"
    digest = F.col(own) if own in snapshots.columns else content_hash(F.nullif(F.col(content), F.lit("")))
    snapshots = snapshots.withColumn("_digest", digest)
    has = F.coalesce(F.col("_digest") != "none", F.lit(False))
    nonempty = snapshots.filter(has)
    empty = snapshots.filter(~has).drop("_digest")
    bucket = F.floor(F.col(order[0]) / F.lit(bucket_ms))
    v = change_versions(nonempty, project, list(order), "_digest", bucket, out="prompt_version").drop("_digest")
    v = v.withColumn("prompt_name", F.concat(F.lit(name_prefix + "."), F.col(project)))
    e = (empty.withColumn("prompt_version", F.lit(None).cast("int"))
         .withColumn("is_new_version", F.lit(False))
         .withColumn("prompt_name", F.lit(None).cast("string")))
    out = v.unionByName(e)
    return out.withColumn("commit_message", commit_message("git_sha"))


# ---- S5 / S6: snapshot files ------------------------------------------------------------------

def snapshot_rows(env: DataFrame) -> DataFrame:
    """Fixture snapshots (with E7 versions) in the snapshot-file schema."""
    from spanlake.functions.exprs import iso_utc
    return env.select(
        "session_id", "git_sha", "git_dirty",
        F.col("instructions_hash").alias("claude_md_hash"),
        F.col("instructions").alias("claude_md_content"),
        "skills_hash",
        "skills_prompts",
        "prompt_name", F.col("prompt_version").cast("int").alias("prompt_version"),
        iso_utc("snapshot_ms").alias("snapshot_timestamp"),
    )


def write_snapshots(snapshots: DataFrame, path: str, mode: str = "append") -> None:
    """Append snapshot objects as JSON, partitioned by snapshot date."""
    (snapshots.withColumn("snapshot_date", F.substring("snapshot_timestamp", 1, 10))
     .write.mode(mode).partitionBy("snapshot_date").json(path))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot JSON files; corrupt records are dropped (missing/corrupt -> no snapshot)."""
    schema = T.StructType(SNAPSHOT.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", "false")
          .json(path))
    # files are named env_{session_id}.json: the name backs up a missing field
    from_name = F.regexp_extract(F.col("_metadata.file_name"), r"^env_(.*)\.json$", 1)
    return (df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
            .withColumn("session_id", F.coalesce(F.col("session_id"), F.nullif(from_name, F.lit("")))))


# ---- E10: snapshot normalisation ----------------------------------------------------------------

def normalise_snapshot(raw: DataFrame) -> DataFrame:
    """Git state from captured command output.

    `head` = `git rev-parse HEAD` output (NULL when not a repo), `porcelain` =
    `git status --porcelain` output. Not a repo -> ('none', 'none'); else the
    stripped sha and 'true' iff porcelain has non-blank text."""
    head = strip_ws("head")
    repo = F.coalesce(head != "", F.lit(False))
    dirty = F.coalesce(strip_ws("porcelain") != "", F.lit(False))
    return raw.select(
        "*",
        F.when(repo, head).otherwise(F.lit("none")).alias("git_sha"),
        F.when(repo, F.when(dirty, "true").otherwise("false")).otherwise(F.lit("none")).alias("git_dirty"),
    )
