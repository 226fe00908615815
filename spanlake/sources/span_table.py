"""S10 / ST3 / C3: a span table with versions, a change feed and a folded base.

A version is a folder of change rows (whole spans with the kind of change and
the version) and one small entry under `_log`. The entry is written last, by a
rename that fails if the version exists: a writer that dies leaves a folder
that no entry names, and two writers cannot make the same version.

Folding rewrites the small folders into one and publishes which folders make up
the table from then on. It takes insert-only versions with base folders of
about their size, so a row is rewritten a logarithmic number of times and
a table has a logarithmic number of folders. Folders of folded versions stay,
for the change feed and for running readers, until `vacuum` drops them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.schema import SPAN, SPAN_COLUMNS

INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"
KEYS = ["trace_id", "span_id"]
CHANGES = T.StructType([*SPAN.fields, T.StructField("change", T.StringType()), T.StructField("version", T.LongType())])


def file_system(spark: SparkSession, path: str):
    """(file system, Path) of any path that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


class SpanTable:
    """The table in a folder of any file system that Spark reads; a missing
    folder is an empty table at version 0."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._fs, self._log = file_system(spark, f"{self.path}/_log")

    # ---- the log ----

    def _entries(self) -> tuple[dict[int, str], dict[int, str]]:
        """File names of the versions and of the bases, by version."""
        if not self._fs.exists(self._log):
            return {}, {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._log)]
        named = lambda end: {int(n.split(".")[0]): n for n in names if n.split(".", 1)[1:] == [end]}
        return named("version.json"), named("base.json")

    def _entry(self, name: str) -> dict:
        stream = self._fs.open(self._hadoop.fs.Path(self._log, name))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, name: str, entry: dict) -> None:
        """Raises FileAlreadyExistsException if the entry is there."""
        part = self._hadoop.fs.Path(self._log, f"_{uuid.uuid4().hex}")
        out = self._fs.create(part)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = self._hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop.fs, "Options$Rename"), 0)
        context.rename(self._fs.makeQualified(part), self._fs.makeQualified(self._hadoop.fs.Path(self._log, name)), none)

    def _state(self, version: int | None = None) -> tuple[dict, list[dict]]:
        """(base entry, entries of the later versions up to `version`)."""
        versions, bases = self._entries()
        last = max([0, *versions, *bases]) if version is None else version
        if version is not None and version not in versions | bases and version != 0:
            raise ValueError(f"{self.path} has no version {version}")
        at = max((b for b in bases if b <= last), default=0)
        base = self._entry(bases[at]) if at else {"version": 0, "folders": [], "batch": -1}
        missing = [v for v in range(at + 1, last + 1) if v not in versions]
        if missing:
            raise ValueError(f"{self.path}: version {missing[0]} was vacuumed")
        return base, [self._entry(versions[v]) for v in range(at + 1, last + 1)]

    def version(self) -> int:
        versions, bases = self._entries()
        return max([0, *versions, *bases])

    def batch(self) -> int:
        """The highest batch id that a version was made with, -1 for none."""
        base, later = self._state()
        return max([base["batch"], *(e["batch"] for e in later)])

    def unfolded(self) -> int:
        """Versions since the last base."""
        return len(self._state()[1])

    def size(self) -> int:
        """Bytes of the folders that make up the table now."""
        base, later = self._state()
        folders = base["folders"] + [f for e in later for f in e["folders"]]
        return sum(self._fs.getContentSummary(self._hadoop.fs.Path(f"{self.path}/{name}")).getLength() for name, _ in folders)

    # ---- reading ----

    def _rows(self, folders: list) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], CHANGES)
        return self.spark.read.schema(CHANGES).parquet(*(f"{self.path}/{name}" for name, _ in folders))

    def read(self, version: int | None = None) -> DataFrame:
        """The spans at a version, each with the version that wrote it."""
        base, later = self._state(version)
        rows = self._rows(base["folders"] + [f for e in later for f in e["folders"]])
        if all(e["kinds"] == [INSERT] for e in later):
            return rows.drop("change")
        # Updates and deletes since the base are few against the table: their
        # keys are joined to it, so its rows are not regrouped.
        changed = self._rows([f for e in later if e["kinds"] != [INSERT] for f in e["folders"]])
        last = changed.filter(F.col("change").isin(AFTER, DELETE)).groupBy(*KEYS).agg(F.max("version").alias("last"))
        last = last.select(*(F.col(k).alias(f"k_{k}") for k in KEYS), "last")
        same = [rows[k].eqNullSafe(last[f"k_{k}"]) for k in KEYS]
        return (rows.filter(F.col("change").isin(INSERT, AFTER)).join(last, same, "left")
                .filter(F.col("last").isNull() | (F.col("version") >= F.col("last"))).select(*SPAN_COLUMNS, "version"))

    def changes(self, after: int, to: int | None = None) -> DataFrame:
        """The change rows of the versions after `after` up to `to`."""
        versions, bases = self._entries()
        to = self.version() if to is None else to
        missing = [v for v in range(after + 1, to + 1) if v not in versions]
        if missing:
            raise ValueError(f"{self.path}: version {missing[0]} is not there, or was vacuumed")
        return self._rows([f for v in range(after + 1, to + 1) for f in self._entry(versions[v])["folders"]])

    # ---- writing ----

    def _folder(self, rows: DataFrame) -> list:
        """[[name, rows]] of a new folder, [] if there are none."""
        name = f"part-{uuid.uuid4().hex}"
        rows.select(*CHANGES.fieldNames()).write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        n = self._rows([[name, 0]]).count()          # from the footers
        return [[name, n]] if n else []

    def commit(self, changes: DataFrame, kinds: list[str], batch: int = -1) -> int:
        """A new version of rows with a `change` column; its number."""
        version = self.version() + 1
        folders = self._folder(changes.withColumn("version", F.lit(version).cast("long")))
        self._publish(f"{version:012d}.version.json", {"version": version, "folders": folders, "kinds": kinds, "batch": batch})
        return version

    def append(self, spans: DataFrame, batch: int = -1) -> int:
        return self.commit(spans.withColumn("change", F.lit(INSERT)), [INSERT], batch)

    def upsert_tags(self, tags: DataFrame) -> int:
        """Set tags (trace_id, key, value; one row per trace and key) on the
        spans of their traces; spans whose tags stay the same don't change."""
        new = tags.groupBy("trace_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("new_tags"))
        old = F.coalesce("tags", F.create_map().cast("map<string,string>"))
        merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(F.col("new_tags"), k)), F.col("new_tags"))
        differs = F.exists(F.map_entries("new_tags"), lambda e: ~F.coalesce(F.element_at(old, e["key"]).eqNullSafe(e["value"]), F.lit(False)))
        hit = self.read().drop("version").join(new, "trace_id").filter(differs)
        images = F.explode(F.array(F.struct(F.lit(BEFORE).alias("change"), F.col("tags")),
                                   F.struct(F.lit(AFTER).alias("change"), merged.alias("tags"))))
        both = hit.withColumn("image", images).withColumns({"change": F.col("image.change"), "tags": F.col("image.tags")})
        return self.commit(both, [BEFORE, AFTER])

    def delete(self, condition: Column) -> int:
        return self.commit(self.read().drop("version").filter(condition).withColumn("change", F.lit(DELETE)), [DELETE])

    def fold(self) -> None:
        """Publish a base at the current version. Insert-only versions go into
        one folder with the base folders of up to twice their rows; after
        updates or deletes all rows are rewritten. Stopped half-way it has
        published nothing; at a version that has a base it does nothing."""
        base, later = self._state()
        if not later:
            return
        at = later[-1]["version"]
        kept = []
        if all(e["kinds"] == [INSERT] for e in later):
            fresh = [f for e in later for f in e["folders"]]
            for folder in sorted(base["folders"], key=lambda f: f[1]):
                (fresh if folder[1] <= 2 * sum(n for _, n in fresh) else kept).append(folder)
            rows = self._rows(fresh)      # a scan packs small files into its splits: no shuffle
        else:
            rows = self.read(at).withColumn("change", F.lit(INSERT))
        made = self._folder(rows.sortWithinPartitions("trace_id", "start_time_ms"))
        self._publish(f"{at:012d}.base.json", {"version": at, "folders": kept + made, "batch": max([base["batch"], *(e["batch"] for e in later)])})

    def vacuum(self, keep: int) -> None:
        """Drop versions and bases that no read of the last `keep` versions
        needs: first their entries, then the folders that only they name."""
        versions, bases = self._entries()
        oldest = max((b for b in bases if b <= self.version() - keep), default=0)
        gone = [n for v, n in versions.items() if v <= oldest] + [n for b, n in bases.items() if b < oldest]
        kept = [n for n in [*versions.values(), *bases.values()] if n not in gone]
        folders = lambda names: {f for n in names for f, _ in self._entry(n)["folders"]}
        unused = folders(gone) - folders(kept)
        for n in gone:
            self._fs.delete(self._hadoop.fs.Path(self._log, n), False)
        for f in unused:
            self._fs.delete(self._hadoop.fs.Path(f"{self.path}/{f}"), True)


def move(live: SpanTable, archive: SpanTable, condition: Column, move_id: int) -> int:
    """Move the spans that meet the condition to the archive: append, count
    what arrived, then delete. `move_id` grows with every move; a move that was
    cut off is finished by calling it again, without doubling or losing rows."""
    if archive.batch() < move_id:
        archive.append(live.read().drop("version").filter(condition), move_id)
    rows = live.read().filter(condition).select(*KEYS)
    there = archive.read().select(*(F.col(k).alias(f"a_{k}") for k in KEYS))
    lost = rows.join(there, [rows[k].eqNullSafe(there[f"a_{k}"]) for k in KEYS], "left_anti")
    if not lost.isEmpty():
        raise RuntimeError("spans to delete are not in the archive")
    return live.delete(condition)
