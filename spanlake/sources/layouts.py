"""The span table bucketed by trace.

Self-joins on (trace_id, ...) and groupings by trace_id over it need no
exchange of spans: a trace lies in one bucket. For joins on more than trace_id
set `spark.sql.requireAllClusterKeysForCoPartition` to false. A bucket is read
by one task, so choose enough of them, and keep the plain layout where a single
trace holds a large share of all spans (there AQE can split it).
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from spanlake.schema import SPAN, SPAN_COLUMNS


def write_bucketed(spans: DataFrame, path: str, buckets: int) -> None:
    """One file per bucket, sorted by trace, under `path`."""
    name = f"bucketed_{uuid.uuid4().hex}"
    (spans.select(*SPAN_COLUMNS).repartition(buckets, "trace_id").write.bucketBy(buckets, "trace_id").sortBy("trace_id")
     .format("parquet").option("path", path).saveAsTable(name))
    spans.sparkSession.sql(f"DROP TABLE {name}")        # the files stay: the table named their folder


def read_bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The table over such a folder, named after it in the session's catalog."""
    name = f"spans_{buckets}_{hashlib.sha1(path.encode()).hexdigest()[:16]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SPAN.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (trace_id) SORTED BY (trace_id) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
