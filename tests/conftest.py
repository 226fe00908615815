import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spanlake.session import get_spark
    s = get_spark(cpus="*", shuffle_partitions=8, app="spanlake-tests")
    yield s


def make_spans(spark, rows):
    """Span rows from dicts; unspecified columns get defaults."""
    import datetime as dt
    from spanlake.schema import SPAN
    out = []
    for i, r in enumerate(rows):
        start = r.get("start_time_ms", 1_700_000_000_000 + i * 1000)
        d = {
            "request_id": r.get("request_id", "rq-" + r.get("trace_id", "t1")),
            "trace_id": r.get("trace_id", "t1"),
            "span_id": r.get("span_id", f"s{i}"),
            "span_name": r.get("span_name", f"n{i}"),
            "span_type": r.get("span_type", "WORKFLOW"),
            "parent_span_id": r.get("parent_span_id"),
            "start_time_ms": start,
            "end_time_ms": r.get("end_time_ms", start + 500),
            "status": r.get("status", "OK"),
            "attributes": r.get("attributes", {}),
            "events": [],
            "request_metadata": r.get("request_metadata", {}),
            "execution_order": r.get("execution_order", i),
            "inputs": r.get("inputs", "{}"),
            "outputs": r.get("outputs", "{}"),
            "tags": r.get("tags", {}),
            "experiment_id": r.get("experiment_id", "0"),
            "timestamp": r.get("timestamp", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)),
        }
        out.append(tuple(d[f.name] for f in SPAN.fields))
    return spark.createDataFrame(out, SPAN)
