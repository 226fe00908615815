"""Python code that runs inside tasks must not need this package on the
executors: run from a folder where `spanlake` is not importable by workers."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_tasks_ship_by_value(tmp_path):
    script = textwrap.dedent(f"""
        import sys, hashlib
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.showConsoleProgress", "false")
                 .getOrCreate())
        from spanlake.operators.prompts import skills_hash
        parts = spark.createDataFrame([("p", "b", "B"), ("p", "a", "A")], "project string, key string, content string")
        got = skills_hash(parts).collect()[0].skills_hash
        assert got == hashlib.sha256(b"a\\nA\\0b\\nB").hexdigest(), got
        print("OK")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True,
                       timeout=600)
    assert r.stdout.strip().endswith("OK"), r.stderr[-2000:]
