"""

sf0.001 for all queries; the driver repeats this at sf0.01.
"""


import pytest

from tests.conftest import SF001

import __spark_entry__ as E
from spanlake.plans.registry import load_all
from tools.check_oracle import digest, duck

# the trace library's own queries; tests/llm has those of the llm subpackage
QUERIES = {k: fn for k, (fn, _) in load_all().items()}
ORACLE = {k: sql for k, (_, sql) in load_all().items() if sql}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("qid", sorted(QUERIES))
def test_query_matches_oracle(spark, con, qid):
    df = QUERIES[qid](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = ORACLE.get(qid)
    if sql is None:
        assert df.columns  # rows-only check
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "span_type"
    assert df.count() >= 0


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = {"v7_train_evaluate"}
    assert set(QUERIES) - set(ORACLE) == rows_only
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
