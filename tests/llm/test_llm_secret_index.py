"""Operator 3's stored trigram index: its lists, their intersection, its reuse."""

import re

import pytest
from pyspark.sql import functions as F

from spanlake.llm import secrets as S

DOC = "doc_id long, text string"


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text): ids in several blocks (negative ones too), repeated and
    null ids, empty, null and very long texts."""
    hit = "my Token = abcdefgh1234"
    return [(1, hit), (1, "nothing"), (S.BLOCK, "tok oken apart"), (3 * S.BLOCK + 7, "AKIA" + "Z" * 20), (-5, hit),
            (2, None), (3, ""), (None, hit), (None, "AKIA"), (4, "a " * 300_000 + hit), (5, "secr ecret"), (5, "x"),
            (6, "ghp_" + "a" * 36), (7, "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9), (8, "f" * 40)]


def test_lists_hold_each_id_once_in_its_block(spark, texts):
    docs = spark.createDataFrame(texts, DOC)
    lists = {(r["block"], r["trigram"]): r["ids"] for r in S.store_index(docs).collect()}
    for t in S.used_trigrams():
        want = sorted({i for i, x in texts if i is not None and t in (x or "").lower()})
        got = [i for (b, g), ids in sorted(lists.items()) if g == t for i in ids]
        assert got == want
    assert all(b == i // S.BLOCK for (b, _), ids in lists.items() for i in ids)


def test_candidates_satisfy_the_query_and_lose_no_match(spark, texts):
    docs = spark.createDataFrame(texts, DOC)
    got = {r["doc_id"]: r["may"] for r in S.candidates(S.store_index(docs)).collect()}

    def holds(query, have):
        if isinstance(query, str):
            return query in have
        return (all if query[0] == "and" else any)(holds(q, have) for q in query[1])

    for no, rule in enumerate(S.RULES):
        query = S.trigram_query(rule.pattern)
        if query is True:
            assert not any(m >> no & 1 for m in got.values())
            continue
        for i in {i for i, _ in texts if i is not None}:
            have = {t for t in S.used_trigrams() if any(t in (x or "").lower() for j, x in texts if j == i)}
            assert bool(got.get(i, 0) >> no & 1) == holds(query, have)
            if any(re.search(rule.explicit, x or "") for j, x in texts if j == i):
                assert got[i] >> no & 1


def test_a_stored_index_serves_later_scans_and_fewer_rules(spark, texts):
    docs = spark.createDataFrame(texts, DOC)
    index = S.store_index(docs)

    def spans(df):
        return sorted((str(r["doc_id"]), [tuple(s) for s in r["spans"]]) for r in df.collect())

    assert spans(S.scan_secrets(docs, index=index)) == spans(S.scan_secrets(docs))
    assert spans(S.scan_secrets(docs, S.BASE, index=index)) == spans(S.scan_secrets(docs, S.BASE))
    by_id = spans(S.scan_secrets(docs))
    assert len(by_id) == len(texts) and sum(1 for i, s in by_id if i == "None" and s) == 1
    assert any(s and s[0][0] == 600_003 for i, s in by_id if i == "4")       # at the end of a very long text


def test_null_ids_meet_no_list_and_are_spread(spark):
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("token=abcdefgh"), "id").alias("text"))
    rows = S.scan_secrets(docs)
    assert rows.where(F.size("spans") == 1).count() == 2000
    assert S.store_index(docs).count() == 0
