"""W5 as a table operator, V7's split."""

from pyspark.sql import functions as F

from spanlake.operators import evaluation as EV
from spanlake.operators import prompts as P


def test_first_root_per_path(spark):
    rows = [("a", "/x/y", 3), ("b", "/x/y/", 1), ("c", "/x//y", 1), ("d", "/", 9), ("e", "/z", None), ("f", "/z", 4), ("g", None, 0)]
    got = P.first_per_path(spark.createDataFrame(rows, "label string, path string, ordinal long"))
    assert got.columns == ["label", "path", "ordinal"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [("d", "/", 9), ("b", "/x/y", 1), ("e", "/z", None)]
    assert P.first_per_path(got.limit(0)).count() == 0


def test_held_out_part(spark):
    ids = spark.range(4000).withColumn("t", EV.held_out("id"))
    n = ids.filter("t").count()
    assert 700 < n < 900
    assert ids.repartition(7).filter("t").agg(F.sum("id")).first() == ids.filter("t").agg(F.sum("id")).first()
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(EV.held_out("id")).first()[0] is False
