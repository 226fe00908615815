"""Operator 2: very long texts, repeated rows and clashing column names."""

import numpy as np

from spanlake.llm.suffix_dedup import remove_repeats


def test_long_text_repeated_rows_and_clashing_columns(spark):
    rng = np.random.default_rng(5)

    def noise(n):
        return "".join(rng.choice(list("abcdefghij"), n))

    long = noise(300_000)
    part = noise(200) + long[250_000:250_150] + noise(200)
    rows = [(1, long), (2, part), (3, part), (3, "same short text"), (None, long), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "x", 0, 0) for i, t in rows],
                                 "doc_id long, text string, same string, row int, items int").repartition(3)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in remove_repeats(docs).collect())
    # The null id comes last, so its copy of the long text goes whole.
    assert got == [("1", 300_000, 0, 0), ("2", 550, 150, 1), ("3", 15, 0, 0), ("3", 550, 550, 1),
                   ("4", 0, 0, 0), ("5", 0, 0, 0), ("None", 300_000, 300_000, 1)]
