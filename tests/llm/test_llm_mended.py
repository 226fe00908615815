"""Rare inputs that operators once broke on, and measured recall."""

import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline as P
from spanlake.llm import decontamination, html_text, jaccard_join, toxicity
from spanlake.llm.common import read_table
from spanlake.llm.wordhash import Words

PAGES = "page_id long, url string, html string"


def article(k, length=20):
    return (f"<html><body><nav><a href=/>Home</a></nav><article><p>Paragraph {k}, about the river. " + "It goes on, for a while. " * length
            + "</p></article><footer>&copy; Someone</footer></body></html>")


def test_html_tables_without_training_pages(spark):
    for data in ([], [(1, "u", None), (None, None, None)], [(1, "u", ""), (2, "u", "")]):
        df = spark.createDataFrame(data, PAGES)
        got = html_text.extract(df, html_text.train(df)).collect()
        assert len(got) == len(data) and all(r["text"] == "" and r["n_chars"] == 0 for r in got)


def test_html_long_pages_only(spark):
    df = spark.createDataFrame([(k, "u", article(k, 5000)) for k in range(4)] + [(4, "u", None)], PAGES)
    assert min(len(article(k, 5000)) for k in range(4)) > html_text.TRAIN_CHARS
    got = {r["page_id"]: r["text"] for r in html_text.extract(df, html_text.train(df)).collect()}
    assert got[2] == "Paragraph 2, about the river. " + ("It goes on, for a while. " * 5000).strip() and got[4] == ""


def test_html_deep_nesting_takes_linear_time(spark):
    df = spark.createDataFrame([(k, "u", article(k)) for k in range(30)], PAGES)
    model = html_text.train(df)
    took = {}
    for n in (16_000, 64_000):
        began = time.time()
        page = html_text.Page("<div>x" * n + "<select>y<li>" + "</div>" * (n // 2) + "<p>z")
        score = html_text.score_pages(model, [page])
        page.decode(score)
        took[n] = time.time() - began
        assert len(score) == len(page.tag) == 2 * n + 5 and "y" not in page.text.values()
    assert took[64_000] < 12 * took[16_000]


def test_html_scores_do_not_depend_on_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(k, "u", article(k)) for k in range(30)], PAGES)
    model, pages = html_text.train(df), [html_text.Page(article(k)) for k in range(3)]
    whole = html_text.score_pages(model, pages)
    monkeypatch.setattr(html_text, "SCORE_ROWS", 3)
    assert np.array_equal(whole, html_text.score_pages(model, pages))


def test_decontamination_keeps_every_item_id(spark):
    docs = spark.createDataFrame([(1, "x " + " ".join(f"a{i}" for i in range(12)) + " y"), (2, " ".join(f"b{i}" for i in range(11)))], "doc_id long, text string")
    items = spark.createDataFrame([(-1, " ".join(f"a{i}" for i in range(12))), (0, " ".join(f"a{i}" for i in range(1, 11))), (None, " ".join(f"b{i}" for i in range(11)))],
                                  "item_id long, text string")
    for block in (1 << 20, 5):
        got = {r["doc_id"]: r for r in decontamination.contamination(docs, items, block_words=block).collect()}
        assert got[1]["items"] == [-1, 0] and got[1]["n_hit"] == 12
        assert got[2]["items"] == [] and got[2]["n_hit"] == 11


def test_words_that_collide_as_polynomials(spark):
    one, two = "a", "b"
    for _ in range(11):
        one, two = one + two, two + one                  # Thue-Morse words
    h = Words(pa.array([one, two, one.upper()])).hash
    assert h[0] != h[1] and h[0] == h[2]
    docs = spark.createDataFrame([(1, one)], "doc_id long, text string")
    items = spark.createDataFrame([(1, two)], "item_id long, text string")
    assert decontamination.contamination(docs, items).first()["n_hit"] == 0


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    data = [(i % 400, f"calm words {i} " + ("vile grump" if i % 400 % 4 == 0 else "fine"), i % 400 % 4 == 0) for i in range(400)]
    data += [(0, f"vile grump copy {i}", True) for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string, toxic boolean")
    seen, fit = [], toxicity.fit_ordinal
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda doc, feature, value, grade, n: seen.append(len(grade)) or fit(doc, feature, value, grade, n))
    model = toxicity.train(df.drop("toxic"), df.selectExpr("doc_id", "int(toxic) AS toxic"), train_rows=200)
    assert seen == [200] and len(model.features)


def shingles(text):
    words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.translate({c: c + 32 for c in range(65, 91)})).split()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_links(texts):
    """(links per document's set, group per document) over all pairs that share a shingle."""
    sets = defaultdict(list)
    for i, t in sorted(texts.items()):
        s = shingles(t or "")
        sets[s or i].append(i)
    rep = {s: min(ids) for s, ids in sets.items()}
    own = [s for s in sets if isinstance(s, frozenset)]
    where = defaultdict(list)
    for k, s in enumerate(own):
        for x in s:
            where[x].append(k)
    common = Counter()
    for ks in where.values():
        for n, a in enumerate(ks):
            for b in ks[:n]:
                common[b, a] += 1
    links, group = Counter(), {rep[s]: rep[s] for s in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(own[a]) + len(own[b]) - n):
            a, b = rep[own[a]], rep[own[b]]
            links[a] += 1
            links[b] += 1
            a, b = sorted((root(a), root(b)))
            group[b] = a
    of = {i: rep[s] for s, ids in sets.items() for i in ids}
    return {i: links[of[i]] for i in of}, {i: root(of[i]) for i in of}


def test_near_classes_on_the_given_table(spark):
    """Every link of sf0.01 by brute force: recall 1, no false one."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    links, group = brute_links({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    got = {r["doc_id"]: r for r in jaccard_join.near_classes(*jaccard_join.jaccard_join(docs)).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == links and sum(links.values()) > 0
    assert {i: r["class_id"] for i, r in got.items()} == group


def test_pipeline_clashing_names_and_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _toxic string, _metadata string, c0 int, TEXT string, _severity int"
    data = [(k, f"text number {k} " + " ".join(f"w{k}x{i}" for i in range(30)), "en", "s", 1, "t", "m", 1, "T", 2) for k in range(20)]
    data += [(100, data[0][1] + " ", *data[0][2:]), (101, data[1][1] + " tail", *data[1][2:])]
    for name, rows in (("full", data), ("empty", [])):
        sf = f"{tmp_path}/{name}"
        docs = spark.createDataFrame(rows, schema)
        spark.conf.set("spark.sql.caseSensitive", "true")      # to write both text and TEXT
        try:
            docs.write.parquet(f"{sf}/documents.parquet")
            spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
            spark.createDataFrame([(1, " ".join(f"w3x{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
            docs = spark.read.parquet(f"{sf}/documents.parquet")
            for k, (_, stage) in enumerate(P.STAGES[:-1]):
                out = stage(spark, docs, sf)
                assert out.columns == docs.columns
                out.write.parquet(f"{sf}/out{k}")
                docs = spark.read.parquet(f"{sf}/out{k}")
            kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert kept == ({*range(20), 100} - {0, 3} if rows else set()) or kept == ({*range(20), 100, 101} - {0, 1, 3} if rows else set())
            assert P.pack_documents(spark, docs, sf).count() == len(kept)
        finally:
            spark.conf.unset("spark.sql.caseSensitive")
