"""Operators 11 to 13 against brute force, on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from spanlake.llm import best_fit, filter_audit, merkle, tokens

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tree string, rank long, key long, digest binary, part int, "
          "sha string, mask int, item long, bin int, length int, `group` string, TEXT string, Lang string")
CLASH = ("x", 1, 2, b"d", 3, "s", 4, 5, 6, 7, "g", "other", "zz")


def rows():
    words = " ".join(f"w{i % 150}" for i in range(260))
    out = [(i, f"Text {i} IN capitals" if i % 4 else words + f" {i}", ["en", "de", None, "", "fr"][i % 5], f"s{i % 3}", i) for i in range(60)]
    out += [(100, None, "en", None, None), (101, "", "en", "a", 0), (102, "é ü" * 30 + " ##", "de", "a", 90), (None, "Same Text", "en", "a", 9),
            (103, "Same Text", "fr", "a", 9), (104, "Same Text", "en", "a", 9), (104, "Same Text", "en", "a", 9), (None, "Same Text", None, "a", 9),
            (105, "Long " * 60_000, "en", "b", 300_000), (106, "\x0b\x0c \t", "en", "b", 4), (107, "a b c", "de", "b", 5)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + CLASH for r in rows()], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    f = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return digest(*["-" if x is None else f"{len(x.encode())}:{x}" for x in f])


def tree(level):
    """Levels of a tree over a list of digests."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def fold(levels, i, d):
    """(siblings bottom to top, folded root)."""
    path = []
    for level in levels[:-1]:
        run, k = level[i // 8 * 8:i // 8 * 8 + 8], i % 8
        path += run[:k] + run[k + 1:]
        d = digest(*run[:k], d, *run[k + 1:])
        i //= 8
    return path, d


def brute_manifest(data):
    groups = defaultdict(list)
    for r in data:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r[1]) if r[1] is not None else None
        touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r), leaf(r[0], low, *r[2:]) if touched else None))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, (named, key, own, probe) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path, d = fold(trees[g], i, probe or own)
            more, d = fold(top, k, d)
            out.append((key if named else None, own, trees[g][-1][0], top[-1][0], digest(*path, *more), d, d == top[-1][0]))
    return out


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest(docs, levels, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", levels)      # several rounds of small blocks
    third = lambda key: (merkle.F.crc32(key.cast("string").cast("binary")) % 3) == 0
    logs, proofs = merkle.manifest(docs, tampered=third)
    got = Counter(tuple(r) for r in proofs.collect())
    want = brute_manifest(rows())
    assert got == Counter(want)
    assert {w[-1] for w in want} == {True, False}
    for log in logs.values():
        by_tree = defaultdict(list)
        for made in log:
            for r in made.where("not up").collect():
                by_tree[r["tree"], r["n"]].append((r["pos"], r["level"], bytes(r["digest"])))
        for (name, n), nodes in by_tree.items():
            assert sorted(p for p, _, _ in nodes) == list(range(sum(merkle.level_size(n, k) for k in range(merkle.height(n) + 1))))
            assert max(nodes)[1] == merkle.height(n)            # the root comes last
    groups = defaultdict(list)
    for r in rows():
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r)))
    own = sorted(groups["en"])
    path, _ = fold(tree([x[2] for x in own]), 9, own[9][2])
    assert [d.hex() for d in merkle.proof(logs["groups"], "=en", 9, len(own))] == path


def test_positions():
    for n in (1, 2, 8, 9, 64, 65, 300, 513):
        h, order = merkle.height(n), []

        def visit(level, idx):
            if level:
                for child in range(idx * 8, min(idx * 8 + 8, merkle.level_size(n, level - 1))):
                    visit(level - 1, child)
            order.append((level, idx))

        visit(h, 0)
        assert [int(merkle.position(level, idx, n, h)) for level, idx in order] == list(range(len(order)))


def test_manifest_small_tables(spark, empty):
    assert merkle.manifest(empty)[1].count() == 0
    one = spark.createDataFrame([(1, "One", "en", "s", 3) + CLASH], SCHEMA)
    r = merkle.manifest(one)[1].first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] == leaf(1, "One", "en", "s", 3)
    assert r["proof_sha256"] == digest() and r["verified"]


def fails(doc_id, text, data):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    same = [r[0] for r in data if (r[1] or "") == t and r[0] is not None]
    return {f for f, bad in {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
        "D": bool(re.search("[#$%&*|]", t)), "E": doc_id is not None and min(same) < doc_id}.items() if bad}


def test_filter_audit(spark, docs, empty):
    data = rows()
    labels = [(3, 1, 1), (4, 1, 0), (4, 0, 1), (104, 1, None), (103, None, 1), (None, 1, 1), (20, 1, 0), (21, 0, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): r.asDict() for r in filter_audit.audit(docs, marks).collect()}
    good = {x[0] for x in labels if x[1] == 1} - {None}
    toxic = {x[0] for x in labels if x[2] == 1} - {None}
    parts = defaultdict(list)
    for r in data:
        parts[r[2] or ""].append((r[0], fails(r[0], r[1], data)))
    assert len(got) == 600 * len(parts)
    shapley = Counter()
    for part, members in parts.items():
        for order in permutations("ABCDE"):
            left = members
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[1]]
                r = got[part, "".join(order), k + 1]
                assert r["removed"] == len(gone) and r["kept"] == len(left) - len(gone)
                assert r["redundant"] == sum(f in m[1] for m in members) - len(gone)
                assert r["unique_fails"] == sum(m[1] == {f} for m in members)
                assert r["good_lost"] == sum(m[0] in good for m in gone) and r["toxic_lost"] == sum(m[0] in toxic for m in gone)
                shapley[part, f] += len(gone)
                left = [m for m in left if f not in m[1]]
    for (part, order, step), r in got.items():
        assert r["shapley"] == shapley[part, order[step - 1]]
    assert any(r["redundant"] for r in got.values()) and any(r["toxic_lost"] for r in got.values())
    assert filter_audit.audit(empty, marks).count() == 0
    assert filter_audit.audit(docs, marks.limit(0)).count() == len(got)


def test_transducer():
    import pyarrow as pa
    texts = ["", " a  b\ta", "é#É Ab", "x", "\x1fy z", "", "AB" * 3 + "\n€ €"]
    found = filter_audit.transduce(pa.array(texts), filter_audit.byte_classes(), filter_audit.transitions())
    for t, *n in zip(texts, *(x.tolist() for x in found)):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert n == [len(words), len(set(words)), len(re.findall("[A-Z]", t)), len(t), len(re.findall("[#$%&*|]", t))]


def check_packing(got, window):
    """Sequences without gaps or overlaps within the window; their number."""
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return len(bins)


def test_best_fit(docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokens.default_vocabulary())
    want = Counter()
    for r in rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], "<u4")
            want[r[0], k, at, len(part), zlib.crc32(part.tobytes())] += 1
    for group in (1 << 14, 20):
        got = best_fit.pack(docs, group=group).collect()
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        least = -(-sum(k[3] * n for k, n in want.items()) // 2048)
        assert check_packing(got, 2048) <= least + 1
    assert best_fit.pack(empty).count() == 0


def test_best_fit_bins_are_bounded(spark):
    bins = best_fit.OpenBins(100, 3)
    put = [bins.put(n) for n in (60, 70, 80)]
    assert put == [(0, 0), (1, 0), (2, 0)]
    assert bins.put(95) == (3, 0) and bins.count == 3        # the fullest, bin 2, is closed
    assert bins.put(20) == (1, 70) and bins.put(40) == (0, 60) and bins.count == 2
    # Lengths of which no two fit together, in many groups: one round, a bin each.
    items = spark.range(500).selectExpr("id AS item", "int(60 + id % 30) AS length")
    placed = best_fit.best_fit(items, window=100, open_bins=4, group=10).collect()
    assert len({r["sequence_id"] for r in placed}) == len(placed) == 500
    mixed = spark.range(3000).selectExpr("id AS item", "int(1 + id * 7919 % 97) AS length")
    got = best_fit.best_fit(mixed, window=100, open_bins=64, group=100).join(mixed, "item").collect()
    total = sum(r["length"] for r in got)
    assert len(got) == 3000 and check_packing(got, 100) <= 1.1 * total / 100      # groups of 100 pieces, 64 open bins
