"""What must hold of a re-parented trace and of prompt versions, whatever the input."""


def order_key(span):
    return (span["start_time_ms"], span["execution_order"], span["span_id"])


def check_reparented(matched: list[dict], new_parent: dict) -> None:
    """`matched` = the kept spans of one trace, `new_parent` = span id -> parent after T2.
    One root, the first span; a parent is kept if and only if it was matched
    and sorts before its child; every other span hangs under the root."""
    spans = {s["span_id"]: s for s in matched}
    root = min(matched, key=order_key)["span_id"]
    assert set(new_parent) == set(spans)
    assert [i for i, p in new_parent.items() if p is None] == [root]
    earlier = {i for i, s in spans.items()
               if s["parent_span_id"] in spans and order_key(spans[s["parent_span_id"]]) < order_key(s)}
    assert all(new_parent[i] == spans[i]["parent_span_id"] for i in earlier)
    assert all(new_parent[i] == root for i in set(spans) - earlier - {root})


def check_versions(texts: list[str], versions: list) -> None:
    """`versions` of one project's texts in order: none without a text, 1 for
    the first text, then one more exactly where the text differs from the one before."""
    assert [v is None for v in versions] == [not t for t in texts]
    known = [(t, v) for t, v in zip(texts, versions) if t]
    assert all(v == 1 for _, v in known[:1])
    assert all(v2 - v1 == int(t1 != t2) for (t1, v1), (t2, v2) in zip(known, known[1:]))
