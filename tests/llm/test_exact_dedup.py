from __future__ import annotations

import hashlib
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st

from funnelguard.llm import exact_dedup


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def expect(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    key = lambda i: (i is not None, i or 0)
    return Counter((i, max(groups[lowered(t)], key=key), len(groups[lowered(t)]), hashlib.sha256(lowered(t).encode()).hexdigest())
                   for i, t in rows)


def decided(df, **args):
    rows = exact_dedup.decide(df, **args).collect()
    assert all(n == 1 for n in Counter(r.text_sha256 for r in rows if r.kept).values())
    assert {r.text_sha256 for r in rows} == {r.text_sha256 for r in rows if r.kept}
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    return Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows)


def test_edge_texts_repeated_rows_and_null_ids(frame, edge_texts):
    rows = [*enumerate(edge_texts), (3, "\n"), (3, "\n"), (None, "A"), (None, "only"), (None, "only"), (70, "É"), (71, "é")]
    assert decided(frame(rows, extra=True)) == expect(rows)


def test_frequent_texts_take_the_broadcast_way(frame):
    rows = [(i, "Hot" if i % 3 == 0 else f"t{i % 50}" if i % 3 == 1 else str(i)) for i in range(600)]
    assert decided(frame(rows), counters=7) == expect(rows)
    table = exact_dedup.digests(frame(rows)).selectExpr("*", "doc_id AS row")
    found = exact_dedup.winners(table, 7).collect()
    assert [r.group_size for r in found] == [200] and found[0].last.doc_id == 597


def test_empty_table_and_kept_rows(frame):
    assert exact_dedup.decide(frame([])).collect() == []
    df = frame([(1, "a"), (2, "A"), (2, "A"), (3, "b"), (4, None), (5, "")], extra=True)
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == [2, 3, 5] and {r["__key"] for r in rows} == {"s"}


@given(st.lists(st.binary(max_size=1), max_size=60), st.integers(1, 6))
def test_summary_bound(items, counters):
    kept = Counter()
    for i in range(0, len(items), 7):
        kept = exact_dedup.merged(kept + Counter(items[i: i + 7]), counters)
    true = Counter(items)
    assert len(kept) <= counters
    assert all(0 <= true[k] - kept[k] <= len(items) / (counters + 1) for k in true)
