from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from funnelguard.llm import simhash
from funnelguard.llm.components import stars


def brute_fingerprint(t, words_each=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i: i + words_each]) for i in range(len(words) - words_each + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, most=4):
    """rows: (doc_id, fingerprint); the smallest doc_id reachable, for each row."""
    label = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= most and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    low = {}
    for (d, _), k in zip(rows, label, strict=True):
        if d is not None:
            low[k] = min(d, low.get(k, d))
    return [low.get(k) for k in label]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aAbÉé \t\x0b\x1c\x85  "), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_edge_texts(frame, edge_texts):
    rows = [*enumerate(edge_texts), (3, "\n"), (3, "\n"), (None, "alone here"), (90, "x\x1cy")]
    got = Counter((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in simhash.near_duplicates(frame(rows, extra=True)).collect())
    marked = [(d, brute_fingerprint(t)) for d, t in rows]
    assert got == Counter((d, f, c) for (d, f), c in zip(marked, brute_components(marked), strict=True))


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    marked = [(d, brute_fingerprint(t)) for d, t in rows]
    got = {r.doc_id: (r.fp % 2 ** 64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f, c) for (d, f), c in zip(marked, brute_components(marked), strict=True)}


@pytest.mark.parametrize("block_rows", [3, 40, 10_000])
def test_links_connect_all_near_pairs(spark, tmp_path, block_rows):
    rng = np.random.default_rng(block_rows)
    centres = rng.integers(0, 2 ** 64, 12, dtype=np.uint64)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for c in centres for _ in range(40)}
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in rows], "least long, fp long")
    blocked = simhash.blocks(signed, 4, block_rows, str(tmp_path))
    found = stars(simhash.links(blocked, blocked.count(), 4), str(tmp_path / "stars")).collect()
    root = {r.u % 2 ** 64: r.v % 2 ** 64 for r in found}
    least = {}
    for i, f in rows:
        least.setdefault(root.get(f, f), i)
    assert [least[root.get(f, f)] for _, f in rows] == brute_components(rows)


def test_components_of_a_long_path(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (201, 200), (200, 201)], "a long, b long")
    got = {(r.u, r.v) for r in stars(edges, str(tmp_path)).collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(201, 200)}


def test_empty_table_and_kept_rows(frame):
    assert simhash.near_duplicates(frame([])).collect() == []
    df = frame([(5, "one two three four"), (2, "ONE two three four"), (2, "one two three four"), (7, "other words are here now"),
                (None, "one two three four"), (None, None)], extra=True)
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 7), (True, 0), (True, 0)]
