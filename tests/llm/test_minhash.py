"""MinHash near-dedup against all pairs of sets."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from funnelguard.llm import minhash


def word_set(text, k=3):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def expected(rows, percent=85):
    """doc_id -> (n_shingles, component_id, kept) of rows with distinct ids, by all pairs."""
    sets = {i: word_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            s, t = sets[a], sets[b]
            if s and t and min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)) and 100 * len(s & t) >= percent * len(s | t):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def found(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, **options).collect()}


def changed(rng, words, share):
    return [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(10 ** 6)) if rng.random() < share else w for w in words]


def test_edge_texts(frame, edge_texts):
    rows = list(enumerate(edge_texts))
    assert found(frame(edge_texts, extra=True)) == expected(rows)


def test_sets_by_order_case_and_repeats(frame):
    texts = ["a b c d", "A  B\tc D", "a b c d a b c d", "b a c d", "a b", "A\nb", "b a", "a", "a a a a a", "é è x", "É è x"]
    assert found(frame(texts)) == expected(list(enumerate(texts)))


@pytest.mark.parametrize("star_rows,cell_rows", [(1024, 1024), (4, 3)])
def test_groups_around_the_threshold(frame, star_rows, cell_rows):
    # copies whose likeness lies on both sides of the threshold, chains of copies of copies, and a shared passage
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = [" ".join(changed(rng, base, rng.choice([0.0, 0.01, 0.02, 0.03, 0.05]))) for _ in range(70)]
    chain = [f"c{rng.randrange(5000)}" for _ in range(90)]
    for _ in range(25):
        chain = changed(rng, chain, 0.02)
        texts.append(" ".join(chain))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(30)) for _ in range(40)]
    texts += [" ".join(f"s{j}" for j in range(i, i + 9)) for i in range(12)]  # short texts, one word further each
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert found(frame(rows), star_rows=star_rows, cell_rows=cell_rows) == expected(rows)


def test_what_stars_cannot_see_is_found_in_cells(frame):
    # a text that is near all, spokes in pairs that are alike only to each other
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(12):
        spoke = changed(rng, base, 0.045)
        texts += [" ".join(spoke), " ".join(changed(rng, spoke, 0.01))]
    rows = list(enumerate(texts))
    assert found(frame(rows), cell_rows=2) == expected(rows)


def test_null_and_repeated_ids_and_an_empty_table(frame):
    df = frame([(None, "a b c d"), (None, "q r s t"), (3, "a b c d"), (3, "a b c d"), (3, "other words are here"), (4, None), (None, "")])
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    want = [(None, 2, 3, False), (None, 2, None, True), (3, 2, 3, True), (3, 2, 3, True), (3, 2, 3, True), (4, 0, 4, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(frame([]).limit(0)).collect() == []


def test_text_ids_and_a_long_text(spark):
    long = " ".join(f"w{i % 70_001}" for i in range(800_000))
    df = spark.createDataFrame([("b", long), ("a", long + " end"), ("c", "x y z")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == {"b": "a", "a": "a", "c": "c"}


def test_signatures_are_least_hashes_and_densified_from_the_own_set():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64)) for n in (1, 2, 30, 5000)]
    order = minhash.ways(40)
    assert all(sorted(r) == list(range(40)) for r in order.tolist())
    table = minhash.signatures(sets, 40, order)
    for row, s in zip(table, sets, strict=True):
        bins = {}
        for h in s.tolist():
            b = (h >> 32) * 40 >> 32
            bins[b] = min(h, bins.get(b, h))
        for b in range(40):
            assert int(row[b]) == (bins[b] if b in bins else next(bins[j] for j in order[b].tolist() if j in bins))


def test_share_of_equal_bins_estimates_likeness():
    rng = np.random.default_rng(1)
    whole = rng.integers(0, 2 ** 64, 400, dtype=np.uint64)
    a, b = np.unique(whole[:380]), np.unique(whole[20:])
    order = minhash.ways(2000)
    table = minhash.signatures([a, b], 2000, order)
    assert abs((table[0] == table[1]).mean() - 360 / 400) < 0.03


def test_shingles_of_a_batch_do_not_cross_texts():
    sets = minhash.shingle_sets(pa.array(["a b", "c d e", "", "a b c d e"]), 3)
    assert [len(s) for s in sets] == [1, 1, 0, 3] and sets[1][0] in sets[3]
