from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from funnelguard.llm import kneser_ney, quality

SPLIT = "\t\n\x0b\x0c\r"


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for c in SPLIT:
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w] + ["\n"]


def held(d):
    return d is None or zlib.crc32(str(d).encode()) % 7 == 2


def discounts(n):
    n1, n2, n3, n4 = (n[k] for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0
    d = [1 - 2 * y * n2 / n1 if n1 else .5, 2 - 3 * y * n3 / n2 if n2 else 1, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [0] + [x if 0 < x < k else k / 2 for k, x in enumerate(d, 1)]


def brute(rows):
    uni, bi = Counter(), Counter()
    for d, t in rows:
        if not held(d):
            w = words(t)
            uni.update(w)
            bi.update(zip([" ", *w], w))
    total, vocabulary = sum(uni.values()), len(uni)
    before = Counter(b for _, b in bi)
    d1, d2 = discounts(Counter(before.values())), discounts(Counter(bi.values()))
    context = Counter()
    kinds = {}
    for (a, _), c in bi.items():
        context[a] += c
        kinds.setdefault(a, Counter())[min(c, 3)] += 1
    spare = sum(d1[min(c, 3)] for c in before.values()) / len(bi) if bi else 1.0

    def p1(w):
        return (max(before[w] - d1[min(before[w], 3)], 0) / len(bi) if bi else 0) + spare / (vocabulary + 1)

    def p2(a, w):
        if not context[a]:
            return p1(w)
        c = bi[a, w]
        left = sum(d2[k] * n for k, n in kinds[a].items()) / context[a]
        return max(c - d2[min(c, 3)], 0) / context[a] + left * p1(w)

    if vocabulary:
        assert math.isclose(sum(map(p1, uni)) + p1("never seen"), 1, rel_tol=1e-9)
        some = max(context, key=context.get)
        assert math.isclose(sum(p2(some, w) for w in uni) + p2(some, "never seen"), 1, rel_tol=1e-9)
    out = []
    for d, t in rows:
        w = words(t)
        out.append((d, held(d), len(w), sum(uni[x] > 0 for x in w), total,
                    sum(math.log10((uni[x] + 1) / (total + vocabulary + 1)) for x in w),
                    sum(math.log10(p2(a, x)) for a, x in zip([" ", *w], w))))
    return out


def check(df, rows, **limits):
    got = kneser_ney.score(df, kneser_ney.train(df, order=2, **limits)).collect()
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 6), round(r[6], 6))
    assert len(got) == len(rows)
    for a, b in zip(sorted(map(key, got)), sorted(map(key, brute(rows))), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], atol=1e-5)
    return got


def test_edge_texts(frame, edge_texts):
    rows = [*enumerate(edge_texts), (3, "\n"), (3, "\n"), (None, "the cat sat"), *((100 + i, "the cat sat on the mat " * (i % 4)) for i in range(20))]
    check(frame(rows, extra=True), rows)
    check(frame(rows), rows, chars_per_shard=500)


def test_whole_table_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(docs, [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def brute_triples(rows):
    tri = Counter()
    for d, t in rows:
        if not held(d):
            w = words(t)
            tri.update(zip([" ", " ", *w], [" ", *w], w))
    vocabulary = {w for *_, w in tri}
    bi = Counter((v, w) for _, v, w in tri)
    uni = Counter(w for _, w in bi)
    d = [discounts(Counter(c.values())) for c in (uni, bi, tri)]
    spare = sum(d[0][min(c, 3)] for c in uni.values()) / len(bi)

    def mixed(counts, off):
        total, left = Counter(), Counter()
        for (*context, _), c in counts.items():
            total[tuple(context)] += c
            left[tuple(context)] += off[min(c, 3)]
        return total, left

    (two, two_left), (three, three_left) = mixed(bi, d[1]), mixed(tri, d[2])

    def p(u, v, w):
        r = max(uni[w] - d[0][min(uni[w], 3)], 0) / len(bi) + spare / (len(vocabulary) + 1)
        if two[(v,)]:
            r = (max(bi[v, w] - d[1][min(bi[v, w], 3)], 0) + two_left[(v,)] * r) / two[(v,)]
        if three[u, v]:
            r = (max(tri[u, v, w] - d[2][min(tri[u, v, w], 3)], 0) + three_left[u, v] * r) / three[u, v]
        return r

    some = max(three, key=three.get)
    assert math.isclose(sum(p(*some, w) for w in [*vocabulary, "never seen"]), 1, rel_tol=1e-9)
    return [(d, sum(math.log10(p(*x)) for x in zip([" ", " ", *w], [" ", *w], w))) for d, t in rows for w in [words(t)]]


@pytest.mark.parametrize("limits", [{}, {"chars_per_shard": 500}, {"chars_per_shard": 60}])
def test_triples(frame, edge_texts, limits):
    rows = [*enumerate(edge_texts), (3, "\n"), (None, "the cat sat"), (None, "new words"),
            *((100 + i, "the cat sat on the mat and the dog sat on the cat " * (i % 4)) for i in range(20))]
    df = frame(rows)
    got = sorted((str(r.doc_id), r.score) for r in kneser_ney.score(df, kneser_ney.train(df, order=3, **limits)).collect())
    want = sorted((str(d), s) for d, s in brute_triples(rows))
    assert [d for d, _ in got] == [d for d, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-6)


def test_query_scores_by_triples(spark):
    from funnelguard.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.score for r in queries.kneser_ney_scores(spark, "/root/testdata/sf0.001").collect()}
    want = dict(brute_triples([(r.doc_id, r.text) for r in docs.collect()]))
    assert got.keys() == want.keys() and np.allclose([got[d] for d in want], list(want.values()), atol=1e-5)


def test_a_hot_context_is_split_and_scores_stay(frame):
    # one word begins a third of all pairs, and one pair a third of all triples
    rows = [(i, " ".join(f"the cat w{(7 * i + j) % 97} the cat w{(5 * i + j) % 61}" for j in range(12))) for i in range(40)]
    for order, brute_of in ((2, lambda r: [(x[0], x[6]) for x in brute(r)]), (3, brute_triples)):
        model, table = kneser_ney.train_numbered(frame(rows), chars_per_shard=400, order=order)
        assert len(model.split_contexts) >= 1
        assert order == 2 or len(model.split_places) >= 1
        got = {r.doc_id: r.score for r in kneser_ney.score_numbered(table, model).collect()}
        want = dict(brute_of(rows))
        assert got.keys() == want.keys() and np.allclose([got[d] for d in want], list(want.values()), atol=1e-6)


def test_rows_of_large_numbers_and_ranges():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-1, 40, 500), rng.integers(-1, 9, 500)
    small, large = kneser_ney.unique_rows(a, b), kneser_ney.unique_rows(a + (a >= 0) * (1 << 40), b)
    assert np.array_equal(small[0] + (small[0] >= 0) * (1 << 40), large[0])
    assert all(np.array_equal(x, y) for x, y in zip(small[1:], large[1:], strict=True))
    want = sorted(set(zip(a.tolist(), b.tolist())))
    assert list(zip(small[0].tolist(), small[1].tolist())) == want
    counts = np.array([1, 50, 3, 0, 2, 90, 1])
    bounds = kneser_ney._bounds(counts, 10, 5, 20, 100)
    assert bounds == [(11, 0), (11, 33), (11, 66), (15, 0), (15, 25), (15, 50), (15, 75)] or len(bounds) == len(set(bounds))
    ranges = kneser_ney.Ranges(np.array([0, 11, 11, 15]), np.array([0, 0, 50, 0]))
    rows = sorted({(int(c), int(w)) for c, w in zip(rng.integers(0, 20, 300), rng.integers(0, 100, 300))})
    cuts = ranges.cuts(np.array([c for c, _ in rows]), np.array([w for _, w in rows]))
    for b, least in enumerate([(0, 0), (11, 0), (11, 50), (15, 0)]):
        assert cuts[b] == sum(r < least for r in rows)


def test_many_shards_need_few_file_handles(frame, monkeypatch):
    import gc
    import os

    rows = [(i, " ".join(f"w{(i * 31 + j * 7) % 400}" for j in range(60))) for i in range(60)]
    model, _ = kneser_ney.train_numbered(frame(rows), chars_per_shard=60)
    assert sum(n > 0 for n in model.triple_sizes) > 100
    view = kneser_ney._Mapped(model)
    view.shelf.limit = 20
    gc.collect()
    before = len(os.listdir("/proc/self/fd"))
    numbers = np.arange(-1, model.words)
    context, word, _, back = kneser_ney.unique_rows(np.roll(np.tile(numbers, 3), 1), np.tile(numbers, 3))
    place = view.pairs.find(context, word)
    view.trigram(place, view.bigram(context, word, place), back, np.array([len(back)]), word[back])
    gc.collect()
    assert len(view.shelf.held) <= 20 and len(os.listdir("/proc/self/fd")) - before <= 20


def test_no_triples(frame):
    model = kneser_ney.train(frame([]), order=3)
    assert [r.score for r in kneser_ney.score(frame([(1, "a b")]), model).collect()] == [0.0]
    with pytest.raises(ValueError):
        kneser_ney.train(frame([]), order=4)


def test_nothing_to_learn_from(frame):
    assert kneser_ney.score(frame([]), kneser_ney.train(frame([]))).collect() == []
    check(frame([(None, "a b")]), [(None, "a b")])


def good(rng):
    return " ".join(rng.choice(["the", "of", "river", "stone", "walked", "slowly,", "house."], rng.integers(5, 60)))


def bad(rng):
    return " ".join(w.upper() + "!!" for w in good(rng).split())


def test_quality_learns_from_positives_alone(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(600):
        kind = int(rng.random() < 0.7)
        rows.append((i, good(rng) if kind else bad(rng)))
        if i % 2:
            labels.append((i, kind, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, marks)
    assert 0.5 < model.prior < 0.9
    # labels of 0, and those of held-out rows, teach nothing
    same = quality.train(docs, marks.filter("quality = 1 AND crc32(cast(doc_id AS string)) % 5 <> 0"))
    assert np.array_equal(same.weights, model.weights)
    got = {r.doc_id: r for r in quality.classify(docs, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    right = [got[i].predicted == (not t.isupper()) for i, t in rows if got[i].held_out]
    assert np.mean(right) > 0.93
    assert {i for i, r in got.items() if r.held_out} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}


def test_quality_edge_texts(frame, edge_texts, spark):
    labels = spark.createDataFrame([(i, 1 if i % 2 else None, None) for i in range(20)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    df = frame([*enumerate(edge_texts), (None, "a"), (3, "\n")], extra=True)
    model = quality.train(df, labels)
    got = quality.classify(df, model).collect()
    assert len(got) == len(edge_texts) + 2 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (0, 1)} == {got[0].score}  # null and empty
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got)
    none = quality.train(frame([]), labels.limit(0))
    assert {r.score for r in quality.classify(df, none).collect()} == {0.5}


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.classify(docs, quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93


@pytest.mark.parametrize("share", [0.3, 0.8])
def test_class_prior(share):
    rng = np.random.default_rng(2)
    p, n = rng.normal(1.5, 1, (3000, 5)), rng.normal(-1.5, 1, (3000, 5))
    unlabelled = np.where(rng.random((3000, 1)) < share, rng.normal(1.5, 1, (3000, 5)), n)
    assert abs(quality.class_prior(p, unlabelled) - share) < 0.08


def test_halved_keys_are_found_as_whole_ones():
    from funnelguard.llm import packed

    rng = np.random.default_rng(3)
    for top in (1 << 20, 1 << 36, 1 << 45):
        keys = np.unique(rng.integers(0, top, 3000, dtype=np.uint64))
        file = packed.halved(keys)
        assert np.array_equal(packed.whole(file), keys)
        wanted = np.sort(np.concatenate([keys[::7], rng.integers(0, top + top // 8, 2000, dtype=np.uint64)]))
        want = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        at, inside = packed.least_from(file, wanted)
        assert np.array_equal(at, want)
        assert np.array_equal(inside, (keys[want] >> np.uint64(32) == wanted >> np.uint64(32)) & (keys[want] >= wanted))
        assert np.array_equal(packed.places_of(file, wanted), np.where(keys[want] == wanted, want, -1))
        assert np.array_equal(packed.whole(file, want), keys[want])
