from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from funnelguard.llm import line_dedup, suffix_dedup


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute_lines(rows, least=10):
    key = lambda line: lowered(line.strip(" \t\n\x0b\x0c\r"))
    docs = {}
    order = lambda d: (d is not None, d or 0)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                docs.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in docs or order(d) == min(map(order, docs[key(x)]))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


LINES = ["The same long line", "  the SAME long line\t", "short", "", "Été à la même ligne", "été à la même ligne", "another long line \x1c", "0123456789", "012345678"]


def test_lines_edge_texts(frame, edge_texts):
    texts = ["\n".join(np.random.default_rng(i).choice(LINES, i % 9)) for i in range(40)]
    rows = [*enumerate([*edge_texts, *texts]), (4, texts[8]), (4, texts[8]), (None, texts[7]), (99, "\n".join(["q" * 12] * 200 + ["z"])), (98, "q" * 12)]
    df = frame(rows, extra=True)
    for limits in ({}, {"frequent": 10 ** 9}, {"frequent": 1, "per_task": 7}):
        got = line_dedup.deduplicate_lines(df, **limits).collect()
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == brute_lines(rows)


def test_lines_empty_table(frame):
    assert line_dedup.deduplicate_lines(frame([])).collect() == []


def brute_strings(rows, length=100):
    """Each (doc, text) once, in corpus order: removed bytes and runs."""
    import xxhash

    seen, out = set(), {}
    low = lambda d: (d is not None, d or 0)
    for d, b in sorted({(d, (t or "").encode()) for d, t in rows}, key=lambda r: (low(r[0]), xxhash.xxh64_intdigest(r[1], 42) & 0xFFFFFFFF)):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if b[s: s + length] in seen:
                gone[s: s + length] = True
            seen.add(b[s: s + length])
        runs = int(np.sum(np.diff(gone.astype(int), prepend=0) == 1))
        out[d, b] = (len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes())
    return Counter((d, *out[d, (t or "").encode()]) for d, t in rows)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeé "), 9)) for _ in range(30)]
    passages = [" ".join(rng.choice(words, 40)) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [passages[rng.integers(4)][rng.integers(50):] if rng.random() < 0.4 else " ".join(rng.choice(words, rng.integers(0, 25)))
                 for _ in range(rng.integers(0, 4))]
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("limits", [{}, {"bytes_per_shard": 3000, "phrases_per_shard": 20}, {"phrases_per_shard": 2}, {"sample": 1, "least": 3}, {"sample": 1, "least": 0}])
def test_strings_against_brute_force(frame, edge_texts, limits):
    texts = corpus(3)
    rows = [*enumerate([*edge_texts, *texts]), (3, "\n"), (30, texts[-1]), (30, texts[-1]), (None, texts[5]), (200, "ab" * 400),
            (201, "ab" * 300 + "c" * 150), (202, "\x00" * 250), (203, texts[9] + texts[9])]
    got = suffix_dedup.deduplicate_strings(frame(rows, extra=True), **limits).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_strings(rows)


def test_strings_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r[0]: (*r[1:4], hashlib.sha256(r[4]).hexdigest()) for r in brute_strings([(r.doc_id, r.text) for r in docs.collect()])}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.digests(suffix_dedup.deduplicate_strings(docs)).collect()}
    assert got == want


def test_strings_empty_table(frame):
    assert suffix_dedup.deduplicate_strings(frame([])).collect() == []


def test_segments_do_not_change_triggers(monkeypatch):
    data = np.frombuffer("".join(corpus(5)).encode() + bytes(500), np.uint8)
    ends = np.array([700, 700, 2000, len(data)])
    whole = suffix_dedup.triggers(data, ends)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 333)
    suffix_dedup._powers.cache_clear()
    parted = suffix_dedup.triggers(data, ends)
    suffix_dedup._powers.cache_clear()
    assert all(np.array_equal(a, b) for a, b in zip(whole, parted, strict=True))
    # every string of 100 bytes holds a trigger
    for a, b in zip([0, *ends[:-1]], ends, strict=True):
        own = whole[0][(whole[0] >= a) & (whole[0] < b)]
        assert all(np.any((own >= s) & (own <= s + 68)) for s in range(a, b - 99))


def test_suffix_ranks_follow_the_bytes():
    rng = np.random.default_rng(0)
    phrases = rng.integers(97, 99, (30, 168), dtype=np.uint8)
    phrases[7] = phrases[3]
    ranks = suffix_dedup.suffix_ranks(phrases, 100)
    flat = [(bytes(phrases[i, o: o + 100]), int(ranks[i, o])) for i in range(30) for o in range(69)]
    order = sorted({s for s, _ in flat})
    assert all(r == order.index(s) for s, r in flat)
    assert re.fullmatch(b"[ab]+", flat[0][0])
