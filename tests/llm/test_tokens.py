from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from funnelguard.llm import bpe, packing
from funnelguard.llm.chunk_encoder import ChunkEncoder, cut

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def rank_encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def spec():
    return bpe.tokenizer_spec(bpe.read_ranks(RANKS), P.PATTERN)


ODD = st.text(st.sampled_from(" \n\t\r ab'sT1.é日🙂  \x85\x1c"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_chunks_give_the_ids_of_whole_texts(library, texts):
    got = ChunkEncoder(library).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    for t in texts:
        assert " ".join(cut(t)) == t


def test_strings_of_added_tokens_become_their_ids(library):
    added = [t.content for t in library.get_added_tokens_decoder().values()]
    texts = ["hello <|endoftext|> x", "a b", *(f"one {a} two{a}three" for a in added), "", *added]
    got = [np.frombuffer(g, "<u4").tolist() for g in ChunkEncoder(library).encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(len(library.encode(a, add_special_tokens=False).ids) == 1 for a in added)


def test_letters_of_python_are_letters_of_the_library():
    import sys

    import regex

    python = {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalpha()}
    assert all(regex.fullmatch(r"\p{L}", c) for c in python)


@settings(max_examples=300, deadline=None)
@given(st.one_of(ODD, st.text(max_size=30)))
def test_ranks_give_the_ids_of_the_rank_library(spec, rank_encoder, text):
    text = text.encode("utf-8", "ignore").decode()
    worker = bpe._worker(spec)
    ids = np.frombuffer(worker.encoder.encode([text])[0], "<u4").tolist()
    assert ids == rank_encoder.encode_ordinary(text)
    assert worker.decode(ids) == text.encode()


def test_round_trip_of_edge_texts(frame, edge_texts, rank_encoder):
    got = {r.doc_id: r for r in bpe.round_trip(frame(edge_texts, extra=True), RANKS, P.PATTERN).collect()}
    assert len(got) == len(edge_texts)
    for i, t in enumerate(edge_texts):
        ids = rank_encoder.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_offsets_and_split_characters(frame, rank_encoder):
    texts = ["", None, "日本 🙂 naïve"]
    rows = {r.doc_id: r for r in bpe.encode(frame(texts), RANKS, P.PATTERN).collect()}
    assert rows[0].ids == [] and rows[1].ids == []
    assert rows[2].ids == rank_encoder.encode_ordinary(texts[2])
    covered = {c for a, b in zip(rows[2].starts, rows[2].ends, strict=True) for c in range(a, b)}
    assert covered == set(range(len(texts[2])))
    back = {r.doc_id: r for r in bpe.decode(bpe.encode(frame(texts), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()}
    assert back[2].text == texts[2] and bytes(back[2].bytes) == texts[2].encode() and back[1].text == ""


def check_packing(rows, texts, library, most=1024):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // most)))
        assert own[0].start == 0 and sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start: r.start + r.length].tobytes())
            assert r.length == most or r.piece == 0
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= most
    return sequences


def test_packing_edge_texts(frame, edge_texts, library):
    rows = packing.pack_documents(frame(edge_texts, extra=True), JSON).collect()
    check_packing(rows, edge_texts, library)


def test_packing_is_close_to_the_bound(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    rows = packing.pack_documents(docs, JSON).collect()
    sequences = check_packing(rows, texts, library)
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1


def test_packing_empty_table(frame):
    assert packing.pack_documents(frame([]), JSON).collect() == []


def test_the_fullest_sequence_closes_first():
    bins = packing.BestFit(10, open_bins=2)
    assert [bins.place(n) for n in (7, 6, 5)] == [(0, 0), (1, 0), (2, 0)]  # the sequence of 7 has closed
    assert bins.place(3) == (1, 6) and bins.place(5) == (2, 5) and bins.place(10) == (3, 0)
    assert bins.place(1) == (1, 9)
