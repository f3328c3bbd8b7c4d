"""Byte-level BPE encoding and decoding from a table of ranks (operator 4).

The tokenizers library works on characters, so every byte has a character of
its own: the byte itself where that prints, else one from U+0100 up. The
merges follow from the ranks: a token of two bytes or more is the merge of
the two tokens that its bytes reach under all lower ranks. Decoding maps ids
to bytes; a character whose bytes lie in several tokens is whole again once
the bytes are joined.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_table import byte_characters
from .chunk_encoder import ChunkEncoder
from .work import id_and_text, id_type


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens whose merge makes ``token`` when lower ranks merge first; None if they do not reach two."""
    parts = [token[i: i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        options = [(ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1)]
        rank, i = min(options)
        if rank >= limit:
            return None
        parts[i: i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def tokenizer_spec(ranks: dict[bytes, int], pattern: str) -> str:
    """A serialised tokenizer of the tokenizers library with these ranks and this pre-tokenisation."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_characters()
    name = lambda token: "".join(chars[b] for b in token)
    order = sorted(ranks, key=ranks.__getitem__)
    merges = [(name(m[0]), name(m[1])) for t in order if len(t) > 1 and (m := last_merge(t, ranks))]
    tokenizer = Tokenizer(models.BPE({name(t): ranks[t] for t in order}, merges))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer.to_str()


def decode_table(spec: str) -> list[bytes]:
    """The bytes of each id, by the reversed byte table."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    vocab = json.loads(spec)["model"]["vocab"]
    table = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        table[i] = bytes(byte_of[c] for c in token)
    return table


class _Worker:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.encoder = ChunkEncoder(self.tokenizer)
        self.table = decode_table(spec)
        self.decimals = [str(i).encode() for i in range(len(self.table))]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


_workers: dict[int, _Worker] = {}


def _worker(spec: str) -> _Worker:
    key = hash(spec)
    if key not in _workers:
        _workers[key] = _Worker(spec)
    return _workers[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and each token's character offsets: starts and ends (arrays of int).

    A token that holds only some bytes of a character spans the whole character. A null or empty text has
    no tokens; an empty table gives no rows.
    """
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_spec(read_ranks(ranks_path), pattern))
    kind = id_type(docs, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _worker(spec.value).tokenizer
        ints = pa.list_(pa.int32())
        for batch in batches:
            for k in range(batch.num_rows):  # offsets take much room: one text at a time
                e = tokenizer.encode(batch.column(1)[k].as_py(), add_special_tokens=False)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([e.ids], ints), pa.array([[a for a, _ in e.offsets]], ints),
                     pa.array([[b for _, b in e.offsets]], ints)], ["doc_id", "ids", "starts", "ends"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, bytes and text of rows of ids; bytes that end inside a character become U+FFFD in the text only."""
    spec = encoded.sparkSession.sparkContext.broadcast(tokenizer_spec(read_ranks(ranks_path), pattern))
    kind = id_type(encoded, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _worker(spec.value)
        for batch in batches:
            found = [worker.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()),
                 pa.array([x.decode("utf-8", "replace") for x in found], pa.string())], ["doc_id", "bytes", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and then decoded from its ids alone."""
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_spec(read_ranks(ranks_path), pattern))
    kind = id_type(docs, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _worker(spec.value)
        for batch in batches:
            counts, listed, decoded = [], [], []
            for raw in worker.encoder.encode(batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, "<u4").tolist()
                counts.append(len(ids))
                listed.append(hashlib.sha256(b" ".join(map(worker.decimals.__getitem__, ids))).hexdigest())
                decoded.append(hashlib.sha256(worker.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(listed, pa.string()),
                 pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
