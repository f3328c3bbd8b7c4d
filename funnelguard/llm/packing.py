"""Best-fit packing of documents into sequences of a fixed number of tokens (operator 1).

Every document is encoded once; only its pieces' lengths are shuffled. Pieces
are dealt to tasks by a hash of their content, so a hot source spreads, and
each task runs a bounded-space best fit over its own sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk_encoder import ChunkEncoder
from .work import id_and_text, id_type, parts, stored, workspace

MAX_TOKENS, END_ID = 1024, 2
#: Sequences a task keeps open at most, and pieces that need packing dealt to one task.
OPEN_BINS, PIECES_PER_TASK = 65_536, 50_000

_encoders: dict[int, ChunkEncoder] = {}


def encoder_of(spec: str) -> ChunkEncoder:
    """The worker's encoder for a serialised tokenizer; it keeps its cache between tasks."""
    from tokenizers import Tokenizer

    key = hash(spec)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(Tokenizer.from_str(spec))
    return _encoders[key]


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if wanted, the ids.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. One of more than
    ``max_tokens`` ids is cut so that only its first piece may be shorter.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # a vocabulary of fixed size
    kind = id_type(docs, id_col)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(spec.value)
        for batch in batches:
            rows, place = [], []
            for k, raw in enumerate(encoder.encode(batch.column(1).to_pylist())):
                ids = raw + end
                n = len(ids) // 4
                a, piece = 0, 0
                while a < n:
                    b = a + ((n % max_tokens or max_tokens) if a == 0 else max_tokens)
                    part = ids[4 * a: 4 * b]
                    rows.append((piece, a, b - a, zlib.crc32(part), part))
                    place.append(k)
                    a, piece = b, piece + 1
            cols = list(zip(*rows, strict=True)) or [()] * 5
            out = [batch.column(0).take(pa.array(place, pa.int64())), pa.array(cols[0], pa.int32()),
                   *(pa.array(c, pa.int64()) for c in cols[1:4])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(cols[4], pa.binary()))
                names.append("ids_le")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids_le binary" * with_ids
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


class BestFit:
    """Best fit with at most ``open_bins`` open sequences; past that the fullest closes first.

    ``bits`` has bit f set when an open sequence has f tokens free, so the tightest one that still takes
    a piece is the lowest set bit from the piece's length up.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.bits, self.open, self.made = 0, 0, 0
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        found = self.free[free].pop()
        if not self.free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The sequence of a piece and its offset there."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.capacity - free


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS,
         per_task: int = PIECES_PER_TASK, folder: str | None = None) -> DataFrame:
    """``pieces`` (as of :func:`token_pieces`) with sequence_id and offset.

    A sequence's pieces fill it from 0 without gaps; a piece of ``max_tokens`` has a sequence of its own.
    Tasks take long pieces first and keep sequences open for the short ones. Repeated rows are packed
    each for itself. An empty table gives no rows.
    """
    table = stored(pieces, f"{folder or workspace(pieces.sparkSession, 'packing')}/pieces")
    tasks = parts(table.filter(F.col("length") < max_tokens).count(), per_task)
    spread = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    names = table.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        bins = BestFit(max_tokens, open_bins)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), pa.array([base + s for s, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return (table.repartition(tasks, spread)
            .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
            .mapInArrow(run, f"{fields}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and pack ``docs`` with the production limits."""
    return pack(token_pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col))
