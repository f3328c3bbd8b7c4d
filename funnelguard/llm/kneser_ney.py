"""Language-model scoring by an interpolated modified Kneser-Ney model of two or three words (operator 3).

Texts are tokenized twice: once to count words by hash, which numbers the
vocabulary, and once to store every text as word numbers. All else reads
those. Counting is Spark shuffles of packed, map-side combined counts: of
words by hash, of pairs of word numbers by context and, for three words, of
triples by the place of their first pair among all pairs. The ranges of a
shuffle are cut by the counts of the contexts, so that they are alike in
size; a context that would fill more than one range is split by the word that
follows. Each task writes its range of the model as sorted arrays, one file,
to the shared folder; workers map the files that they need, a bounded number
at a time, and search them for a batch's distinct pairs, so no worker holds
the model. Keys are relative to their range, so that they fit 64 bits however
many words and pairs there are.

p(w | v) = max(c(v w) - D, 0) / c(v) + (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v) * p(w), where p(w) does the
same with the number of distinct words before w, over a uniform share for each known word and one unknown one.
With triples, p(w | u v) is worked out so from c(u v w), and p(w | v) from the numbers of distinct words before
the pairs v w in place of c(v w). Two starts stand before a text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import packed
from .work import id_and_text, id_type, parts, release, stored, workspace

FOLDS, HELD_OUT = 7, 2
#: Words of the longest n-grams.
ORDER = 3
#: Stand-in for the end of a text; no word holds white space.
END = b"\n"
#: Tokens whose counts a task combines before it sends them, and input characters for each shard of the model.
COMBINE, CHARS_PER_SHARD = 4_000_000, 16_000_000
#: Tokens looked up together: more of them share words, pairs and places in the model's files.
TOGETHER = 1_500_000
HALF = np.uint64(32)


def word_hash(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word)


def held_out(id_col: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Documents that are not learnt from; also those without an id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(True))


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens, each token's place among them, and each text's number of tokens.

    Tokens are the words of a text with A-Z lower-cased, parted at the six ASCII white-space characters, and its end.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes, words = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
    empty = pc.binary_length(words).to_numpy(zero_copy_only=False) == 0  # before and after white space at the edges
    if empty.any():
        sizes = sizes - np.bincount(np.repeat(np.arange(len(sizes)), sizes)[empty], minlength=len(sizes))
        words = words.filter(pa.array(~empty))
    found = words.dictionary_encode()
    distinct = [*found.dictionary.cast(pa.binary()).to_pylist(), END]
    sizes = sizes + 1
    ends = np.cumsum(sizes) - 1
    codes = np.full(len(words) + len(sizes), len(distinct) - 1, np.int64)
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = found.indices.to_numpy(zero_copy_only=False)
    return np.array([word_hash(w) for w in distinct], np.uint64), codes, sizes


def _rows(found: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A row (shard, blob) for each shard's ascending keys and counts."""
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([packed.pack(k, n) for k, n in found.values()], pa.binary())],
                                      ["shard", "blob"])


class _Combiner:
    """Counts of a task by shard, added up before they are sent."""

    def __init__(self):
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
        self.held.setdefault(shard, []).append((keys, counts))
        self.size += len(keys)

    def rows(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        """What is held, if there are ``least`` keys."""
        if self.size >= least:
            held, self.held, self.size = self.held, {}, 0
            yield _rows({b: packed.summed(*map(np.concatenate, zip(*some, strict=True))) for b, some in sorted(held.items())})


def _merge_shards(rows: DataFrame, shards: int, finish, schema: str) -> DataFrame:
    """``finish(shard, keys, counts)`` in a task for each shard: rows as lists that follow ``schema``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        now = None

        def done() -> pa.RecordBatch:
            found = finish(now, *packed.merged(held))
            return pa.RecordBatch.from_pylist(found, schema=arrow) if found else pa.RecordBatch.from_pylist([], schema=arrow)

        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != now:
                    if now is not None:
                        yield done()
                    held, now = [], shard
                held.append(blob)
        if now is not None:
            yield done()

    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in schema.split(","))])
    return rows.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def spread(shards: int) -> np.ndarray:
    """The least 64-bit hash of each shard."""
    return np.array([(b << 64) // shards for b in range(shards)], np.uint64)


def shard_words(words: int, shards: int) -> np.ndarray:
    """The first word number of each shard; the number after the last word stands for the start of a text."""
    return np.array([b * (words + 1) // shards for b in range(shards)] + [words + 1], np.int64)


@dataclass(frozen=True)
class Ranges:
    """Ranges of rows (context, word) in order: the least row of each. A context with several ranges is split by word."""
    contexts: np.ndarray
    words: np.ndarray

    def cuts(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Where the ranges begin among ascending rows, and the number of rows."""
        at = np.searchsorted(contexts, self.contexts)
        for b in np.flatnonzero(self.words > 0):
            end = np.searchsorted(contexts, self.contexts[b], "right")
            at[b] += np.searchsorted(words[at[b]:end], self.words[b])
        at[0] = 0
        return np.append(at, len(contexts))

    def touched(self, contexts: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Range, first and last place + 1 of the ranges that have some of the ascending rows."""
        cuts = self.cuts(contexts, words)
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            yield b, int(cuts[b]), int(cuts[b + 1])

    @property
    def split(self) -> np.ndarray:
        return np.unique(self.contexts[self.words > 0])

    def width(self, b: int, end: int) -> int:
        """Contexts that rows of range ``b`` can have; ``end`` is one above the last context of all."""
        return int((self.contexts[b + 1] + 1 if b + 1 < len(self.contexts) else end) - self.contexts[b])


def _bounds(counts: np.ndarray, first: int, before: int, each: int, words: int) -> list[tuple[int, int]]:
    """(context, word) at which ranges of weight ``each`` begin, among contexts from ``first`` on with ``before`` weight before them."""
    ends = before + np.cumsum(counts, dtype=np.int64)
    marks = np.arange(-(-before // each), -(-int(ends[-1]) // each)) * each if len(ends) else np.zeros(0, np.int64)
    at, n = np.unique(np.searchsorted(ends, marks, "right"), return_counts=True)
    # a context with one mark begins a range; one with several is cut at equal numbers of words, which are numbered by hash
    return [(first + int(c), words * k // int(m)) for c, m in zip(at, n, strict=True) for k in range(int(m))]


def unique_rows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows of two columns of numbers from -1 on, ascending, as two columns, with their counts and each row's place."""
    if not len(a):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    if a.max() < (1 << 32) - 2 and b.max() < (1 << 32) - 2:
        key = ((a + 1).astype(np.uint64) << HALF) | (b + 1).astype(np.uint64)
        found, back, n = np.unique(key, return_inverse=True, return_counts=True)
        return (found >> HALF).astype(np.int64) - 1, (found & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1, n, back
    # numbers beyond 32 bits: by their places among those of the batch
    (of_a, at_a), (of_b, at_b) = np.unique(a, return_inverse=True), np.unique(b, return_inverse=True)
    key = (at_a.astype(np.uint64) << HALF) | at_b.astype(np.uint64)
    found, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return of_a[found >> HALF], of_b[found & np.uint64(0xFFFFFFFF)], n, back


class _Vocabulary:
    """Word numbers: places of hashes among all sorted hashes."""

    def __init__(self, shelf: packed.Shelf, sizes: list[int]):
        self.shelf, self.sizes, self.first = shelf, sizes, spread(len(sizes))
        self.base = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """-1 for words that were not learnt."""
        order = np.argsort(hashes)
        wanted, found = hashes[order], np.full(len(hashes), -1, np.int64)
        cuts = np.append(np.searchsorted(wanted, self.first), len(wanted))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            if self.sizes[b]:
                lo, hi, keys = cuts[b], cuts[b + 1], self.shelf[f"words-{b}"]["hashes"]
                at = np.minimum(np.searchsorted(keys, wanted[lo:hi]), len(keys) - 1)
                found[lo:hi] = np.where(keys[at] == wanted[lo:hi], at + self.base[b], -1)
        out = np.empty(len(hashes), np.int64)
        out[order] = found
        return out

    def count(self, numbers: np.ndarray) -> np.ndarray:
        return _gather(lambda b: self.shelf[f"words-{b}"]["counts"], self.base, numbers)


def _gather(values: Callable[[int], np.ndarray], base: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Values of numbers in arrays 0, 1, ... that start at ``base``; 0 for -1."""
    out = np.zeros(len(numbers), np.int64)
    order = np.argsort(numbers, kind="stable")
    ordered = numbers[order]
    cuts = np.searchsorted(ordered, base)
    for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        lo, hi = cuts[b], cuts[b + 1]
        out[order[lo:hi]] = values(b)[ordered[lo:hi] - base[b]]
    return out


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the numbers of n-grams seen once to four times; half their bound where those are too few."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(d if 0 < d < k else k / 2 for k, d in enumerate(found, 1))


@dataclass(frozen=True)
class Model:
    """Where the model lies and what is the same for all its parts; the lists have an entry for each shard at most."""
    folder: str
    order: int
    words: int
    train_tokens: int
    word_sizes: list[int]
    first_word: np.ndarray
    pair_ranges: Ranges
    pair_sizes: list[int]
    split_contexts: dict[int, tuple[int, int, int, int]]
    followers: int
    spare: float
    word_discounts: tuple[float, float, float]
    pair_discounts: tuple[float, float, float]
    triple_ranges: Ranges | None = None
    triple_sizes: list[int] | None = None
    split_places: dict[int, tuple[int, int, int, int]] | None = None
    triple_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)


def word_bits(words: int) -> np.uint64:
    """Bits of a word number in a key."""
    return np.uint64(max(1, words.bit_length()))


class _Pairs:
    """Places of pairs (context, word) among all learnt ones, in order."""

    def __init__(self, shelf: packed.Shelf, ranges: Ranges, sizes: list[int], words: int):
        self.shelf, self.ranges, self.sizes, self.bits = shelf, ranges, sizes, word_bits(words)
        self.base = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)

    def find(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """-1 where an ascending pair was not learnt."""
        place = np.full(len(contexts), -1, np.int64)
        known = np.flatnonzero((contexts >= 0) & (words >= 0))
        contexts, words = contexts[known], words[known]
        for b, lo, hi in self.ranges.touched(contexts, words):
            if self.sizes[b]:
                file = self.shelf[f"pairs-{b}"]
                wanted = ((contexts[lo:hi] - self.ranges.contexts[b]).astype(np.uint64) << self.bits) | words[lo:hi].astype(np.uint64)
                at = packed.places_of(file, wanted)
                place[known[lo:hi]] = np.where(at >= 0, at + self.base[b], -1)
        return place

    def last_words(self, places: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << self.bits) - np.uint64(1)
        return _gather(lambda b: (packed.whole(self.shelf[f"pairs-{b}"]) & mask).astype(np.int64), self.base, places)


class _Mapped:
    """A worker's view of the model."""

    def __init__(self, model: Model):
        self.model, self.shelf = model, packed.Shelf(model.folder)
        self.vocabulary = _Vocabulary(self.shelf, model.word_sizes)
        self.pairs = _Pairs(self.shelf, model.pair_ranges, model.pair_sizes, model.words)
        self.bits = word_bits(model.words)
        self.low_bits = np.uint32(min(31, int(self.bits)))

    def unigram(self, numbers: np.ndarray) -> np.ndarray:
        m = self.model
        seen = _gather(lambda b: self.shelf[f"before-{b}"]["before"], m.first_word, numbers)
        share = m.spare / (m.words + 1)
        if not m.followers:
            return np.full(len(numbers), share)
        return np.maximum(seen - _discount(seen, m.word_discounts), 0) / m.followers + share

    def contexts(self, numbers: np.ndarray) -> np.ndarray:
        """Of contexts (-1: not learnt): how often a word follows, and how many do once, twice and more often."""
        distinct, back = np.unique(numbers, return_inverse=True)
        out = np.zeros((4, len(distinct)), np.int64)
        known = np.flatnonzero(distinct >= 0)
        ranges = self.model.pair_ranges
        # the last range that begins at the context or before it is the only one, unless the context is split
        which = np.searchsorted(ranges.contexts, distinct[known], "right") - 1
        for b in np.unique(which).tolist():
            if self.model.pair_sizes[b]:
                own = known[which == b]
                out[:, own] = self.shelf[f"stats-{b}"]["contexts"][:, distinct[own] - ranges.contexts[b]]
        for i in known.tolist() if len(self.model.split_contexts) else ():
            if int(distinct[i]) in self.model.split_contexts:
                out[:, i] = self.model.split_contexts[int(distinct[i])]
        return out[:, back]

    def bigram(self, contexts: np.ndarray, numbers: np.ndarray, place: np.ndarray) -> np.ndarray:
        """p(word | context) of distinct pairs at ``place`` among all pairs; -1 is unknown, of words, contexts and places."""
        m = self.model
        distinct, back = np.unique(numbers, return_inverse=True)
        p = self.unigram(distinct)[back]
        total, n1, n2, n3 = self.contexts(contexts)
        known = total > 0
        count = _gather(lambda b: self.shelf[f"stats-{b}"]["counts"], self.pairs.base, place)
        d1, d2, d3 = m.pair_discounts
        left = np.where(known, d1 * n1 + d2 * n2 + d3 * n3, 1.0)
        total = np.where(known, total, 1)
        return np.where(known, np.maximum(count - _discount(count, m.pair_discounts), 0) / total + left / total * p, p)

    def followed(self, places: np.ndarray) -> np.ndarray:
        """Of ascending places of pairs: how often a word follows, and how many do once, twice and more often."""
        m, out = self.model, np.zeros((4, len(places)), np.int64)
        which = np.searchsorted(m.triple_ranges.contexts, places, "right") - 1
        for b in np.unique(which).tolist():
            if m.triple_sizes[b]:
                lo, hi = np.searchsorted(which, [b, b + 1])
                file = self.shelf[f"triples-{b}"]
                wanted = (places[lo:hi] - m.triple_ranges.contexts[b]).astype(np.uint64)
                at, inside = packed.least_from(file, wanted << self.bits)
                # the low halves of a pair's keys differ in a word's bits alone, unless those are more
                own = (inside & (file["low"][at] >> self.low_bits == (wanted << self.bits).astype(np.uint32) >> self.low_bits)
                       if self.bits < 32 else packed.whole(file, at) >> self.bits == wanted)
                out[0, lo:hi] = np.where(own, file["counts"][at], 0)
                for k in (1, 2, 3):
                    out[k, lo:hi] = np.minimum(out[0, lo:hi], 3) == k
                if len(file["many"]):
                    at = np.minimum(np.searchsorted(file["many"], wanted), len(file["many"]) - 1)
                    hit = np.flatnonzero(file["many"][at] == wanted)
                    out[:, lo + hit] = file["many_counts"][:, at[hit]]
        for place, of in m.split_places.items():
            lo, hi = np.searchsorted(places, [place, place + 1])
            out[:, lo:hi] = np.array(of)[:, None]
        return out

    def trigram(self, place: np.ndarray, p: np.ndarray, back: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """p(word | two words before) of each token.

        ``place`` has the ascending places of distinct pairs among all pairs (-1: not learnt), ``p`` their
        p(word | last word), ``back`` each token's pair.
        """
        m = self.model
        places = np.append(place, self.pairs.base[-1])  # two starts
        known = np.flatnonzero(places >= 0)
        followed = np.zeros((4, len(places)), np.int64)
        followed[:, known] = self.followed(places[known])
        total, n1, n2, n3 = followed
        d1, d2, d3 = m.triple_discounts
        left = np.where(total > 0, d1 * n1 + d2 * n2 + d3 * n3, 1.0) / np.maximum(total, 1)
        before = _pair_before(back, sizes, len(place))
        there = np.flatnonzero((total > 0)[before] & (numbers >= 0))
        # known pairs ascend in place as they do in their number
        which, words, _, again = unique_rows(before[there], numbers[there])
        count = np.zeros(len(which), np.int64)
        for b, lo, hi in m.triple_ranges.touched(places[which], words):
            if m.triple_sizes[b]:
                file = self.shelf[f"triples-{b}"]
                wanted = ((places[which[lo:hi]] - m.triple_ranges.contexts[b]).astype(np.uint64) << self.bits) | words[lo:hi].astype(np.uint64)
                at = packed.places_of(file, wanted)
                count[lo:hi] = np.where(at >= 0, file["counts"][at], 0)
        out = left[before] * p[back]
        gain = np.maximum(count - _discount(count, m.triple_discounts), 0) / total[which] if len(which) else np.zeros(0)
        out[there] += gain[again]
        return out


def _narrow(counts: np.ndarray) -> np.ndarray:
    """``counts`` in the least unsigned type that holds them."""
    return counts.astype(np.min_scalar_type(int(counts.max()))) if counts.size else counts


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def _pair_before(back: np.ndarray, sizes: np.ndarray, starts: int) -> np.ndarray:
    """For each token, the pair before it, from each token's pair; ``starts`` stands for two starts."""
    before = np.roll(back, 1)
    before[np.cumsum(sizes) - sizes] = starts
    return before


def _kind(words: int) -> str:
    """The type that stores word numbers and, as its largest value, words that were not learnt."""
    return "<u4" if words < (1 << 32) - 1 else "<u8"


def numbered(docs: DataFrame, folder: str, word_sizes: list[int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, held_out and tokens, each text as word numbers."""
    kind, width = id_type(docs, id_col), _kind(sum(word_sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(packed.Shelf(folder), word_sizes)
        for batch in batches:
            hashes, codes, sizes = coded(batch.column(2))
            # -1 becomes the largest value
            raw = vocabulary.numbers(hashes).astype(width)[codes].tobytes()
            ends = np.concatenate(([0], np.cumsum(sizes))) * np.dtype(width).itemsize
            tokens = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype("<i8").tobytes()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens.cast(pa.binary())], ["doc_id", "held_out", "tokens"])

    rows = id_and_text(docs, id_col, text_col).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, tokens binary")


def _together(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until they have about :data:`TOGETHER` tokens of ``width`` bytes in a column; one of more stays as it is."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if size >= TOGETHER * width:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            held, size = [], 0
    if size or held:
        found = pa.Table.from_batches(held).combine_chunks().to_batches()
        yield found[0] if found else held[0]


def _read(tokens: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a batch's texts one after the other, -1 for words that were not learnt, and each text's tokens."""
    width = np.dtype(_kind(words))
    sizes = pc.binary_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64) // width.itemsize
    raw = np.frombuffer(b"".join(tokens.to_pylist()), width)
    numbers = raw.astype(np.int64)
    numbers[raw == np.iinfo(width).max] = -1
    return numbers, sizes


def _contexts(numbers: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """The word before each token; ``words`` stands for the start of a text."""
    contexts = np.roll(numbers, 1)
    contexts[np.cumsum(sizes) - sizes] = words
    return contexts


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
          chars_per_shard: int = CHARS_PER_SHARD, order: int = ORDER) -> Model:
    """Count the documents that are not held out and write the model's arrays to ``folder``, which must be shared.

    ``order`` is the number of words of the longest n-grams, two or three.
    """
    return train_numbered(docs, id_col, text_col, folder, chars_per_shard, order)[0]


def train_numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
                   chars_per_shard: int = CHARS_PER_SHARD, order: int = ORDER) -> tuple[Model, DataFrame]:
    """:func:`train`, and the documents as word numbers, as :func:`score_numbered` reads them."""
    if order not in (2, 3):
        raise ValueError(f"the order of the model is 2 or 3, not {order}")
    spark = docs.sparkSession
    work = folder or workspace(spark, "kneser-ney")
    at, seen = packed.shared_folder(work) + "/model", packed.shared_folder(work) + "/seen"
    texts = id_and_text(docs, id_col, text_col).filter(~held_out(F.col("doc_id"))).select("text")
    chars, rows = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = parts(chars or 0, chars_per_shard)
    hash_first = spread(shards)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Combiner()
        for batch in batches:
            hashes, codes, _ = coded(batch.column(0))
            keys, counts = packed.summed(hashes, np.bincount(codes, minlength=len(hashes)))
            cuts = np.append(np.searchsorted(keys, hash_first), len(keys))
            for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                held.add(b, keys[cuts[b]:cuts[b + 1]], counts[cuts[b]:cuts[b + 1]])
            yield from held.rows(COMBINE)
        yield from held.rows()

    def keep_words(shard: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
        packed.save_together(at, f"words-{shard}", {"hashes": keys, "counts": _narrow(counts)})
        return [{"shard": shard, "words": len(keys), "tokens": int(counts.sum())}]

    made = {r.shard: r for r in _merge_shards(texts.mapInArrow(count_words, "shard int, blob binary"), shards, keep_words,
                                              "shard int,words long,tokens long").collect()}  # a row for each shard
    word_sizes = [made[b].words if b in made else 0 for b in range(shards)]
    word_tokens = [made[b].tokens if b in made else 0 for b in range(shards)]
    words, train_tokens = sum(word_sizes), sum(word_tokens)
    bits, first_word, token_bytes = word_bits(words), shard_words(words, shards), np.dtype(_kind(words)).itemsize

    table = stored(numbered(docs, at, word_sizes, id_col, text_col), f"{work}/numbered", "zstd")
    release(spark)
    learnt = table.filter(~F.col("held_out")).select("tokens")
    each = max(1, -(-(train_tokens + rows) // shards))

    def ranges(sizes: list[int], weights: list[int], place: str, file: str) -> Ranges:
        """Ranges of about ``each`` tokens of the contexts whose counts stand in files of the shards; the starts come last."""
        first, before = np.concatenate(([0], np.cumsum(sizes))).tolist(), np.concatenate(([0], np.cumsum(weights))).tolist()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shelf = packed.Shelf(place)
            for batch in batches:
                for b in batch.column(0).to_pylist():
                    found = _bounds(shelf[f"{file}-{b}"]["counts"], first[b], before[b], each, words) if sizes[b] else []
                    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([w for _, w in found], pa.int64())],
                                                     ["context", "word"])

        found = [(r.context, r.word) for r in spark.range(0, shards, 1, shards).mapInArrow(run, "context long, word long").collect()]
        found += _bounds(np.array([rows]), first[-1], before[-1], each, words)  # rows for about as many ranges as shards
        ordered = sorted({(0, 0), *found})
        return Ranges(np.array([c for c, _ in ordered], np.int64), np.array([w for _, w in ordered], np.int64))

    pair_ranges = ranges(word_sizes, word_tokens, at, "words")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Combiner()
        for batch in _together(batches, 0, token_bytes):
            numbers, sizes = _read(batch.column(0), words)
            context, word, n, _ = unique_rows(_contexts(numbers, sizes, words), numbers)
            _deal(held, pair_ranges, context, word, n, bits)
            yield from held.rows(COMBINE)
        yield from held.rows()

    def tally(counts: np.ndarray) -> bytes:
        return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype("<i8").tobytes()

    def keep_stats(ranges: Ranges, end: int):
        def run(shard: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
            context = (keys >> bits).astype(np.int64)
            table = np.zeros((4, ranges.width(shard, end)), np.int64)
            table[0] = np.bincount(context, weights=counts, minlength=table.shape[1])
            for k in (1, 2, 3):
                table[k] = np.bincount(context[np.minimum(counts, 3) == k], minlength=table.shape[1])
            packed.save_together(at, f"stats-{shard}", {"counts": _narrow(counts), "contexts": _narrow(table)})
            return [{"shard": shard, "tally": tally(counts), "own": table[:, 0].astype("<i8").tobytes()}]
        return run

    keep_pair_stats = keep_stats(pair_ranges, words + 1)

    def keep_pairs(shard: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
        packed.save_together(at, f"pairs-{shard}", packed.halved(keys))
        if order == 3:
            packed.save_together(seen, f"pairs-{shard}", {"counts": _narrow(counts)})
        own = keep_pair_stats(shard, keys, counts)[0]["own"] if order == 2 else b""
        after, n = np.unique(keys & ((np.uint64(1) << bits) - np.uint64(1)), return_counts=True)
        cuts = np.append(np.searchsorted(after, first_word[:-1].astype(np.uint64)), len(after))
        out = [{"shard": b, "blob": packed.pack(after[cuts[b]:cuts[b + 1]], n[cuts[b]:cuts[b + 1]])}
               for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()]
        return out + [{"shard": -1 - shard, "blob": len(keys).to_bytes(8, "little") + int(counts.sum()).to_bytes(8, "little") + tally(counts) + own}]

    counted = stored(_merge_shards(learnt.mapInArrow(count_pairs, "shard int, blob binary"), len(pair_ranges.contexts), keep_pairs,
                                   "shard int,blob binary"), f"{work}/before")

    def keep_before(shard: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
        dense = np.zeros(first_word[shard + 1] - first_word[shard], np.int64)
        dense[keys.astype(np.int64) - first_word[shard]] = counts
        packed.save_together(at, f"before-{shard}", {"before": _narrow(dense)})
        return [{"shard": shard, "total": int(counts.sum()), **{f"n{k}": int((counts == k).sum()) for k in (1, 2, 3, 4)}}]

    sums = _merge_shards(counted.filter("shard >= 0"), shards, keep_before,
                         "shard int,total long,n1 long,n2 long,n3 long,n4 long").collect()  # a row for each shard
    filled = {r.shard for r in sums}
    for b in range(shards):
        if b not in filled:
            packed.save_together(at, f"before-{b}", {"before": np.zeros(first_word[b + 1] - first_word[b], np.int64)})
    # a row for each range: pairs, tokens, numbers of pairs by count, and the split context's part
    tallies = {-1 - r.shard: np.frombuffer(bytes(r.blob), "<i8") for r in counted.filter("shard < 0").collect()}
    release(spark, f"{work}/before")
    pair_sizes = [int(tallies[b][0]) if b in tallies else 0 for b in range(len(pair_ranges.contexts))]
    word_n = [sum(r[f"n{k}"] for r in sums) for k in (1, 2, 3, 4)]
    followers = sum(r.total for r in sums)
    d = discounts(word_n)
    many = words - word_n[0] - word_n[1]
    spare = (d[0] * word_n[0] + d[1] * word_n[1] + d[2] * many) / followers if followers else 1.0
    if order == 2:
        pair_n = [int(sum(t[k] for t in tallies.values())) for k in range(2, 6)]
        split = _split_sums(pair_ranges, {b: t[6:10] for b, t in tallies.items()})
        return Model(at, order, words, train_tokens, word_sizes, first_word, pair_ranges, pair_sizes, split, followers, spare, d,
                     discounts(pair_n)), table

    pairs = sum(pair_sizes)  # the place after the last pair stands for two starts
    pair_weights = [int(tallies[b][1]) if b in tallies else 0 for b in range(len(pair_ranges.contexts))]
    shards = len(pair_ranges.contexts)
    triple_ranges = ranges(pair_sizes, pair_weights, seen, "pairs")
    release(spark, f"{work}/seen")

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _Pairs(packed.Shelf(at), pair_ranges, pair_sizes, words), _Combiner()
        for batch in _together(batches, 0, token_bytes):
            numbers, sizes = _read(batch.column(0), words)
            context, word, _, back = unique_rows(_contexts(numbers, sizes, words), numbers)
            places = np.append(known.find(context, word), pairs)
            which, word, n, _ = unique_rows(_pair_before(back, sizes, len(context)), numbers)
            _deal(held, triple_ranges, places[which], word, n, bits)
            yield from held.rows(COMBINE)
        yield from held.rows()

    def keep_triples(shard: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
        shelf = packed.Shelf(at)
        places = keys >> bits
        starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        width = np.diff(np.append(starts, len(keys)))
        # a pair with one follower has all that is wanted of it in that triple
        many = np.flatnonzero(width > 1)
        table = np.array([np.add.reduceat(counts, starts), *(np.add.reduceat((np.minimum(counts, 3) == k).astype(np.int64), starts)
                                                             for k in (1, 2, 3))])
        packed.save_together(at, f"triples-{shard}", {**packed.halved(keys), "counts": _narrow(counts), "many": _narrow(places[starts[many]]),
                                                      "many_counts": _narrow(table[:, many])})
        own = table[:, 0] if places[0] == 0 else np.zeros(4, np.int64)  # of the range's first place
        place = places[starts].astype(np.int64) + triple_ranges.contexts[shard]
        last = np.full(len(place), words, np.int64)
        inside = place < pairs
        last[inside] = _Pairs(shelf, pair_ranges, pair_sizes, words).last_words(place[inside])
        context, word, n, _ = unique_rows(np.repeat(last, width), (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))
        held = _Combiner()
        _deal(held, pair_ranges, context, word, n, bits)
        out = [{"shard": b, "blob": packed.pack(*some[0])} for b, some in held.held.items()]
        return out + [{"shard": -1 - shard, "blob": len(keys).to_bytes(8, "little") + tally(counts) + own.astype("<i8").tobytes()}]

    ended = stored(_merge_shards(learnt.mapInArrow(count_triples, "shard int, blob binary"), len(triple_ranges.contexts), keep_triples,
                                 "shard int,blob binary"), f"{work}/before-pairs")
    release(spark)
    # every pair ends a triple, so that counts and pairs stand in the same order
    middle = {r.shard: r for r in _merge_shards(ended.filter("shard >= 0"), len(pair_ranges.contexts), keep_pair_stats,
                                                "shard int,tally binary,own binary").collect()}  # a row for each range
    tallies = {-1 - r.shard: np.frombuffer(bytes(r.blob), "<i8") for r in ended.filter("shard < 0").collect()}
    release(spark, f"{work}/before-pairs")
    triple_sizes = [int(tallies[b][0]) if b in tallies else 0 for b in range(len(triple_ranges.contexts))]
    pair_n = [int(sum(np.frombuffer(bytes(r.tally), "<i8")[k] for r in middle.values())) for k in range(4)]
    triple_n = [int(sum(t[k] for t in tallies.values())) for k in range(1, 5)]
    split = _split_sums(pair_ranges, {b: np.frombuffer(bytes(r.own), "<i8") for b, r in middle.items()})
    split_places = _split_sums(triple_ranges, {b: t[5:9] for b, t in tallies.items()})
    return Model(at, order, words, train_tokens, word_sizes, first_word, pair_ranges, pair_sizes, split, followers, spare, d,
                 discounts(pair_n), triple_ranges, triple_sizes, split_places, discounts(triple_n)), table


def _deal(held: _Combiner, ranges: Ranges, contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, bits: np.uint64) -> None:
    """Add ascending rows (context, word) to the ranges that they belong to, as keys relative to these."""
    for b, lo, hi in ranges.touched(contexts, words):
        held.add(b, ((contexts[lo:hi] - ranges.contexts[b]).astype(np.uint64) << bits) | words[lo:hi].astype(np.uint64), counts[lo:hi])


def _split_sums(ranges: Ranges, own: dict[int, np.ndarray]) -> dict[int, tuple[int, int, int, int]]:
    """Of each split context: how often a word follows, and how many do once, twice and more often, over all its ranges.

    ``own`` has what each range found of its first context.
    """
    split, found = set(ranges.split.tolist()), {}
    for b, part in own.items():
        c = int(ranges.contexts[b])
        if c in split:
            found[c] = found.get(c, 0) + part.astype(np.int64)
    return {c: tuple(int(x) for x in v) for c, v in found.items()}


_views: dict[str, _Mapped] = {}


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity, one row per row of ``docs``.

    A null or empty text is its end alone; repeated rows are scored each. Scores are sums of log10 probabilities over
    whole texts. A model learnt from nothing gives every token probability 1. An empty table gives no rows.
    """
    return score_numbered(numbered(docs, model.folder, model.word_sizes, id_col, text_col), model)


def score_numbered(table: DataFrame, model: Model) -> DataFrame:
    """:func:`score` of texts that :func:`train_numbered` has numbered."""
    kind = id_type(table, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.folder not in _views:
            _views.clear()
            _views[model.folder] = _Mapped(model)
        view = _views[model.folder]
        floor = math.log10(model.train_tokens + model.words + 1)
        for batch in _together(batches, 2, np.dtype(_kind(model.words)).itemsize):
            numbers, sizes = _read(batch.column(2), model.words)
            # unknown words make different pairs alike, which is right: only their context and their being unknown matter
            context, word, _, back = unique_rows(_contexts(numbers, sizes, model.words), numbers)
            place = view.pairs.find(context, word)
            likely = view.bigram(context, word, place)
            likely = view.trigram(place, likely, back, sizes, numbers) if model.order == 3 else likely[back]
            logs = np.log10(likely)
            # a token's count from its pair's word
            distinct, at = np.unique(word, return_inverse=True)
            base = (np.log10(view.vocabulary.count(distinct) + 1.0) - floor)[at][back]
            starts = np.cumsum(sizes) - sizes
            total = np.add.reduceat(logs, starts) if len(starts) else np.zeros(0)
            columns = [sizes, np.add.reduceat((numbers >= 0).astype(np.int64), starts) if len(starts) else sizes,
                       np.full(len(sizes), model.train_tokens), np.add.reduceat(base, starts) if len(starts) else np.zeros(0),
                       total, 10 ** (-total / np.maximum(sizes, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, columns)], names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    return table.select("doc_id", "held_out", "tokens").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double, perplexity double")
