"""Suffix-array dedup of long repeated byte strings by prefix-free parsing (operator 10).

Parsing. A rolling hash runs over each text; in every string of ``length``
bytes the least hash, the rightmost of equal ones, is a trigger. Equal strings
have equal triggers at equal places, so whatever repeats anywhere can be found
from its triggers alone. A trigger's phrase is all that strings over it can
reach, ``length`` - ``GRAM`` bytes before it and ``length`` bytes from it.

Parse. Phrases are compared by hash in shards of equal triggers. The first
occurrence of a phrase in corpus order (doc_id, then start) is its dictionary
entry; later ones repeat it whole, and are settled by that alone, as most of a
highly repetitive corpus is.

Dictionary. Only first occurrences that share a trigger with another phrase
are left. Their bytes are fetched, and the suffixes of a shard's phrases are
ranked by prefix doubling to ``length`` bytes; of suffixes of equal rank all
but the first in corpus order are repeats. This is exact, byte by byte.

Very frequent triggers, which no single task could hold, are looked for in a
sample first. Their strings are compared one by one by 128 bits of hash,
dealt by that hash, instead of with their trigger's phrases. Which of both
ways a trigger takes does not change the result.

What is found comes back to the texts through sorted arrays in the shared
folder, which tasks map into memory: texts are never shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .work import id_and_text, parts, stored, workspace

LENGTH, GRAM = 100, 32
#: Bytes of texts parsed together, window starts handled at once, bytes of text for each shard, phrases ranked in one shard.
GROUP_BYTES, SEGMENT, BYTES_PER_SHARD, PHRASES_PER_SHARD = 4 << 20, 1 << 20, 16_000_000, 8_000
#: What a row of the parse holds.
PHRASES, REPEATS, ENTRIES, STRINGS = 0, 1, 2, 3
#: One of so many documents is searched for triggers that hold more than 1 / FREQUENT of all phrases, and LEAST in the sample.
SAMPLE, FREQUENT, LEAST = 16, 4096, 64
#: Strings hashed at once.
HASH_ROWS = 1 << 13
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
NO_ID = -(1 << 63)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2 ** 64."""
    def of(x: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        np.cumprod(np.full(n - 1, x, np.uint64), out=out[1:])
        return out

    return of(int(BASE)), of(pow(int(BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def triggers(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of triggers in texts laid end to end, ascending, with the hashes of their grams and of their phrases.

    ``ends`` has the end of each text in ``data``; no string reaches over one.
    """
    n, window = len(data), length - gram + 1
    reach = length - gram
    up, down = _powers(SEGMENT + 2 * length + reach + 1)
    starts = np.concatenate(([0], ends[:-1]))
    found, last = [], -1
    for s0 in range(0, n, SEGMENT):
        lo, hi = max(0, s0 - reach), min(n, s0 + SEGMENT + 2 * length)
        if hi - s0 < length:
            break
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=sums[1:])
        at = s0 - lo
        grams = _mixed((sums[at + gram:] - sums[at: len(sums) - gram]) * down[at: len(sums) - gram])
        # the least hash of a window and, of equal ones, the rightmost place
        low = (grams & ~np.uint64(0xFFFFFF)) | (np.uint64(0xFFFFFF) - np.arange(len(grams), dtype=np.uint64))
        width = 1
        while 2 * width <= window:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < window:
            low = np.minimum(low[: len(low) - (window - width)], low[window - width:])
        low = low[:SEGMENT]
        start = s0 + np.arange(len(low))
        text = np.searchsorted(ends, start, side="right")
        place = (np.uint64(0xFFFFFF) - (low & np.uint64(0xFFFFFF))).astype(np.int64)[start + length <= ends[text]] + s0
        place = place[np.r_[True, place[1:] != place[:-1]]] if len(place) else place
        place = place[place > last]  # the last trigger may lead in the next segment too
        if not len(place):
            continue
        last = place[-1]
        text = np.searchsorted(ends, place, side="right")
        a, b = np.maximum(place - reach, starts[text]), np.minimum(place + length, ends[text])
        phrase = (sums[b - lo] - sums[a - lo]) * down[a - lo] + ((place - a) * 256 + (b - place)).astype(np.uint64) * BASE
        found.append((place, grams[place - s0], _mixed(phrase)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# -- rows of numbers as blobs ------------------------------------------------------------------

#: One trigger: hash of its gram and phrase, document and version, place, and bytes from it to the end of its phrase.
TRIGGER = np.dtype([("h", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("ver", "<u4"), ("pos", "<u4"), ("right", "u1")])
#: One repeat: bytes from start to end of a document go.
REPEAT = np.dtype([("doc", "<i8"), ("ver", "<u4"), ("start", "<u4"), ("end", "<u4")])
#: One string of a frequent trigger: its hash and where it starts.
STRING = np.dtype([("w1", "<u8"), ("w2", "<u8"), ("doc", "<i8"), ("ver", "<u4"), ("start", "<u4")])


def _blob(rows: np.ndarray) -> bytes:
    """Columns one after the other, each by byte planes."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(rows[f]).view(np.uint8).reshape(len(rows), -1).T).tobytes()
              for f in rows.dtype.names]
    return zlib.compress(b"".join(planes), 1)


def _rows(blob: bytes, kind: np.dtype) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(blob), np.uint8)
    out = np.empty(len(raw) // kind.itemsize, kind)
    at = 0
    for f in kind.names:
        size = kind[f].itemsize
        plane = raw[at: at + size * len(out)].reshape(size, len(out))
        out[f] = np.ascontiguousarray(plane.T).view(kind[f]).ravel()
        at += size * len(out)
    return out


def _dealt(kind: int, rows: np.ndarray, shard: np.ndarray) -> Iterator[dict]:
    """A row (kind, shard, n, blob) for each shard."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(rows) else np.zeros(1, np.int64)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        yield {"kind": kind, "shard": int(shard[order[lo]]), "n": int(hi - lo), "blob": _blob(rows[order[lo:hi]])}


DEALT = "kind int, shard int, n long, blob binary"
DEALT_ARROW = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("blob", pa.binary())])


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_pylist([row], schema=DEALT_ARROW)


def _doc_shard(doc: np.ndarray, shards: int) -> np.ndarray:
    return (_mixed(doc.astype(np.int64).view(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _gathered(rows: DataFrame, tasks: int, finish) -> DataFrame:
    """``finish(kind, shard, blobs)``, which yields rows of ``DEALT``, for all blobs of each kind and shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for kind, shard, blob in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (kind, shard) != now:
                    if held:
                        yield from _batches(finish(*now, held))
                    now, held = (kind, shard), []
                held.append(blob)
        if held:
            yield from _batches(finish(*now, held))

    return rows.repartition(tasks, "kind", "shard").sortWithinPartitions("kind", "shard").mapInArrow(run, DEALT)


# -- parsing and the parse ---------------------------------------------------------------------

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (long; a null id is the least), ver (32 bits of the text's hash) and text."""
    return id_and_text(docs, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("ver"), F.col("text").cast("binary").alias("text"))


def _in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Documents, versions and texts of about ``GROUP_BYTES`` at a time."""
    doc, ver, text, size = [], [], [], 0
    for batch in batches:
        for d, v, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            doc.append(d)
            ver.append(v)
            text.append(t)
            size += len(t)
            if size >= GROUP_BYTES:
                yield np.array(doc, np.int64), np.array(ver, np.int64), text
                doc, ver, text, size = [], [], [], 0
    if text:
        yield np.array(doc, np.int64), np.array(ver, np.int64), text


def _first_of_phrase(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of trigger, phrase and corpus, and for each the place of its phrase's first row."""
    rows = rows[np.lexsort((rows["pos"], rows["ver"], rows["doc"], rows["c"], rows["h"]))]
    new = np.r_[True, (rows["h"][1:] != rows["h"][:-1]) | (rows["c"][1:] != rows["c"][:-1])] if len(rows) else np.zeros(0, bool)
    return rows, np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0)) if len(rows) else np.zeros(0, np.int64)


def _same_place(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a["doc"] == b["doc"]) & (a["ver"] == b["ver"]) & (a["pos"] == b["pos"])


def _whole_phrases(rows: np.ndarray, reach: int) -> np.ndarray:
    out = np.empty(len(rows), REPEAT)
    out["doc"], out["ver"] = rows["doc"], rows["ver"]
    out["start"] = rows["pos"] - np.minimum(rows["pos"], reach)
    out["end"] = rows["pos"] + rows["right"]
    return out


def _settled(rows: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each phrase (other rows at the same place left out), and the repeats that the others are."""
    rows, first = _first_of_phrase(rows)
    other = ~_same_place(rows, rows[first])
    return rows[first == np.arange(len(rows))], _whole_phrases(rows[other], reach)


def _group_rows(doc: np.ndarray, ver: np.ndarray, text: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The bytes of a group of texts, their ends, and its triggers with their places among the bytes."""
    sizes = np.array([len(t) for t in text], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(text), np.uint8)
    place, h, c = triggers(data, ends, length, gram)
    which = np.searchsorted(ends, place, side="right")
    rows = np.empty(len(place), TRIGGER)
    rows["h"], rows["c"], rows["doc"], rows["ver"] = h, c, doc[which], ver[which]
    rows["pos"], rows["right"] = place - (ends - sizes)[which], np.minimum(ends[which] - place, length)
    return data, ends, rows, place


def frequent_triggers(texts: DataFrame, size: int, length: int, gram: int, sample: int = SAMPLE, least: int = LEAST) -> np.ndarray:
    """Ascending hashes of the triggers that stand in very many different phrases: FREQUENT of them at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ver, text in _in_groups(batches):
            rows = _group_rows(doc, ver, text, length, gram)[2]
            found, n = np.unique(np.unique(rows[["h", "c"]])["h"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], ["h", "n"])

    phrases = 2 * size // sample // (length - gram + 2)
    some = texts.filter(F.pmod(F.xxhash64("doc", "ver"), F.lit(sample)) == 0).mapInArrow(run, "h long, n long")
    # the counts add up to no more than the sample's phrases, so FREQUENT rows at most come back
    rows = some.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(least, phrases // FREQUENT)).collect()
    return np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))


def _string_hashes(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the ``length`` bytes from each place."""
    factors = np.random.default_rng(length).integers(0, 1 << 64, (2, length), dtype=np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    out = np.empty((2, len(at)), np.uint64)
    for lo in range(0, len(at), HASH_ROWS):
        some = view[at[lo: lo + HASH_ROWS]].astype(np.uint64) + np.uint64(1)
        for k in (0, 1):
            out[k, lo: lo + HASH_ROWS] = _mixed((some * factors[k]).sum(axis=1, dtype=np.uint64))
    return out[0], out[1]


def _strings_of(data: np.ndarray, ends: np.ndarray, doc: np.ndarray, ver: np.ndarray, place: np.ndarray, length: int,
                reach: int) -> np.ndarray:
    """All strings over the triggers at these places of a group, each once."""
    starts = np.concatenate(([0], ends[:-1]))
    which = np.searchsorted(ends, place, side="right")
    # a running count over the group marks the starts that any trigger reaches
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, np.maximum(place - reach, starts[which]), 1)
    np.add.at(edge, np.minimum(place, ends[which] - length) + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    which = np.searchsorted(ends, at, side="right")
    out = np.empty(len(at), STRING)
    out["w1"], out["w2"] = _string_hashes(data, at, length)
    out["doc"], out["ver"], out["start"] = doc[which], ver[which], at - starts[which]
    return out


def _settled_strings(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first of each string in corpus order, and the repeats that the others are."""
    rows = rows[np.lexsort((rows["start"], rows["ver"], rows["doc"], rows["w2"], rows["w1"]))]
    new = np.r_[True, (rows["w1"][1:] != rows["w1"][:-1]) | (rows["w2"][1:] != rows["w2"][:-1])] if len(rows) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0)) if len(rows) else np.zeros(0, np.int64)
    other = rows[(rows["doc"] != rows["doc"][first]) | (rows["ver"] != rows["ver"][first]) | (rows["start"] != rows["start"][first])]
    out = np.empty(len(other), REPEAT)
    out["doc"], out["ver"], out["start"], out["end"] = other["doc"], other["ver"], other["start"], other["start"] + length
    return rows[new], _joined_ranges(out)


def _parse(texts: DataFrame, shards: int, length: int, gram: int, frequent: np.ndarray) -> DataFrame:
    """Rows (kind, shard, n, blob): phrases by shards of triggers, strings of frequent ones, and repeats within a group of texts."""
    reach = length - gram
    frequent = texts.sparkSession.sparkContext.broadcast(frequent)  # FREQUENT hashes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ver, text in _in_groups(batches):
            data, ends, rows, place = _group_rows(doc, ver, text, length, gram)
            often = np.isin(rows["h"], frequent.value)
            first, repeats = _settled(rows[~often], reach)
            yield from _batches(_dealt(PHRASES, first, (first["h"] % np.uint64(shards)).astype(np.int64)))
            yield from _batches(_dealt(REPEATS, repeats, _doc_shard(repeats["doc"], shards)))
            if often.any():
                first, repeats = _settled_strings(_strings_of(data, ends, doc, ver, place[often], length, reach), length)
                yield from _batches(_dealt(STRINGS, first, (first["w1"] % np.uint64(shards)).astype(np.int64)))
                yield from _batches(_dealt(REPEATS, repeats, _doc_shard(repeats["doc"], shards)))

    return texts.mapInArrow(run, DEALT)


def _joined_ranges(rows: np.ndarray) -> np.ndarray:
    """Ranges by document, those that touch made one."""
    rows = rows[np.lexsort((rows["start"], rows["ver"], rows["doc"]))]
    if not len(rows):
        return rows
    same = np.r_[False, (rows["doc"][1:] == rows["doc"][:-1]) & (rows["ver"][1:] == rows["ver"][:-1])]
    # ends run on within a document: documents are set apart so that one running maximum serves all
    block = np.cumsum(~same).astype(np.int64) << 33
    far = np.maximum.accumulate(block + rows["end"])
    new = ~same | np.r_[True, (block + rows["start"])[1:] > far[:-1]]
    at = np.flatnonzero(new)
    out = rows[at].copy()
    out["end"] = (far - block)[np.r_[at[1:], len(rows)] - 1]
    return out


def _keep_or_settle(shards: int, length: int, reach: int):
    """Phrases of all texts: repeats and the entries of the dictionary that share a trigger; repeats are joined."""
    def finish(kind: int, shard: int, blobs: list[bytes]) -> Iterator[dict]:
        if kind == REPEATS:
            yield from _dealt(REPEATS, found := _joined_ranges(np.concatenate([_rows(b, REPEAT) for b in blobs])), np.full(len(found), shard))
            return
        if kind == STRINGS:
            repeats = _settled_strings(np.concatenate([_rows(b, STRING) for b in blobs]), length)[1]
            yield from _dealt(REPEATS, repeats, _doc_shard(repeats["doc"], shards))
            return
        first, repeats = _settled(np.concatenate([_rows(b, TRIGGER) for b in blobs]), reach)
        yield from _dealt(REPEATS, repeats, _doc_shard(repeats["doc"], shards))
        same = first["h"][1:] == first["h"][:-1]
        shared = first[np.r_[False, same] | np.r_[same, False]] if len(first) else first
        yield from _dealt(ENTRIES, shared, _doc_shard(shared["doc"], shards))

    return finish


# -- the dictionary ----------------------------------------------------------------------------

def _indexed(rows: DataFrame, tasks: int, folder: str, name: str, kind: np.dtype, finish=lambda rows: rows) -> set[int]:
    """Write each shard's rows, by document, as an array in ``folder``; the shards that have any."""
    def save(_: int, shard: int, blobs: list[bytes]) -> Iterator[dict]:
        found = finish(np.concatenate([_rows(b, kind) for b in blobs]))
        found = found[np.lexsort((found["ver"], found["doc"]))]
        packed.save(folder, f"{name}-{shard}", found)
        packed.save(folder, f"{name}-docs-{shard}", found["doc"].copy())
        yield {"kind": 0, "shard": shard, "n": len(found), "blob": b""}

    return {r.shard for r in _gathered(rows, tasks, save).select("shard").collect()}  # a row for each shard


class _Index:
    """Rows of a document in the arrays that :func:`_indexed` wrote."""

    def __init__(self, folder: str, name: str, shards: int, filled: set[int]):
        self.shards, self.files = shards, {}
        self.folder, self.name, self.filled = folder, name, filled

    def of(self, doc: np.ndarray, ver: np.ndarray) -> Iterator[np.ndarray | None]:
        for d, v, shard in zip(doc.tolist(), ver.tolist(), _doc_shard(doc, self.shards).tolist(), strict=True):
            if shard not in self.filled:
                yield None
                continue
            if shard not in self.files:
                self.files[shard] = tuple(packed.mapped(self.folder, f"{self.name}{of}-{shard}") for of in ("", "-docs"))
            rows, docs = self.files[shard]
            lo, hi = np.searchsorted(docs, d), np.searchsorted(docs, d, side="right")
            own = rows[lo:hi]
            yield own[own["ver"] == v] if hi > lo else None


def _phrases_of_entries(texts: DataFrame, index: tuple, ranked: int, length: int, reach: int) -> DataFrame:
    """Rows (kind, shard, n, blob) of entries with the bytes of their phrases, by shards of triggers."""
    entry = np.dtype([*TRIGGER.descr, ("phrase", f"V{reach + length}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Index(*index)
        for doc, ver, text in _in_groups(batches):
            found = []
            for own, raw in zip(entries.of(doc, ver), text, strict=True):
                if own is None or not len(own):
                    continue
                # the trigger stands at column `reach`; what lies outside the text stays zero
                data = np.zeros(len(raw) + 2 * length + reach, np.uint8)
                data[reach: reach + len(raw)] = np.frombuffer(raw, np.uint8)
                view = np.lib.stride_tricks.sliding_window_view(data, reach + length)
                rows = np.empty(len(own), entry)
                for f in TRIGGER.names:
                    rows[f] = own[f]
                rows["phrase"] = np.ascontiguousarray(view[own["pos"]]).view(entry["phrase"]).ravel()
                found.append(rows)
            if found:
                rows = np.concatenate(found)
                yield from _batches(_dealt(ENTRIES, rows, (_mixed(rows["h"]) % np.uint64(ranked)).astype(np.int64)))

    return texts.mapInArrow(run, DEALT)


def _numbered(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    order = np.argsort(keys.ravel(), kind="stable")
    ordered = keys.ravel()[order]
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
    return rank.reshape(keys.shape)


def suffix_ranks(phrases: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the first ``length`` bytes of each suffix that has as many, by prefix doubling; rows are phrases.

    Ranks are in the order of the bytes, and equal for equal bytes only.
    """
    width = 8
    view = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(phrases, width, axis=1))
    ranks = _numbered(view.view(">u8")[..., 0].astype(np.uint64))
    while width < length:
        step = min(width, length - width)  # the last step overlaps
        ranks = _numbered((ranks[:, : ranks.shape[1] - step] << np.uint64(32)) | ranks[:, step:])
        width += step
    return ranks


def _windows(rows: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the rows' phrases, and the offsets at which a string of ``length`` bytes lies within the text."""
    phrases = np.ascontiguousarray(rows["phrase"]).view(np.uint8).reshape(len(rows), reach + length)
    offset = np.arange(reach + 1)
    inside = (offset >= reach - np.minimum(rows["pos"], reach)[:, None].astype(np.int64)) & (
        offset + length <= reach + rows["right"][:, None].astype(np.int64))
    return phrases, inside, rows["pos"].astype(np.int64) - reach


def _not_first(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where a rank stands that has a lesser place elsewhere."""
    order = np.lexsort((place, rank))
    new = np.r_[True, np.diff(rank[order]) != 0] if len(order) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[place[order] != place[order][first]]


def _repeats_of(rows: np.ndarray, length: int, reach: int, most: int) -> np.ndarray:
    """The repeats among the suffixes of these phrases, which are in corpus order and share their triggers with no others."""
    text = np.cumsum(np.r_[False, (rows["doc"][1:] != rows["doc"][:-1]) | (rows["ver"][1:] != rows["ver"][:-1])])
    phrases, inside, base = _windows(rows, length, reach)
    if len(rows) <= most:
        row, at = np.nonzero(inside)
        ranks = suffix_ranks(phrases, length)[row, at]
        # a string may lie over several triggers: what counts is where it starts
        repeat = _not_first(ranks, text[row] << 32 | (base[row] + at))
        row, at = row[repeat], at[repeat]
    else:  # one very frequent trigger: offset by offset, which takes a tenth of the memory
        found = []
        for o in range(reach + 1):
            own = np.flatnonzero(inside[:, o])
            strings = np.ascontiguousarray(phrases[own, o: o + length]).view(f"V{length}").ravel()
            ranks = np.unique(strings, return_inverse=True)[1].reshape(-1)
            repeat = own[_not_first(ranks, text[own] << 32 | (base[own] + o))]
            found.append((repeat, np.full(len(repeat), o)))
        row, at = (np.concatenate(x) for x in zip(*found, strict=True))
    out = np.empty(len(row), REPEAT)
    out["doc"], out["ver"] = rows["doc"][row], rows["ver"][row]
    out["start"], out["end"] = base[row] + at, base[row] + at + length
    return _joined_ranges(out)


def _repeated_suffixes(rows: np.ndarray, length: int, reach: int, most: int = PHRASES_PER_SHARD) -> np.ndarray:
    """The repeats among the suffixes of phrases, as ranges of their documents; ``most`` phrases are ranked at once."""
    rows = rows[np.lexsort((rows["pos"], rows["ver"], rows["doc"], rows["h"]))]
    again = np.r_[False, (rows["h"][1:] == rows["h"][:-1]) & _same_place(rows[1:], rows[:-1])]
    rows = rows[~again]  # repeated rows of the table
    starts = np.flatnonzero(np.r_[True, rows["h"][1:] != rows["h"][:-1]])
    ends = np.r_[starts[1:], len(rows)]
    found, lo = [], 0
    for k, end in enumerate(ends):  # all phrases of a trigger are ranked together
        if k + 1 == len(ends) or ends[k + 1] - lo > most:
            some = rows[lo:end]
            found.append(_repeats_of(some[np.lexsort((some["pos"], some["ver"], some["doc"]))], length, reach, most))
            lo = end
    return _joined_ranges(np.concatenate(found))


def find_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                 bytes_per_shard: int = BYTES_PER_SHARD, phrases_per_shard: int = PHRASES_PER_SHARD, sample: int = SAMPLE,
                 least: int = LEAST, folder: str | None = None) -> tuple:
    """Find all strings of ``length`` bytes that also start earlier; arguments of :class:`_Index` for the joined ranges."""
    work = folder or workspace(docs.sparkSession, "suffix-dedup")
    at, reach = packed.shared_folder(work) + "/index", length - gram
    texts = _texts(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = parts(size, bytes_per_shard)
    frequent = frequent_triggers(texts, size, length, gram, sample, least)
    parsed = stored(_gathered(_parse(texts, shards, length, gram, frequent), 3 * shards, _keep_or_settle(shards, length, reach)),
                    f"{work}/parsed")
    entries = parsed.filter(F.col("kind") == ENTRIES)
    index = (at, "entries", shards, _indexed(entries, shards, at, "entries", TRIGGER))
    ranked = parts(entries.agg(F.sum("n")).first()[0] or 0, phrases_per_shard)
    entry = np.dtype([*TRIGGER.descr, ("phrase", f"V{reach + length}")])

    def rank(_: int, shard: int, blobs: list[bytes]) -> Iterator[dict]:
        repeats = _repeated_suffixes(np.concatenate([_rows(b, entry) for b in blobs]), length, reach, phrases_per_shard)
        yield from _dealt(REPEATS, repeats, _doc_shard(repeats["doc"], shards))

    phrases = _phrases_of_entries(texts, index, ranked, length, reach)
    ranges = stored(_gathered(phrases, ranked, rank), f"{work}/ranges")
    repeats = parsed.filter(F.col("kind") == REPEATS).unionByName(ranges)
    return at, "repeats", shards, _indexed(repeats, shards, at, "repeats", REPEAT, _joined_ranges)


def deduplicate_strings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes), one row per row of ``docs``.

    A null text is empty; a text shorter than ``length`` bytes keeps all. Rows that share doc_id and text are one
    document; rows that share a doc_id alone follow by a hash of the text; a null doc_id is the least. An
    empty table gives no rows.
    """
    index = find_repeats(docs, length, id_col=id_col, text_col=text_col, **limits)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = _Index(*index)
        for batch in batches:
            doc, ver = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            out = []
            for own, raw in zip(ranges.of(doc, ver), batch.column(2).to_pylist(), strict=True):
                if own is None or not len(own):
                    out.append((len(raw), 0, 0, raw))
                    continue
                own = np.sort(own, order="start")
                starts, ends = own["start"].tolist(), own["end"].tolist()
                kept = b"".join(raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)], strict=True))
                out.append((len(raw), len(raw) - len(kept), len(own), kept))
            sizes, removed, spans, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = id_and_text(docs, id_col, text_col)
    texts = rows.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("ver"), F.col("text").cast("binary").alias("text"), "doc_id")
    return texts.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(kept: DataFrame) -> DataFrame:
    """``kept`` with kept_sha256 for its bytes."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
