"""Sorted integer arrays as small blobs, merged by hash range in tasks, and kept in memory-mapped files."""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections import OrderedDict
from urllib.parse import unquote, urlparse

import numpy as np


def shared_folder(path: str) -> str:
    """The plain path of a folder that driver and executors all have mounted."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"a memory-mapped model needs a mounted shared folder, not {path}")
    return unquote(url.path) if url.scheme else path


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending unsigned keys with counts: gaps and counts by byte planes, of which the high ones are nearly all zero."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    planes = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    few = np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zlib.compress(planes.tobytes() + few.tobytes(), 1)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(blob), np.uint8)
    n = len(raw) // 12
    gaps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    counts = np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.uint64), counts.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order with the sums of their counts."""
    if not len(keys):
        return keys.astype(np.uint64), counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts[order], starts)


def merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(b) for b in blobs]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Write ``values`` whole or not at all: a task that runs again replaces the file by an equal one."""
    os.makedirs(folder, exist_ok=True)
    at = f"{folder}/{name}.{uuid.uuid4().hex}.part"
    with open(at, "wb") as f:
        np.save(f, values)
    os.replace(at, f"{folder}/{name}.npy")


def mapped(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def save_together(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write several arrays as one file, whole or not at all, so that a reader needs one handle for them."""
    os.makedirs(folder, exist_ok=True)
    head, at = {}, 0
    for key, values in arrays.items():
        head[key] = (values.dtype.str, list(values.shape), at)
        at += -(-values.nbytes // 64) * 64
    text = json.dumps(head).encode()
    start = -(-(8 + len(text)) // 64) * 64
    part = f"{folder}/{name}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        f.write(len(text).to_bytes(8, "little") + text + bytes(start - 8 - len(text)))
        for key, values in arrays.items():
            f.seek(start + head[key][2])
            f.write(np.ascontiguousarray(values).data)
        f.truncate(start + at)
    os.replace(part, f"{folder}/{name}.arrays")


def halved(keys: np.ndarray) -> dict[str, np.ndarray]:
    """Ascending 64-bit keys as their low 32 bits, and where each value of the high ones begins."""
    high = (keys >> np.uint64(32)).astype(np.int64)
    return {"low": keys.astype(np.uint32), "starts": np.searchsorted(high, np.arange(int(high[-1]) + 2)).astype(np.uint32 if len(keys) < 1 << 32 else np.int64)}


def whole(file: dict[str, np.ndarray], places: np.ndarray | None = None) -> np.ndarray:
    """The 64-bit keys of :func:`halved` at ``places``, or all of them."""
    if places is None:
        high = np.repeat(np.arange(len(file["starts"]) - 1), np.diff(file["starts"].astype(np.int64)))
        return (high.astype(np.uint64) << np.uint64(32)) | file["low"]
    high = np.searchsorted(file["starts"], places, "right") - 1
    return (high.astype(np.uint64) << np.uint64(32)) | file["low"][places]


def least_from(file: dict[str, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first key of :func:`halved` that is not below each of the ascending ``wanted``, and whether its high bits are theirs.

    Where all keys are below, the last place.
    """
    high, starts, low = (wanted >> np.uint64(32)).astype(np.int64), file["starts"], file["low"]
    small = wanted.astype(np.uint32)
    first = np.flatnonzero(np.r_[True, high[1:] != high[:-1]]) if len(high) else np.zeros(0, np.int64)
    kinds = np.minimum(high[first], len(starts) - 2)
    begin, end = starts[kinds].astype(np.int64), starts[kinds + 1].astype(np.int64)
    past = high[first] > len(starts) - 2
    at = np.empty(len(wanted), np.int64)
    for lo, hi, a, b, none in zip(first.tolist(), [*first[1:].tolist(), len(high)], begin.tolist(), end.tolist(), past.tolist(), strict=True):
        if none:
            at[lo:hi] = len(low)
        else:
            at[lo:hi] = low[a:b].searchsorted(small[lo:hi])
            at[lo:hi] += a
    inside = at < np.repeat(np.where(past, 0, end), np.diff(np.append(first, len(high))))
    return np.minimum(at, len(low) - 1), inside


def places_of(file: dict[str, np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Place of each of the ascending ``wanted`` among the keys of :func:`halved`, -1 if absent."""
    at, inside = least_from(file, wanted)
    return np.where(inside & (file["low"][at] == wanted.astype(np.uint32)), at, -1)


class Shelf:
    """Files of :func:`save_together`, mapped when first asked for; at most ``limit`` of them are held open."""

    def __init__(self, folder: str, limit: int = 96):
        self.folder, self.limit = folder, limit
        self.held: OrderedDict[str, dict[str, np.ndarray]] = OrderedDict()

    def __getitem__(self, name: str) -> dict[str, np.ndarray]:
        if name in self.held:
            self.held.move_to_end(name)
            return self.held[name]
        while len(self.held) >= self.limit:
            self.held.popitem(last=False)  # a map goes when nothing refers to it any more
        raw = np.memmap(f"{self.folder}/{name}.arrays", np.uint8, "r")
        size = int(raw[:8].view("<u8")[0])
        start, found = -(-(8 + size) // 64) * 64, {}
        for key, (kind, shape, at) in json.loads(bytes(raw[8:8 + size])).items():
            dtype, count = np.dtype(kind), int(np.prod(shape))
            found[key] = raw[start + at:start + at + dtype.itemsize * count].view(dtype).reshape(shape)
        self.held[name] = found
        return found
