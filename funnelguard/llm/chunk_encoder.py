"""Token ids of whole texts by the tokenizers library, with each distinct chunk of text encoded once.

The pre-tokenisation pattern never joins characters across a single space
that follows a non-space, so a text may be cut before every such space and its ids are the
ids of the chunks in order. Words repeat, so most chunks come from a bounded
cache of the worker; the others go to the library in one batch.
"""

from __future__ import annotations

from array import array

import numpy as np
from tokenizers import Tokenizer

from .byte_table import byte_characters

#: Chunks and characters of a cache generation of a worker, of which there are two.
CACHE_CHUNKS, CACHE_CHARS = 500_000, 7_500_000
#: Words up to this many characters go to the model one by one, also with one of these marks behind.
WORD_CHARS, MARKS = 100, frozenset(".,;:!?|)")
#: Characters handed to the library at once.
BATCH_CHARS = 200_000


def ends_in_space(part: str) -> bool:
    return not part or part[-1].isspace()


def cut(text: str) -> list[str]:
    """The chunks of a text; all but the first have lost one leading space."""
    pieces = text.split(" ")
    chunks, held = [], None
    for i, piece in enumerate(pieces):
        held = piece if held is None else f"{held} {piece}"
        # an empty first piece stands before a leading space, which nothing precedes
        if not ends_in_space(piece) or (i == 0 and not piece) or i == len(pieces) - 1:
            chunks.append(held)
            held = None
    return chunks


def _loose_end(chunks: list[str]) -> str | None:
    """Take off the last chunk if it ends in white space, unless it is the only one."""
    return chunks.pop() if len(chunks) > 1 and ends_in_space(chunks[-1]) else None


class ChunkEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        vocab = tokenizer.get_vocab(with_added_tokens=False)
        # a token of a byte-level vocabulary has a character for each byte
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)
        # a text that holds the string of an added token goes to the library whole, which gives it that token's id
        self.added = [] if tokenizer.encode_special_tokens else [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.model = tokenizer.model
        self.letters = {b: ord(c) for b, c in enumerate(byte_characters())}
        self.space = chr(self.letters[0x20])
        self.marks: dict[str, bytes] = {}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in done]

    def _joined(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk with its leading space: the chunks go to the library as one text, whose ids are then parted."""
        spaced = [f" {c}" for c in chunks]
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(spaced)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.cumsum(np.fromiter((len(c.encode()) for c in spaced), np.int64, len(spaced)))
        cuts = (4 * (np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1)).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def _word(self, word: str) -> bytes:
        """The ids of letters after one space, which are one match of the pre-tokenisation: the model alone is asked."""
        # ASCII letters stand for themselves
        name = self.space + (word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))
        return array("I", [t.id for t in self.model.tokenize(name)]).tobytes()

    def _mark(self, mark: str) -> bytes:
        if mark not in self.marks:
            self.marks[mark] = self._whole([mark])[0]
        return self.marks[mark]

    def _learn(self, chunks: set[str]) -> None:
        batch, chars, recent, older = [], 0, self.recent, self.older
        for chunk in chunks:
            # what str.isalpha() takes for letters are letters to the library too, which knows some more, so that what follows
            # them is the next match
            if len(chunk) < WORD_CHARS and chunk[:-1].isalpha():
                if chunk[-1].isalpha():
                    recent[chunk] = self._word(chunk)
                    continue
                if chunk[-1] in MARKS:
                    word = chunk[:-1]
                    ids = recent.get(word) or older.get(word) or self._word(word)
                    recent[word] = ids
                    recent[chunk] = ids + self._mark(chunk[-1])
                    continue
            batch.append(chunk)
            chars += len(chunk) + 1
            if chars >= BATCH_CHARS:
                recent.update(zip(batch, self._joined(batch), strict=True))
                batch, chars = [], 0
        if batch:
            recent.update(zip(batch, self._joined(batch), strict=True))
        self.chars += sum(map(len, chunks))

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not whole:
            return self._encode(texts)
        alone = dict(zip(whole, self._whole([texts[i] for i in whole]), strict=True))
        rest = iter(self._encode([t for i, t in enumerate(texts) if i not in alone]))
        return [alone[i] if i in alone else next(rest) for i in range(len(texts))]

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.recent) > CACHE_CHUNKS or self.chars > CACHE_CHARS:
            self.older, self.recent, self.chars = self.recent, {}, 0
        recent = self.recent
        docs = [t.split(" ") for t in texts]
        ends = [_loose_end(d) for d in docs]
        new = set().union(*(d[1:] for d in docs)) - recent.keys()
        loose = {p for p in new if ends_in_space(p)}  # never cached, so always new
        for i, d in enumerate(docs):
            if (loose and not loose.isdisjoint(d[1:])) or (len(d) > 1 and d[0] and d[0][-1].isspace()):
                docs[i] = cut(texts[i])
                ends[i] = _loose_end(docs[i])
                new.update(c for c in docs[i][1:] if c not in recent)
        new -= loose
        # a text's first chunk has no leading space, and its last one may end in white space
        outer = list({d[0] for d in docs} | {f" {e}" for e in ends if e is not None})
        outer = dict(zip(outer, self._whole(outer), strict=True))
        for chunk in new & self.older.keys():
            recent[chunk] = self.older[chunk]
        self._learn(new - recent.keys())
        return [outer[d[0]] + b"".join(map(recent.__getitem__, d[1:])) + (outer[f" {e}"] if e is not None else b"")
                for d, e in zip(docs, ends, strict=True)]
