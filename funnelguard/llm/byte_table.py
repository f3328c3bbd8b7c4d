"""The characters that stand for bytes in a byte-level vocabulary."""

from __future__ import annotations


def byte_characters() -> list[str]:
    """The character of each of the 256 bytes."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    chars, spare = [], 0x100
    for b in range(256):
        if b in prints:
            chars.append(chr(b))
        else:
            chars.append(chr(spare))
            spare += 1
    return chars
