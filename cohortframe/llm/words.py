"""Words of whole texts in parts of bounded size, as byte strings."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of a text split at once; a text longer than that comes in several parts.
PART = 1 << 20


def table(separators: bytes, keep_upper: bool = False, mark: bytes = b"", marker: bytes = b"\n") -> bytes:
    """A translation of single bytes: A-Z in lower case, ``separators`` to a space, the bytes of ``mark`` to ``marker``."""
    out = bytearray(range(256) if keep_upper else bytes(range(256)).lower())
    for c in separators:
        out[c] = 0x20
    for c in mark:
        out[c] = marker[0]
    return bytes(out)


#: Words stand between ASCII white space.
SPACED = table(bytes([0x20, *range(0x09, 0x0E)]))
#: Words are runs of digits, letters and all that is not ASCII.
ALNUM = table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def parts(text: bytes, how: bytes, size: int | None = None) -> Iterator[list[bytes]]:
    """Lists of words of ``text`` after the translation ``how``; cut between words, nothing left out."""
    size = size or PART
    text = text.translate(how)
    if len(text) <= size:
        yield text.split()
        return
    at = 0
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end
