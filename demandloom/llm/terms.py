"""Terms of texts: maximal runs of letters (and digits, on demand) and of everything outside ASCII, A-Z in lower case."""

from __future__ import annotations

from collections import Counter

#: Bytes of a text whose terms are made into objects at a time.
PART = 1 << 22


def byte_table(digits: bool) -> bytes:
    """What each byte of a UTF-8 text becomes: itself, its lower case, or a space where no term goes on.

    Bytes from 128 on only occur in characters outside ASCII, so a table over bytes tells characters apart.
    """
    kept = lambda b: b >= 128 or chr(b).isalpha() or (digits and chr(b).isdigit())
    return bytes(ord(chr(b).lower()) if b < 128 and kept(b) else b if kept(b) else 32 for b in range(256))


def term_counts(raw: bytes, table: bytes) -> Counter[bytes]:
    """Occurrences of the terms of a UTF-8 text; a very long one is counted in parts that end between terms."""
    if len(raw) <= PART:
        return Counter(raw.translate(table).split())
    spaced, found, at = raw.translate(table), Counter(), 0
    while at < len(spaced):
        to = spaced.find(b" ", at + PART)
        found.update(spaced[at : to if to >= 0 else len(spaced)].split())
        at = to if to >= 0 else len(spaced)
    return found
