"""Cutting long texts where a byte-level tokenizer cuts them anyway."""

from __future__ import annotations

from collections.abc import Iterator

import regex

#: A word ends before a blank that starts the next word, and before a digit. No token
#: crosses these places, what follows cannot change what is before them, and the usual
#: names of special tokens have neither inside.
_SAFE = regex.compile(r"\p{L}(?= \p{L}|\p{N})")


def safe_pieces(text: str, size: int) -> Iterator[str]:
    """Parts of ``text`` of at least ``size`` characters (the last may be shorter).

    A part ends at the first safe boundary from ``size`` on; a text without any stays
    whole. The parts' token ids, joined, are those of the whole text.
    """
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size - 1)
        if not found or found.end() == len(text):
            break
        yield text[start:found.end()]
        start = found.end()
    yield text[start:] if start else text
