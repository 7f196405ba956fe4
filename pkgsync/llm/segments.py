"""Segments of a text that tokenizers encode independently.

Before a single space between two characters that aren't white space, the usual split patterns of byte-level BPE always
start a new match, and a sentencepiece model whose pieces hold the space mark in front only never merges across it.  So a
text falls apart there, and its ids are those of its segments, each (but the first) with the space before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Python's white space covers Unicode's, so what it takes for a boundary is one for every regex library.
BOUNDARY = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str, step: int = 1_000_000) -> Iterator[list[str]]:
    """The segments in order, without the spaces between them, in lists of about ``step`` characters.

    A stretch without a boundary stays whole; an empty text is one empty segment.
    """
    at = 0
    while len(text) - at > step:
        cut = BOUNDARY.search(text, at + step)
        if not cut:
            break
        yield BOUNDARY.split(text[at:cut.start()])
        at = cut.end()
    yield BOUNDARY.split(text[at:])
