"""Windows of long texts that end where every tokenizer of this package ends a token.

A cut stands before a space that follows a character that is no white space. A text without
such a place within a window's length goes on to the next one, and at worst stays whole.
"""

from __future__ import annotations

from collections.abc import Iterator

from ledgerloom.llm.common import BLOCK_CHARS
from ledgerloom.llm.pretokens import SPACE, class_table


def cut_at_or_after(text: str, at: int) -> int:
    """The first place from `at` on where a window may end, or the text's end."""
    classes = class_table()
    at = text.find(" ", at)
    while at > 0 and classes[ord(text[at - 1])] == SPACE:
        at = text.find(" ", at + 1)
    return at if at > 0 else len(text)


def windows(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    start = 0
    while len(text) - start > size:
        stop = cut_at_or_after(text, start + size)
        yield text[start:stop]
        start = stop
    if start < len(text):
        yield text[start:]
