"""Cuts texts where no pre-token of the byte-level pattern can span.

A pre-token never holds white space after visible text, so a cut there is always safe. Only space
and newline are cut at; texts with any other white space are left whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: White space, then the visible run after it.
CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Anything that one of the regex engines in use might take for white space, but space and newline.
OTHER_SPACE = re.compile(
    "[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
)
#: Marks that are a pre-token of their own after a letter; the apostrophe is not.
MARKS = ".,;:!?#$%&*()-\"@^~+=<>|\\/_[]{}`"
#: A word that is one pre-token, by letters on which all Unicode versions agree.
WORD = re.compile("\x20?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: White space behind white space: its pre-tokens depend on what follows the run.
RUNS = ("  ", "\n\n", " \n", "\n ")
#: Characters of a text worked on at a time.
PART = 1 << 20


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of about `size` characters, cut where visible text meets white space."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and not (text[cut] in " \n" and text[cut - 1] not in " \n"):
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text) or not start:
        yield text[start:]


def chunks(text: str) -> list[str]:
    """The text cut before white space that follows visible text; together the chunks are the text.

    Where no white space follows white space every space and newline begins a chunk, which needs no
    expression: a character that the text does not hold is put there and split at.
    """
    if "\0" in text or any(run in text for run in RUNS):
        return CHUNK.findall(text)
    cut = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return cut if cut[0] else cut[1:]


def marks_apart(chunk: str) -> tuple[str, str]:
    """A chunk as a word and the marks behind it, which are pre-tokens apart; or whole and empty."""
    word = chunk.rstrip(MARKS)
    if len(word) < len(chunk) and word[-1:].isalpha():
        return word, chunk[len(word):]
    return chunk, ""
