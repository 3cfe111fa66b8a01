"""Fill-in-the-middle: documents with their middle moved to the end.

A text is cut into units, white space with the visible run behind it. One full match of the repeated unit
holds the end of every repetition, so the number of units and both cuts are read off the match: nothing
loops over units. The library keeps some 200 bytes for every repetition and gives up at about a gigabyte, so
texts beyond `SECTION` characters are matched section by section, cut where a unit ends.

Draws depend on the seed and the document's id alone. Every row is worked on by itself: no shuffle.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import whole

UNITS = regex.compile(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)*")
#: White space behind visible text: a unit ends there.
BORDER = regex.compile(r"(?<=[^\x20\x09-\x0D])[\x20\x09-\x0D]")
#: Characters matched at a time, up to the next end of a unit.
SECTION = 1 << 18
#: Characters of output sent on at a time.
BATCH = 1 << 22

_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Recipe(NamedTuple):
    """`share` of 100 texts are changed, and `suffix_first` of 100 of those begin with their suffix."""

    seed: int = 42
    share: int = 50
    suffix_first: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 by the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[at : at + 4], "big") for at in range(0, 16, 4)]


def unit_ends(text: str, section: int = SECTION) -> list[int] | array:
    """Where each unit of the text ends."""
    if len(text) <= section:
        return UNITS.fullmatch(text).ends(1)
    ends, start = array("q"), 0
    while start < len(text):
        border = BORDER.search(text, start + section)
        stop = border.start() if border else len(text)
        ends.extend(UNITS.fullmatch(text, start, stop).ends(1))
        start = stop
    return ends


def turned(doc_id: int | None, text: str, recipe: Recipe) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    ends = unit_ends(text)
    n = len(ends)
    first, second, third, fourth = draws(recipe.seed, doc_id)
    marks = recipe.prefix, recipe.suffix, recipe.middle
    if not text or third % 100 >= recipe.share or any(mark in text for mark in marks):
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    start, stop = (ends[cut - 1] if cut else 0 for cut in (low, high))
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if fourth % 100 < recipe.suffix_first:
        form, parts = "spm", (recipe.suffix, suffix, recipe.prefix, prefix, recipe.middle, middle)
    else:
        form, parts = "psm", (recipe.prefix, prefix, recipe.suffix, suffix, recipe.middle, middle)
    return n, form, start, stop - start, "".join(parts)


def fill_in_middle(
    docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n (units of the text), form, prefix_chars, middle_chars, output.

    `form` is plain (output is the text; no cuts), psm (prefix, suffix, middle) or spm (suffix, prefix,
    middle). Null texts count as empty; empty texts, and texts that hold one of the marks, are plain. Texts
    of any length are taken whole. A row without an id draws by the seed alone. Rows that repeat
    an id draw alike, and each gives a row. An empty table gives no row. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                key, content = doc_id.as_py(), text.as_py()
                rows.append((key, *turned(key, content, recipe)))
                held += len(content)
                if held > BATCH:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return read.mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()
    names = "doc_id", "n", "form", "prefix_chars", "middle_chars", "output"
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def restored(output: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The text behind an output and its form.

    A mark's first place is its own: no text that was cut holds one, and none arises across a border,
    because a mark begins with a character that it does not hold again.
    """
    def piece(mark: str, next_mark: str | None = None) -> Column:
        begin = F.locate(mark, output) + len(mark)
        return F.substr(output, begin, *([F.locate(next_mark, output) - begin] if next_mark else []))

    prefix, suffix, middle = recipe.prefix, recipe.suffix, recipe.middle
    psm = F.concat(piece(prefix, suffix), piece(middle), piece(suffix, middle))
    spm = F.concat(piece(prefix, middle), piece(middle), piece(suffix, prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
