"""Small helpers the text operators share: words, batches, row keys."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but the six ASCII spaces. ``bytes.split()`` cuts at exactly
# these, and ``bytes.lower()`` changes exactly A-Z, so both work on UTF-8 directly.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text in order; none for a missing text."""
    return (text or "").encode().split()


def lower_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def slices(column: pa.ChunkedArray | pa.Array, chars: int = 4_000_000) -> Iterator[tuple[int, list]]:
    """(first row, texts) of runs of rows of about ``chars`` characters, missing texts as ''.

    Bounds what a task holds as Python objects whatever the size of an Arrow batch.
    """
    start, held, size = 0, [], 0
    for at, value in enumerate(column):
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= chars:
            yield start, held
            start, held, size = at + 1, [], 0
    if held:
        yield start, held


def with_text(docs: DataFrame, packed: DataFrame, *more: str) -> DataFrame:
    """The columns of ``docs`` from ``packed.row``, text from ``packed._text``, and ``more``.

    ``n_chars``, where present, follows the text.
    """
    taken = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        taken["n_chars"] = F.char_length("_text").cast(docs.schema["n_chars"].dataType)
    own = [taken.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns if c not in more]
    return packed.select(*own, *more)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
