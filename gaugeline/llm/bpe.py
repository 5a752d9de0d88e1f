"""Byte-level BPE encoding by tree concatenation, and decoding.

A text of more than ``LEAF`` characters is halved, the halves are encoded on their own and
concatenated: the text around the join is encoded anew in a growing window until the
window's first tokens are the left half's and its last ones the right half's. Two facts
make agreement exact. Where a letter or digit run ends, or a word meets a blank, every
encoding has a boundary, whatever lies further away (``BREAK``). Inside one run a token
sequence is the encoding if every two neighbours are, so a window that starts and ends
with tokens of the halves proves the join.

Texts longer than ``SPLIT`` are cut into parts that are encoded by different tasks; only
those parts are shuffled, and the same joins put them together.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.text import slices
from gaugeline.llm.wordbpe import byte_of_char
from gaugeline.session import materialise

LEAF = 8_192
SPLIT = 262_144
WINDOW = 64

# Places where an encoding always has a boundary and that look alike from either side.
BREAK = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=\S)(?=\s)")
# Runs that the tokenizer's pattern takes as one piece wherever they are cut.
UNIFORM = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}']+")


class Encoder:
    """Encodes texts as the tokenizers library does with the file ``path``.

    The ranks come from the same file, merged by tiktoken; special tokens in a text keep
    their ids, as in the library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte = byte_of_char()
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = {
            bytes(byte[c] for c in token): rank
            for token, rank in content["model"]["vocab"].items()
            if token not in self.special
        }
        self.token = {rank: piece for piece, rank in ranks.items()}
        self.token |= {rank: name.encode() for name, rank in self.special.items()}
        self.merger = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.names = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def plain(self, text: str) -> list[int]:
        return self.merger.encode_ordinary(text)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; special tokens part it into texts of their own."""
        if not self.names or not self.names.search(text):
            return self.tree(text)
        ids, start = [], 0
        for name in self.names.finditer(text):
            ids += self.tree(text[start : name.start()])
            ids.append(self.special[name[0]])
            start = name.end()
        return ids + self.tree(text[start:])

    def tree(self, text: str) -> list[int]:
        if len(text) <= LEAF:
            return self.plain(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, right, self.tree(left), self.tree(right))

    def join(self, left: str, right: str, left_ids: list[int], right_ids: list[int]) -> list[int]:
        """The ids of ``left + right`` from those of its halves."""
        if not left or not right:
            return left_ids + right_ids
        window = WINDOW
        while True:
            whole = window >= max(len(left), len(right))
            a = None if whole else self._break_before(left, window)
            b = None if whole else self._break_after(right, window)
            if whole or (a is not None and b is not None):
                a, b = a or 0, len(right) if b is None else b
                ids = self.plain(left[a:] + right[:b])
                kept = self._count(left_ids, len(left[a:].encode()), True)
                rest = self._count(right_ids, len(right[:b].encode()), False)
                if kept is not None and rest is not None:
                    return left_ids[: len(left_ids) - kept] + ids + right_ids[rest:]
            elif a is None and b is None and UNIFORM.fullmatch(left[-2 * window :] + right[: 2 * window]):
                found = self._inside(window, left_ids, right_ids)
                if found is not None:
                    return found
            window *= 2

    @staticmethod
    def _break_before(left: str, window: int) -> int | None:
        """The last boundary at least ``window`` characters before the end of ``left``."""
        start = max(0, len(left) - 2 * window - 1)
        found = None
        for match in BREAK.finditer(left, start, len(left) - window + 1):
            if start < match.start() <= len(left) - window:
                found = match.start()
        return found if found is not None else (0 if start == 0 else None)

    @staticmethod
    def _break_after(right: str, window: int) -> int | None:
        """The first boundary at least ``window`` characters into ``right``."""
        end = min(len(right), 2 * window + 1)
        for match in BREAK.finditer(right, window, end):
            if window <= match.start() < end:
                return match.start()
        return len(right) if end == len(right) else None

    def _count(self, ids: list[int], size: int, from_end: bool) -> int | None:
        """How many tokens at an end of ``ids`` cover ``size`` bytes; None if one is cut."""
        count = 0
        while size > 0:
            size -= len(self.token[ids[-1 - count] if from_end else ids[count]])
            count += 1
        return count if size == 0 else None

    def _inside(self, window: int, left_ids: list[int], right_ids: list[int]) -> list[int] | None:
        """A join inside one run: agreement of the window's outer tokens proves it."""
        a, size = 0, 0
        while size < window and a < len(left_ids):
            a += 1
            size += len(self.token[left_ids[-a]])
        b, size = 0, 0
        while size < window and b < len(right_ids):
            size += len(self.token[right_ids[b]])
            b += 1
        piece = b"".join(map(self.token.__getitem__, left_ids[-a:] + right_ids[:b]))
        ids = self.merger._core_bpe.encode_single_piece(piece)
        if ids[0] == left_ids[-a] and ids[-1] == right_ids[b - 1]:
            return left_ids[:-a] + ids + right_ids[b:]
        return None

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


def _cut(text: str, names: regex.Pattern | None) -> list[str]:
    """Parts of at most ``SPLIT`` characters; a special token is never cut."""
    parts, start = [], 0
    while start < len(text):
        end = min(len(text), start + SPLIT)
        if names and end < len(text):
            for name in names.finditer(text, max(start, end - 64), min(len(text), end + 64)):
                if name.start() < end < name.end():
                    end = name.end()
        parts.append(text[start:end])
        start = end
    return parts


ENCODED = "doc_id bigint, ids array<int>, decoded string"
PARTS = "_row bigint, doc_id bigint, part int, text string, ids array<int>"


def _encoded(keys: pa.Array, ids: list[list[int]], decoded: list[str]) -> pa.RecordBatch:
    return pa.record_batch(
        [keys, pa.array([np.array(i, np.int32) for i in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())],
        ["doc_id", "ids", "decoded"],
    )


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``docs``: its text's ids, and these decoded.

    A missing or empty text has no ids and decodes to ''. Repeated rows and rows without
    doc_id are encoded like any other; other columns are ignored; no rows give no rows.
    """

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for first, texts in slices(batch.column("text"), 1_000_000):
                ids = [encoder.encode(t) for t in texts]
                yield _encoded(
                    batch.column("doc_id").slice(first, len(texts)), ids, [encoder.decode(i) for i in ids]
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Encoder(path).names
        for batch in batches:
            for at, text in enumerate(batch.column("text")):
                parts = _cut(text.as_py(), names)
                n = len(parts)
                yield pa.record_batch(
                    [
                        batch.column("_row").take(pa.array([at] * n)),
                        batch.column("doc_id").take(pa.array([at] * n)),
                        pa.array(range(n), pa.int32()),
                        pa.array(parts),
                    ],
                    ["_row", "doc_id", "part", "text"],
                )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                ids = np.array(encoder.encode(row.column("text")[0].as_py()), np.int32)
                yield row.append_column("ids", pa.array([ids], pa.list_(pa.int32())))

    def joined(rows: pa.Table) -> pa.Table:
        encoder = Encoder(path)
        rows = rows.sort_by("part")
        parts = list(zip(rows.column("text").to_pylist(), rows.column("ids").to_pylist()))
        while len(parts) > 1:
            pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
            parts = [
                (p[0][0] + p[1][0], joined_ids(encoder, *p[0], *p[1])) if len(p) > 1 else p[0]
                for p in pairs
            ]
        keys = rows.column("doc_id").combine_chunks().slice(0, 1)
        return pa.Table.from_batches([_encoded(keys, [parts[0][1]], [encoder.decode(parts[0][1])])])

    long = F.char_length("text") > SPLIT
    whole = docs.select("doc_id", "text")
    parts = materialise(
        whole.where(long)
        .select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
        .mapInArrow(cut, PARTS.replace(", ids array<int>", "")),
        "bpe-parts",
    )
    spread = parts.repartition("_row", "part").mapInArrow(leaves, PARTS)
    return (
        whole.where(~F.coalesce(long, F.lit(False)))
        .mapInArrow(short, ENCODED)
        .union(spread.groupBy("_row").applyInArrow(joined, ENCODED))
    )


def joined_ids(encoder: Encoder, left: str, left_ids: list, right: str, right_ids: list) -> list[int]:
    """Joins two parts of one text; special tokens next to the join part it already."""
    names = encoder.names
    if not names:
        return encoder.join(left, right, left_ids, right_ids)
    last = max((m.end() for m in names.finditer(left)), default=0)
    after = names.search(right)
    first = after.start() if after else len(right)
    ends, starts = left[last:], right[:first]
    head = encoder._count(left_ids, len(ends.encode()), True)
    tail = encoder._count(right_ids, len(starts.encode()), False)
    cut = len(left_ids) - head
    middle = encoder.join(ends, starts, left_ids[cut:], right_ids[:tail])
    return left_ids[:cut] + middle + right_ids[tail:]
