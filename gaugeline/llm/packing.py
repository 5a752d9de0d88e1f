"""Best-fit packing of tokenised documents into sequences of a fixed length.

Every task packs the documents of its partition on line: a bounded number of sequences
is open, each known by its free space; a piece goes where it leaves the least room. If
it fits nowhere and all places are taken, the fullest open sequence closes. The free
spaces are the bits of one integer, so the best place is the lowest set bit from the
piece's length on and the fullest sequence is the lowest set bit of all.

Nothing is shuffled. The sequences a task still has open at its end are the only cost of
splitting the work, at most ``places`` a task, and most of them are nearly full.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gaugeline.llm.text import slices
from gaugeline.llm.wordbpe import WordEncoder

# A sequence number is the task's number and a count within the task.
TASK_SHIFT = 33
SEPARATOR = (0).to_bytes(4, "little")


class BestFit:
    """Bounded-space best fit; sizes are 1 to ``capacity``, ``places`` sequences are open."""

    def __init__(self, capacity: int, places: int):
        self.capacity, self.places = capacity, places
        self.bits, self.open = 0, 0
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.next_id = 0

    def put(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of a new piece."""
        fits = self.bits >> size << size
        if fits:
            free = (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open >= self.places and size < self.capacity:
                self._take((self.bits & -self.bits).bit_length() - 1)
            sequence, free = self.next_id, self.capacity
            self.next_id += 1
        rest = free - size
        if rest:
            self.by_free[rest].append(sequence)
            self.bits |= 1 << rest
            self.open += 1
        return sequence, self.capacity - free

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        sequence = held.pop()
        if not held:
            self.bits &= ~(1 << free)
        self.open -= 1
        return sequence


PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids binary, "
    "sequence_id bigint, offset bigint"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    places: int = 512,
    lookahead_chars: int = 4_000_000,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence of ``capacity`` ids.

    A document is its ids (``tokenizer`` is the file of a word BPE) and a closing 0. It
    is cut only if longer than a sequence. ``ids`` holds the piece's ids as unsigned
    little-endian 32-bit numbers. Documents read together (``lookahead_chars``) are
    placed in falling order of length.

    A missing or empty text is the single id 0. Repeated rows and rows without doc_id
    are packed like any other; other columns are ignored; no rows give no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins = WordEncoder(tokenizer), BestFit(capacity, places)
        base = TaskContext.get().partitionId() << TASK_SHIFT
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch.column("text"), lookahead_chars):
                rows = []
                for at, text in enumerate(texts):
                    ids = encoder.encode(text) + SEPARATOR
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        rows.append((keys[first + at], piece, start // 4, len(part) // 4, part))
                rows.sort(key=lambda row: -row[3])
                places_of = [bins.put(row[3]) for row in rows]
                columns = list(zip(*rows)) + [
                    [base + sequence for sequence, _ in places_of],
                    [offset for _, offset in places_of],
                ]
                yield pa.record_batch(
                    [pa.array(c, kind) for c, kind in zip(columns, ARROW_TYPES)], NAMES
                )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


NAMES = [field.split()[0] for field in PIECES.split(", ")]
ARROW_TYPES = [
    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
]
