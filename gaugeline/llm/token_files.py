"""Token ids in ORC files: one list of integers a document, in ascending order of doc_id.

ORC writes the integers run-length encoded, in stripes that are read by different tasks,
with an index entry every ``row_stride`` rows and Bloom filters on doc_id: a reader that
asks for few documents skips files, stripes and row groups by their metadata.

Rows are dealt out by ranges of doc_id. A file knows its number and, for each document,
the ids before it in the same file; the ids of earlier files are added when it is read,
from one number a file. So no task and not the driver ever counts through the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.llm.bpe import Encoder
from gaugeline.llm.text import slices, text_or_empty
from gaugeline.operators.joins import lookup_join

END = 0
SLICE_CHARS = 8_000_000
STRIPE_BYTES = 16 << 20
ROW_STRIDE = 1_000
FILES_BROADCAST = 1_000_000  # rows of (file, ids before it) that may be broadcast: 16 MB

SCHEMA = "part int, doc_id bigint, before bigint, n_tokens bigint, ids array<int>"


class BatchEncoder:
    """Encodes many texts at once, each chunk between single blanks only once.

    The tokenizer has a boundary before every blank that follows and precedes something
    else, so the different chunks of a batch are encoded as one text and each document's
    ids are put together from theirs. Texts in which a chunk is empty, has white space at
    an end or holds a special token are encoded as a whole.
    """

    def __init__(self, tokenizer: str):
        self.single = Encoder(tokenizer)
        top = max(self.single.token) + 1
        self.size = np.zeros(top, np.int64)
        for rank, piece in self.single.token.items():
            self.size[rank] = len(piece)

    def _joined(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks, each with a blank before it, and where each chunk's end."""
        if not len(chunks):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        one = pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks)
        ids = np.array(self.single.plain(" " + pc.binary_join(one, " ")[0].as_py()), np.int32)
        bytes_before = np.cumsum(pc.binary_length(chunks).to_numpy().astype(np.int64) + 1)
        return ids, np.searchsorted(np.cumsum(self.size[ids]), bytes_before) + 1

    def _odd(self, chunks: pa.Array) -> np.ndarray:
        odd = pc.not_equal(pc.utf8_trim_whitespace(chunks), chunks)
        odd = pc.or_(odd, pc.equal(chunks, ""))
        for name in self.single.special:
            odd = pc.or_(odd, pc.match_substring(chunks, name.split(" ")[0]))
        return odd.to_numpy(zero_copy_only=False)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where those of each end."""
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        place = coded.indices.to_numpy().astype(np.int64)
        odd = self._odd(coded.dictionary)
        # White space, blanks and special tokens meet across chunks only in odd texts.
        whole = np.add.reduceat(odd[place].astype(np.int64), bounds[:-1]) > 0 if texts else np.empty(0, bool)

        ids, ends = self._joined(coded.dictionary.filter(pa.array(~odd)))
        lengths = np.zeros(len(odd), np.int64)
        lengths[~odd] = np.diff(ends, prepend=0)
        # The first chunk of a text has no blank before it: it gets a place of its own.
        firsts = [
            self.single.encode(t if w else t.partition(" ")[0]) for t, w in zip(texts, whole)
        ]
        lengths = np.concatenate([[0], lengths, [len(f) for f in firsts]]).cumsum()
        flat = np.fromiter(chain.from_iterable(firsts), np.int32)
        known = pa.ListArray.from_arrays(lengths.astype(np.int32), np.concatenate([ids, flat]))

        place[bounds[:-1]] = len(odd) + np.arange(len(texts))
        if whole.any():
            kept = ~np.repeat(whole, np.diff(bounds))
            kept[bounds[:-1]] = True
            place, bounds = place[kept], np.concatenate([[0], kept.cumsum()])[bounds]
        found = known.take(pa.array(place))
        return found.flatten().to_numpy(), found.offsets.to_numpy()[bounds[1:]].astype(np.int64)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    stripe_bytes: int = STRIPE_BYTES,
    row_stride: int = ROW_STRIDE,
) -> None:
    """Write the ids of every text and a closing 0 as ORC files in the new folder ``path``.

    ``tokenizer`` is the file of a byte-level BPE. A missing or empty text is the single
    id 0. Rows without doc_id come first, rows of one doc_id lie in order of their texts'
    hash, and a doc_id that holds very many rows is dealt over several files. Repeated
    rows are written like any other; other columns are ignored; no rows make no ids.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = BatchEncoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in slices(batch.column("text"), SLICE_CHARS):
                ids, ends = encoder.encode(texts)
                n = len(texts)
                ids = np.insert(ids, ends, END)
                ends = ends + np.arange(1, n + 1)
                starts = np.concatenate([[0], ends[:-1]])
                lists = pa.ListArray.from_arrays(np.append(starts, len(ids)).astype(np.int32), ids)
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        batch.column("doc_id").slice(first, n),
                        pa.array(before + starts),
                        pa.array(ends - starts),
                        lists,
                    ],
                    ["part", "doc_id", "before", "n_tokens", "ids"],
                )
                before += len(ids)

    order = ["doc_id", "_text_hash", "_from"]
    rows = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text")).withColumns(
        {"_text_hash": F.xxhash64("text"), "_from": F.spark_partition_id()}
    )
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    (
        placed.mapInArrow(encoded, SCHEMA)
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", row_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files of ``write``; ``start`` counts the ids of
    all documents before. Filters on doc_id reach the files' metadata."""
    files = spark.read.schema(SCHEMA).orc(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    return lookup_join(files, bases, ["part"], "inner", FILES_BROADCAST).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of ``read`` of a few documents, found through the files' metadata."""
    return read(spark, path).where(F.col("doc_id").isin(list(doc_ids)))


def checksums(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32`` of the ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<i4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            rest = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
            yield pa.record_batch(
                [*rest, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
