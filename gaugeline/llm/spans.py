"""Substring removal by sliding sentence spans.

A text is cut into sentences. The run of ``RUN`` consecutive sentences, or more if they
are short, from every sentence on is hashed; hashes meet over all documents; each run
found again, save its first occurrence, marks its sentences, and marked sentences are
removed.

What has no end of sentence for more than ``LONG`` words, lists and text without
punctuation mostly, is cut at words chosen by their own hash, so that the same passage is
cut alike wherever it stands. With whole sentences only, 8 % of the passages above
50 words that repeat in the test tables would have no run at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.text import slices, with_text
from gaugeline.session import materialise

RUN = 3
MIN_WORDS = 20
LONG, SHORTEST, LONGEST = 24, 3, 16

SEPARATOR = re.compile(r"(?<=[.!?…])[^\S\n]+|(?<=[。！？])|\s*\n\s*")
WORD = re.compile(r"\S+")
BASE = 0x9E3779B97F4A7C15


def _cuts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Parts of an overlong sentence, cut by what the words are, not by where they stand.

    A cut follows a word whose hash is a multiple of 4, and the last of a word's repeats.
    """
    since, first, last, again, stop = 0, start, "", False, start
    for found in WORD.finditer(text, start, end):
        word = found[0].lower()
        if since and again and word != last:
            yield first, stop
            since = 0
        if not since:
            first = found.start()
        since, again, last, stop = since + 1, word == last, word, found.end()
        chosen = since >= SHORTEST and xxhash.xxh32_intdigest(word) % 4 == 0
        if (chosen or since == LONGEST) and stop < end:
            yield first, stop
            since = 0
    if since:
        yield first, end


def sentences(text: str) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """(start, end) of each sentence with a word, its hash, its number of words.

    A sentence ends where the next begins, so blanks after it go with it.
    """
    bounds, start = [], 0
    for gap in SEPARATOR.finditer(text):
        bounds.append((start, gap.start()))
        start = gap.end()
    bounds.append((start, len(text)))
    places, hashes, counts = [], [], []
    for start, end in bounds:
        words = text[start:end].lower().split()
        parts = [(start, end, words)]
        if len(words) > LONG:
            parts = [(s, e, text[s:e].lower().split()) for s, e in _cuts(text, start, end)]
        for s, e, words in parts:
            if words:
                places.append((s, e))
                hashes.append(xxhash.xxh64_intdigest(" ".join(words)))
                counts.append(len(words))
    return places, hashes, counts


def run_ends(counts: list[int]) -> np.ndarray:
    """Where the run from each sentence ends: after ``RUN`` sentences and ``MIN_WORDS`` words.

    Sentences too near the end of the text start no run.
    """
    before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    enough = np.searchsorted(before, before[:-1] + MIN_WORDS)
    ends = np.maximum(enough, np.arange(len(counts)) + RUN)
    return ends[ends <= len(counts)]


def _powers(count: int) -> np.ndarray:
    """BASE to the power of -count .. count, modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(count, BASE, np.uint64), dtype=np.uint64)
        down = np.cumprod(np.full(count, pow(BASE, -1, 1 << 64), np.uint64), dtype=np.uint64)
    return np.concatenate([down[::-1], [np.uint64(1)], up])


def run_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of the run from each sentence."""
    _, hashes, counts = sentences(text)
    ends = run_ends(counts)
    at = np.arange(len(ends))
    if not len(ends):
        return at.astype(np.int32), np.empty(0, np.int64)
    n, units = len(hashes), np.array(hashes, np.uint64)
    powers = _powers(n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(units * powers[n : 2 * n], dtype=np.uint64)])
    found = (sums[ends] - sums[at]) * powers[n - at] + (ends - at).astype(np.uint64)
    found = (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return at.astype(np.int32), (found ^ (found >> np.uint64(32))).view(np.int64)


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, pos, run) for every run of every document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("text"), 1_000_000):
                found = [run_hashes(t) for t in texts]
                row = np.repeat(np.arange(first, first + len(texts)), [len(p) for p, _ in found])
                yield pa.record_batch(
                    [
                        batch.column("doc_id").take(pa.array(row)),
                        batch.column("text_hash").take(pa.array(row)),
                        pa.array(np.concatenate([p for p, _ in found])),
                        pa.array(np.concatenate([h for _, h in found])),
                    ],
                    ["doc_id", "text_hash", "pos", "run"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        find, "doc_id bigint, text_hash bigint, pos int, run bigint"
    )


def without(text: str, positions: list[int]) -> tuple[str, int]:
    """The text less the sentences of the runs at ``positions``, and how many these are."""
    places, _, counts = sentences(text)
    ends = run_ends(counts)
    gone = {k for at in positions for k in range(at, int(ends[at]))}
    parts, at = [], 0
    for number in sorted(gone):
        start = places[number][0]
        parts.append(text[at:start])
        at = places[number + 1][0] if number + 1 < len(places) else len(text)
    parts.append(text[at:])
    left = "".join(parts)
    return (left.rstrip() if len(places) - 1 in gone else left), len(gone)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages removed from ``text``, and ``n_removed`` sentences.

    A run of three sentences, or as many more as make ``MIN_WORDS`` words, stays where it occurs
    first: in the smallest doc_id, there at the first place. ``n_chars``, where present, follows the
    text. A document that repeats an earlier one as a whole is left with an empty text.

    A missing text stays missing; texts of fewer than three sentences have no run.
    Repeated rows are one document and get the same text; rows without doc_id come last
    in order. Other columns are kept; no rows give no rows.
    """
    found = materialise(runs(docs), "spans")
    order = F.struct(
        F.col("doc_id").isNull().alias("late"), F.col("doc_id"), F.col("text_hash"), F.col("pos")
    )
    # Most runs occur once: they are only counted, and the order of the rest is looked at.
    # Both joins are of written tables, so that a run that is met very often can be split.
    repeated = found.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run")
    met = materialise(found.join(materialise(repeated, "spans-repeated"), "run"), "spans-met")
    firsts = materialise(met.groupBy("run").agg(F.min(order).alias("first")), "spans-first")
    again = met.join(firsts, "run").where(order != F.col("first"))
    marked = again.groupBy(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")
    ).agg(F.sort_array(F.collect_set("pos")).alias("_positions"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_doc_id")) & (
        F.xxhash64("row.text") == F.col("_text_hash")
    )
    # All columns travel as one, so none can clash with those of the marks.
    joined = docs.select(F.struct(*docs.columns).alias("row")).join(
        marked.hint("merge"), same, "left"
    )

    @F.pandas_udf("text string, n_removed int")
    def rewritten(texts: pd.Series, positions: pd.Series) -> pd.DataFrame:
        done = [(t, 0) if p is None else without(t, list(p)) for t, p in zip(texts, positions)]
        return pd.DataFrame(done, columns=["text", "n_removed"])

    marks = F.col("_positions").isNotNull()
    done = joined.withColumn("_done", rewritten("row.text", "_positions"))
    return with_text(
        docs,
        done.withColumn("_text", F.when(marks, F.col("_done.text")).otherwise(F.col("row.text"))).withColumn(
            "n_removed", F.when(marks, F.col("_done.n_removed")).otherwise(0)
        ),
        "n_removed",
    )
