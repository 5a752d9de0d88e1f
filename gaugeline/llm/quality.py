"""Quality rules: word and repetition counts, and lines that a host puts on many pages.

Cross-document line frequency: lines are normalised and hashed, and for every (host,
line) the distinct documents are counted. Lines above the limits are removed, and a
document that loses most of its words is rejected.

Exact copies of a text count as one document, so they are not mistaken for a page
furniture: they are left to the near-duplicate operators, which keep one of them.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.text import slices, with_text
from gaugeline.session import materialise

SYMBOLS = "#*$%&|<>"

FEATURES = (
    "doc_id bigint, host string, text_hash bigint, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "lines array<struct<line: bigint, words: bigint>>"
)
LINE = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))


def line_hash(normalised: bytes) -> int:
    return int.from_bytes(hashlib.md5(normalised).digest()[:8], "big", signed=True)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of words found at least twice in the text."""
    windows = list(zip(*(words[i:] for i in range(window))))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total, covered = 0, 0
    for at, found in enumerate(windows):
        if seen[found] > 1:
            total += at + window - max(at, covered)
            covered = at + window
    return total


def features_of(text: str) -> tuple[int, int, int, int, int, list[dict]]:
    raw = text.encode()
    words = raw.split()
    lines, kept = [], []
    for line in raw.split(b"\n"):
        parts = line.lower().split()
        if parts:
            lines.append(line)
            kept.append((line_hash(b" ".join(parts)), len(parts)))
    spaces = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    found: Counter[int] = Counter()
    for line, count in kept:
        found[line] += count
    return (
        len(words),
        len(text) - spaces,
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        [{"line": k, "words": n} for k, n in found.items()],
    )


def features(docs: DataFrame) -> DataFrame:
    """Counts and distinct lines of every document, one row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                columns = list(zip(*map(features_of, texts)))
                yield pa.record_batch(
                    [
                        *(batch.column(c).slice(first, len(texts)) for c in KEYS),
                        *(pa.array(c, pa.int64()) for c in columns[:5]),
                        pa.array(columns[5], LINE),
                    ],
                    [field.split()[0] for field in FEATURES.split(", ")[:8]] + ["lines"],
                )

    return docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("host"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    ).mapInArrow(run, FEATURES)


KEYS = ("doc_id", "host", "text_hash")


def frequent_lines(rows: DataFrame, min_docs: int, min_share: float) -> DataFrame:
    """(host, line) of lines in more documents of a host than both limits allow.

    Documents of one text count once on either side, so copies move neither limit.
    """
    seen = (
        rows.select("host", "text_hash", F.explode("lines.line").alias("line"))
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") > min_docs)
    )
    hosts = rows.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    return (
        seen.join(hosts, "host")
        .where(F.col("docs") > min_share * F.col("host_docs"))
        .select("host", "line")
    )


def judge(
    docs: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    min_docs: int = 10,
    min_share: float = 0.01,
    min_left_percent: int = 50,
) -> DataFrame:
    """Counts and verdict for every row of ``docs`` (doc_id, source, text).

    ``base_failed``: too few words, or too many of them in repeated windows. ``kept`` is
    false for these and where less than ``min_left_percent`` of the words are left when
    the lines in ``removed`` are gone: lines found in more than ``min_docs`` documents
    and more than ``min_share`` of the documents of their source, each text counted once.

    A missing text has no words and fails; documents without source share one host;
    repeated rows are judged like any other and count once for line frequency, as they
    have the same text; other columns are ignored; no rows give no rows.
    """
    rows = materialise(features(docs).withColumn("_row", F.monotonically_increasing_id()), "quality")
    gone = (
        rows.select("_row", "host", F.explode("lines").alias("l"))
        .select("_row", "host", "l.line", "l.words")
        .join(frequent_lines(rows, min_docs, min_share), ["host", "line"])
        .groupBy("_row")
        .agg(F.sum("words").alias("gone"), F.collect_list("line").alias("removed"))
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    return (
        rows.drop("lines")
        .join(gone, "_row", "left")
        .withColumn("base_failed", failed)
        .withColumn("words_left", left)
        .withColumn("kept", ~failed & (100 * left >= min_left_percent * F.col("n_words")))
        .drop("_row", "gone")
    )


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The documents ``judge`` keeps, without the lines it removes; columns as in ``docs``.

    ``n_chars``, where present, follows the text.
    """
    verdicts = (
        judge(docs, **limits)
        .where("kept")
        .select(*[F.col(c).alias(f"_{c}") for c in KEYS], F.col("removed").alias("_removed"))
        .dropDuplicates([f"_{c}" for c in KEYS])
    )
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.coalesce("row.source", F.lit("")) == F.col("_host"))
        & (F.xxhash64("row.text") == F.col("_text_hash"))
    )
    # All columns travel as one, so none can clash with those of the verdict.
    # Both sides are sorted by key at every size: verdicts grow with the documents.
    kept = docs.select(F.struct(*docs.columns).alias("row")).join(verdicts.hint("merge"), same)

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series, removed: pd.Series) -> pd.Series:
        pairs = zip(texts, removed)
        return pd.Series([t if r is None else without(t, set(r)) for t, r in pairs], dtype=object)

    text = F.when(F.col("_removed").isNull(), F.col("row.text")).otherwise(
        rewritten("row.text", "_removed")
    )
    return with_text(docs, kept.withColumn("_text", text))


def without(text: str, removed: set[int]) -> str:
    """The text less the lines of these hashes."""
    return "\n".join(
        line
        for line in text.split("\n")
        if not (parts := line.encode().lower().split()) or line_hash(b" ".join(parts)) not in removed
    )
