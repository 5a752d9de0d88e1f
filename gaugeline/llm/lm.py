"""Log-likelihood of whole documents under a recurrent language model of the corpus.

Word counts cover all training documents. The most frequent words, at most ``TABLE`` of
them, go to every task. The network predicts classes of words: classes of the commonest
words predict the word as well; the other words of the table share classes by language
and frequency, and words outside the table by their form. In those classes a word has its
share of the class by count, and a word never met the share of one occurrence, so every
text has a probability.

Training: a first network from ``warm_docs`` documents or so, then one pass of every task
over its own training documents from there; the networks' mean, weighted by tokens, is the
model. Counts of words outside the table meet their documents by a join.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import recurrent
from gaugeline.llm.text import lower_words, slices
from gaugeline.session import materialise

TABLE = 200_000
WORDED_CLASSES, CLASS_WORDS = 32, 32
BANDS = 3
LANGUAGES = 4
FORMS = 16
END = b""
# Tokens a task handles side by side: many times those of a long text, so lanes stay full.
SLICE_TOKENS = 2_500_000

MARKED = re.compile(rb"[0-9#*$%&|<>]")
SYMBOLS = "[0-9#*$%&|<>]"


def form(word: bytes) -> int:
    """Of 16 forms: length, letters beyond ASCII, stop at the end, digits or symbols."""
    return (len(word) > 9) * 8 + (not word.isascii()) * 4 + (word[-1:] in b".,;:!?") * 2 + bool(MARKED.search(word))


def form_column(word: str) -> Column:
    """``form`` as an expression; the end mark has the form of an empty word."""
    size, text = F.octet_length(word), F.col(word)
    band = (size > 9).cast("int")
    beyond = (size > F.char_length(word)).cast("int")
    stops = ((F.length(word) == 0) | F.right(word, F.lit(1)).isin(*".,;:!?")).cast("int")
    return band * 8 + beyond * 4 + stops * 2 + text.rlike(SYMBOLS).cast("int")


def held_out(doc_id: str = "doc_id") -> Column:
    """One seventh of the documents, by checksum of the id; a missing id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, lang) over all ``docs``; the end mark is the empty word.

    lang is a checksum of the language with the most occurrences in a task's share of a
    word; it only tells languages apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, texts in slices(batch.column("text"), 8_000_000):
                by_lang: dict[str, Counter] = {}
                for at, text in enumerate(texts):
                    counted = by_lang.setdefault(langs[first + at], Counter())
                    counted.update(lower_words(text))
                    counted[END] += 1
                for lang, counted in by_lang.items():
                    yield pa.record_batch(
                        [
                            pa.array(list(counted), pa.binary()).cast(pa.string()),
                            pa.array(list(counted.values()), pa.int64()),
                            pa.array([zlib.crc32(lang.encode())] * len(counted), pa.int64()),
                        ],
                        ["word", "n", "lang"],
                    )

    lang = F.coalesce("lang", F.lit("")) if "lang" in docs.columns else F.lit("")
    parts = docs.select("text", lang.alias("lang")).mapInArrow(run, "word string, n bigint, lang bigint")
    # Both in one number: a maximum of structs would need a sort. The counts of a slice are below 2**31.
    most = F.max(F.shiftleft("n", 32).bitwiseOR(F.col("lang")))
    return parts.groupBy("word").agg(F.sum("n").alias("c"), most.bitwiseAND(F.lit(0xFFFFFFFF)).alias("lang"))


@dataclass
class Vocabulary:
    """What a task knows of words: the table's codes, and per code its class and shares."""

    codes: dict[bytes, int]
    shape: recurrent.Shape
    map: recurrent.Codes
    share: np.ndarray  # natural log of a word's share of a class without words of its own
    log_count: np.ndarray  # log10(c + 1), 0 for words outside the table
    class_share: np.ndarray
    tokens: int
    words: int

    def encode(self, text: str) -> tuple[np.ndarray, Counter]:
        """Codes of a text and its end; the words outside the table, counted."""
        words = lower_words(text)
        words.append(END)
        codes = np.array([*map(self.codes.get, words, repeat(-1))], np.int32)
        others = np.flatnonzero(codes < 0).tolist()
        base = len(self.codes)
        for at in others:
            codes[at] = base + form(words[at])
        return codes, Counter(words[at] for at in others)


def vocabulary(counts: DataFrame, table: int = TABLE) -> Vocabulary:
    """The words of at least the lowest count that leaves no more than ``table`` of them."""
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    band = F.floor(F.log2("c") * 16)
    histogram = counts.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.min("c").alias("least"))
    # Words met once stay outside: they teach how often a new word comes.
    least, used = None, 0
    for row in sorted(histogram.collect(), key=lambda r: -r["band"]):  # some hundred bands
        used += row["n"]
        if used > table or row["least"] < 2:
            break
        least = row["least"]
    inside = F.col("c") >= least if least is not None else F.lit(False)
    known = counts.where(inside).toPandas().sort_values(["c", "word"], ascending=[False, True])
    outside = counts.where(~inside).groupBy(form_column("word").alias("form")).agg(F.sum(F.col("c") + 1).alias("z"))
    rest = np.ones(FORMS)
    for row in outside.collect():
        rest[row["form"]] += row["z"]
    return arrange(known, rest, totals["n"], totals["v"])


def arrange(known: pd.DataFrame, rest: np.ndarray, tokens: int, words: int) -> Vocabulary:
    """Classes: of the commonest words by language, of other words by language and band, of forms."""
    own = known.head(WORDED_CLASSES * CLASS_WORDS)
    own = own.iloc[np.lexsort((-own["c"].to_numpy(), own["lang"].to_numpy()))]
    known = pd.concat([own, known.iloc[len(own) :]], ignore_index=True)
    worded = -(-len(own) // CLASS_WORDS)
    c = known["c"].to_numpy(float)
    group, place = np.arange(len(known)) // CLASS_WORDS, np.arange(len(known)) % CLASS_WORDS
    tail = np.arange(len(known)) >= len(own)
    common = known["lang"].value_counts().index[:LANGUAGES].tolist()
    lang = known["lang"].map({name: at for at, name in enumerate(common)}).fillna(LANGUAGES).to_numpy(int)
    mass = np.cumsum(np.where(tail, c, 0))
    band = np.minimum(BANDS - 1, (BANDS * mass / max(1.0, mass[-1] if len(mass) else 0)).astype(int))
    found, dense = np.unique((lang * BANDS + band)[tail], return_inverse=True)
    group[tail], place[tail] = worded + dense, 0
    plain = worded + len(found)
    group = np.concatenate([group, plain + np.arange(FORMS)]).astype(np.int64)
    place = np.concatenate([place, np.zeros(FORMS)]).astype(np.int64)
    class_mass = np.bincount(group, np.concatenate([c, rest]), plain + FORMS)
    share = np.zeros(len(group))
    share[: len(known)][tail] = np.log(c[tail] / class_mass[group[: len(known)][tail]])
    share[len(known) :] = -np.log(rest)
    row = np.where(group < worded, np.arange(len(group)), len(own) + group - worded)
    return Vocabulary(
        {w.encode(): at for at, w in enumerate(known["word"])},
        recurrent.Shape(len(own) + plain + FORMS - worded, plain + FORMS, worded, CLASS_WORDS),
        recurrent.Codes(row, group, place),
        share,
        np.concatenate([np.log10(c + 1), np.zeros(FORMS)]),
        class_mass / class_mass.sum(),
        int(tokens),
        int(words),
    )


def fresh_network(known: Vocabulary) -> recurrent.Network:
    net = recurrent.Network.fresh(known.shape, known.class_share)
    used = known.map.group < known.shape.worded
    empty = np.ones(net.word_bias.shape, bool)
    empty[known.map.group[used], known.map.place[used]] = False
    net.word_bias[empty] = -1e9
    return net


WEIGHTS = "at int, weighted double, tokens double"


def _to_tasks(docs: DataFrame, content: tuple) -> Broadcast:
    """A broadcast of bounded size; classes of this package travel with their code."""
    return docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(content))


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """(doc_id, _row, codes: 32-bit codes of the tokens, others: its words outside the table), written once."""
    vocab = _to_tasks(docs, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(vocab.value)
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                coded = [known.encode(t) for t in texts]
                sizes = [len(o) for _, o in coded]
                words = pa.array([w for _, o in coded for w in o], pa.binary()).cast(pa.string())
                times = pa.array([n for _, o in coded for n in o.values()], pa.int64())
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                pairs = pa.StructArray.from_arrays([words, times], ["word", "n"])
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array([c.tobytes() for c, _ in coded], pa.binary()),
                        pa.ListArray.from_arrays(ends, pairs),
                    ],
                    ["doc_id", "codes", "others"],
                )

    rows = docs.select("doc_id", "text").mapInArrow(run, ENCODED)
    written = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "lm-codes")
    vocab.unpersist()
    return written


def _code_slices(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, codes) of runs of rows of about ``SLICE_TOKENS`` tokens."""
    start, held, size = 0, [], 0
    for at, value in enumerate(column):
        held.append(np.frombuffer(value.as_buffer(), np.int32))
        size += len(held[-1])
        if size >= SLICE_TOKENS:
            yield start, held
            start, held, size = at + 1, [], 0
    if held:
        yield start, held


def _trained(rows: DataFrame, known: Vocabulary, start: np.ndarray | None, rate: float, passes: int) -> np.ndarray:
    """Mean weights of the networks that the tasks train on their documents' codes, by tokens."""
    vocab = _to_tasks(rows, (replace(known, codes={}), start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start = pickle.loads(vocab.value)
        net = fresh_network(known) if start is None else recurrent.Network(known.shape, start.copy())
        adam, done = recurrent.Adam(len(net.flat), rate), 0
        for batch in batches:
            for _, coded in _code_slices(batch.column("codes")):
                for _ in range(passes):
                    done += recurrent.train(net, coded, known.map, adam)
        if done:
            columns = [np.arange(len(net.flat), dtype=np.int32), net.flat.astype(float) * done, np.full(len(net.flat), float(done))]
            yield pa.record_batch([pa.array(c) for c in columns], ["at", "weighted", "tokens"])

    means = rows.select("codes").mapInArrow(run, WEIGHTS).groupBy("at").agg(
        (F.sum("weighted") / F.sum("tokens")).alias("w")
    )
    found = means.toPandas().sort_values("at")  # one row for each weight of the network
    vocab.unpersist()
    if not len(found):
        return fresh_network(known).flat if start is None else start
    return found["w"].to_numpy(np.float32)


def train(rows: DataFrame, known: Vocabulary, warm_docs: int = 1500) -> np.ndarray:
    """Weights learnt from all ``rows`` of ``encoded``: a start from some, then a pass of all tasks."""
    count = max(1, rows.count())
    share = int(min(1.0, warm_docs / count) * 1_000_000)
    # Rows are drawn by number: copies of one document are not drawn together.
    chosen = F.pmod(F.xxhash64("_row"), F.lit(1_000_000)) < share
    warm = rows.where(chosen).select("codes").repartition(1)
    start = _trained(warm, known, None, 0.01, 4)
    return _trained(rows, known, start, 0.002, 1)


ENCODED = "doc_id bigint, codes binary, others array<struct<word: string, n: bigint>>"
SCORED = "doc_id bigint, _row bigint, n_tokens bigint, in_table bigint, base double, model double"


def score(rows: DataFrame, counts: DataFrame, known: Vocabulary, weights: np.ndarray) -> DataFrame:
    """Known tokens, base and model score of every row of ``encoded``."""
    vocab = _to_tasks(rows, (replace(known, codes={}), weights))
    base = len(known.codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = pickle.loads(vocab.value)
        net = recurrent.Network(known.shape, weights)
        for batch in batches:
            for first, codes in _code_slices(batch.column("codes")):
                sizes = np.array([len(c) for c in codes])
                owner = np.repeat(np.arange(len(codes)), sizes)
                flat = np.concatenate(codes)
                by_row = lambda v: np.bincount(owner, v, len(codes))
                told = (recurrent.score(net, codes, known.map) + by_row(known.share[flat])) / np.log(10)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(first, len(codes)),
                        batch.column("_row").slice(first, len(codes)),
                        pa.array(sizes),
                        pa.array(by_row(flat < base).astype(np.int64)),
                        pa.array(by_row(known.log_count[flat])),
                        pa.array(told),
                    ],
                    ["doc_id", "_row", "n_tokens", "in_table", "base", "model"],
                )

    scored = rows.select("doc_id", "_row", "codes").mapInArrow(run, SCORED)
    met = (
        rows.select("_row", F.explode("others").alias("o"))
        .select("_row", "o.word", "o.n")
        .join(counts.select("word", "c"), "word")
        .groupBy("_row")
        .agg(F.sum("n").alias("met"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    )
    more = F.coalesce("more", F.lit(0.0))
    total = float(np.log10(known.tokens + known.words + 1))
    return scored.join(met, "_row", "left").select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("in_table") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * total).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )


def score_corpus(docs: DataFrame, warm_docs: int = 1500, table: int = TABLE) -> DataFrame:
    """Trains on the documents that are not held out and scores all, by log10 probability.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (tokens met in
    training), train_tokens, base_score (by smoothed counts), score (by the model).

    A missing or empty text is its end alone. A missing doc_id counts as '' for the choice
    of training documents. Repeated rows count and are scored each; a column ``lang``, if
    any, helps to form classes; other columns are ignored; no rows give no rows.
    """
    training = docs.where(~held_out())
    counts = materialise(word_counts(training), "lm-counts")
    known = vocabulary(counts, table)
    rows = encoded(docs, known)
    return score(rows, counts, known, train(rows.where(~held_out()), known, warm_docs))
