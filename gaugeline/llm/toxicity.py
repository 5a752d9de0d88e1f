"""Toxicity by a chain of sparse linear classifiers.

Categories are predicted one after the other, each by a logistic model over the words of
a text and the log odds of the categories before it. When a model is trained, those log
odds come from models that have not seen the row (out of fold), as they will when it is
used. Weights are driven to zero by an L1 penalty, so scoring looks up a short list.

Only training sees a sample, of ``sample_rows`` labelled rows at most; it is chosen by a
hash of the doc_id. Every document is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.text import slices

LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5)
TABLE_BITS = 22
FOLDS = 4


def features_of_word(word: str) -> tuple[int, ...]:
    """Hashes of the word and of its beginnings, which survive compounding and inflection."""
    parts = [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]
    return tuple({xxhash.xxh32_intdigest(p) >> (32 - TABLE_BITS) for p in parts})


def words_of(text: str) -> set[str]:
    return {w for part in set(text.lower().split()) for w in LETTERS.findall(part)}


def features_of(text: str) -> np.ndarray:
    found = {f for word in words_of(text) for f in features_of_word(word)}
    return np.fromiter(sorted(found), np.int32, len(found))


@dataclass
class Linear:
    """A logistic model: sparse weights by feature, and one weight for each earlier category."""

    bias: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    earlier: list[float] = field(default_factory=list)

    def log_odds(self, found, before: list[float]) -> float:
        total = self.bias + sum(w * x for w, x in zip(self.earlier, before))
        return total + sum(self.weights.get(f, 0.0) for f in found)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(
    rows: list[np.ndarray],
    before: np.ndarray,
    labels: np.ndarray,
    penalty: float = 2e-4,
    kept_features: int = 4096,
    steps: int = 400,
) -> Linear:
    """L1 logistic regression by accelerated proximal steps on the most telling features.

    Labels are 0 or 1. What it holds beside the rows is a few arrays of the size of the
    feature table and of the rows' cells among the features kept.
    """
    n, positives = len(rows), labels.sum()
    rate = (positives + 0.5) / (n + 2)
    model = Linear(float(np.log(rate / (1 - rate))), {}, [0.0] * before.shape[1])
    if not 0 < positives < n:
        return model
    cells = np.concatenate(rows)
    # Features are small numbers: counted by place, which takes no sort and little memory.
    counts = np.bincount(cells, minlength=1 << TABLE_BITS)
    names = np.flatnonzero(counts)
    seen = counts[names]
    marked = [r for r, label in zip(rows, labels) if label]
    with_label = np.bincount(np.concatenate(marked), minlength=1 << TABLE_BITS)[names]
    del counts, marked
    share = seen / n
    expected = seen * positives / n
    spread = np.sqrt(np.maximum(expected * (1 - positives / n) * (1 - share), 1e-9))
    telling = np.where(seen > 1, np.abs(with_label - expected) / spread, 0)
    top = np.argsort(-telling, kind="stable")[:kept_features]
    place = np.full(1 << TABLE_BITS, -1, np.int32)
    place[names[top]] = np.arange(len(top))
    column = place[cells]
    used = np.flatnonzero(column >= 0)
    ends = np.cumsum([len(r) for r in rows])
    owner, column = np.searchsorted(ends, used, side="right"), column[used].astype(np.intp)
    del cells, place, used
    width = len(top) + before.shape[1] + 1

    def forward(w: np.ndarray) -> np.ndarray:
        sparse = np.bincount(owner, w[column], n)
        return sparse + before @ w[len(top) : -1] + w[-1]

    def backward(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(column, r[owner], len(top)), r @ before, [r.sum()]])

    v = np.ones(width)
    for _ in range(20):
        v = backward(forward(v / np.linalg.norm(v)))
    step = 4 * n / np.linalg.norm(v)
    shrink = np.full(width, penalty * step)
    shrink[len(top) :] = 0
    w = np.zeros(width)
    w[-1] = model.bias
    ahead, t = w, 1.0
    for _ in range(steps):
        moved = ahead - step * backward(_sigmoid(forward(ahead)) - labels) / n
        moved = np.sign(moved) * np.maximum(np.abs(moved) - shrink, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = moved + (last - 1) / t * (moved - w), moved
    model.bias, model.earlier = float(w[-1]), w[len(top) : -1].tolist()
    model.weights = {int(names[top[i]]): float(w[i]) for i in np.flatnonzero(w[: len(top)])}
    return model


def scores(model: Linear, rows: list[np.ndarray], before: np.ndarray) -> np.ndarray:
    return np.array([model.log_odds(r.tolist(), b) for r, b in zip(rows, before.tolist())])


@dataclass
class Chain:
    """Models in order, and the probability of the last category from which a text is rejected."""

    categories: list[str]
    models: list[Linear]
    threshold: float


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, categories: list[str]) -> Chain:
    """A model for each column of ``labels``; the threshold is best on out-of-fold rows."""
    before = np.empty((len(rows), 0))
    models, held = [], np.zeros(len(rows))
    for at in range(len(categories)):
        held = np.zeros(len(rows))
        for fold in range(FOLDS):
            inside, outside = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            part = fit_linear([rows[i] for i in inside], before[inside], labels[inside, at])
            held[outside] = scores(part, [rows[i] for i in outside], before[outside])
        models.append(fit_linear(rows, before, labels[:, at]))
        before = np.column_stack([before, np.clip(held, -10, 10)])
    return Chain(categories, models, best_threshold(held, labels[:, -1]) if len(rows) else 0.5)


def best_threshold(odds: np.ndarray, label: np.ndarray) -> float:
    """The probability that parts the labels best, half way (in log odds) between its neighbours.

    It stays from 0.3 to 0.7: beyond, it would rest on a few rows.
    """
    order = np.argsort(odds, kind="stable")
    odds, label = odds[order], label[order]
    right = np.concatenate([[0], np.cumsum(1 - label)]) + np.concatenate(
        [np.cumsum(label[::-1])[::-1], [0]]
    )
    edges = np.concatenate([odds[:1] - 1, odds, odds[-1:] + 1])
    middle = (edges[1:] + edges[:-1]) / 2
    best = np.flatnonzero(right == right.max())
    return float(np.clip(_sigmoid(middle[best[len(best) // 2]]), 0.3, 0.7))


def train(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample_rows: int = 6000
) -> Chain:
    """A chain over ``categories`` (name to an SQL condition on ``labels``), in order.

    Rows without doc_id, or whose document is missing, or for which a category is unknown
    are left out. Without any row no text is toxic.
    """
    names = list(categories)
    known = labels.select("doc_id", *[F.expr(c).cast("double").alias(f"_{n}") for n, c in categories.items()])
    chosen = known.dropna().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                part = batch.slice(first, len(texts))
                found = pa.array([features_of(t) for t in texts], pa.list_(pa.int32()))
                columns = [part.column("doc_id"), found, *(part.column(f"_{n}") for n in names)]
                yield pa.record_batch(columns, ["doc_id", "found", *(f"_{n}" for n in names)])

    kinds = ", ".join(f"_{n} double" for n in names)
    # The sample is bounded by sample_rows, so it can go to every task and come back. It
    # comes as Arrow, whose lists are read where they lie: as Python numbers they are large.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .mapInArrow(run, f"doc_id bigint, found array<int>, {kinds}")
        .toArrow()
    )
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    folds = np.array([xxhash.xxh32_intdigest(str(i)) % FOLDS for i in rows["doc_id"].to_numpy()[order]], int)
    lists = [r.values.to_numpy(zero_copy_only=False) for r in rows["found"]]
    labels = np.array([rows[f"_{n}"].to_numpy() for n in names]).T[order]
    return fit_chain([lists[i] for i in order], labels, folds, names)


LONGEST = 64  # characters of a word that is kept in the table
ENTRY = 200  # bytes an entry takes beside its characters and features


class Scorer:
    """Log odds of texts; the table of words is bounded in bytes.

    Longer words, as of texts without white space, are looked through each time.
    """

    def __init__(self, chain: Chain, table_bytes: int = 96 << 20):
        self.chain, self.table_bytes, self.held = chain, table_bytes, 0
        self.known = set().union(*(m.weights for m in chain.models))
        self.table: dict[str, tuple[int, ...]] = {}

    def log_odds(self, text: str) -> list[float]:
        found: set[int] = set()
        table = self.table
        for part in set(text.lower().split()):
            features = table.get(part)
            if features is None:
                features = {f for w in LETTERS.findall(part) for f in features_of_word(w)}
                features = tuple(features & self.known)
                if len(part) <= LONGEST:
                    size = ENTRY + 4 * len(part) + 40 * len(features)
                    if self.held + size > self.table_bytes:
                        table.clear()
                        self.held = 0
                    self.held += size
                    table[part] = features
            if features:
                found.update(features)
        before: list[float] = []
        for model in self.chain.models:
            before.append(max(-10.0, min(10.0, model.log_odds(sorted(found), before))))
        return before


def judge(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with p_<category> for each category and ``toxic``.

    ``toxic`` is the last category's probability at the chain's threshold. A missing or
    empty text has the probabilities of a text without known words. Repeated rows get the
    same answer. Columns of ``docs`` with these names are replaced; no rows give no rows.
    """
    added = [f"p_{c}" for c in chain.categories]
    names = [c for c in docs.columns if c not in (*added, "toxic")]
    plain = docs.select(*names)
    schema = plain.limit(0).select("*", *[F.lit(0.0).alias(a) for a in added], F.lit(True).alias("toxic")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(chain)
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                odds = np.array([scorer.log_odds(t) for t in texts])
                probability = 1 / (1 + np.exp(-odds))
                part = batch.slice(first, len(texts))
                columns = [*part.columns, *probability.T, probability[:, -1] >= chain.threshold]
                yield pa.record_batch(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                    [*names, *added, "toxic"],
                )

    return plain.mapInArrow(run, schema)
