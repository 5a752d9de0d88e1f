"""A small gated recurrent network in numpy with a class-factored output.

A token is predicted from the state the tokens before it left: first its class, then, in
the classes whose words have weights of their own, the word. What other classes know of
their words is no matter of the network. Many texts run side by side, each in a lane; a
window is a number of steps of all lanes. The state is carried from window to window, and
gradients stop at a window's start.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
WINDOW = 16
# Tokens of one class that are multiplied together; a class's last block is filled up.
BLOCK = 24


@dataclass
class Shape:
    """Input rows, classes, and the first ``worded`` classes of ``words`` words each."""

    rows: int
    classes: int
    worded: int
    words: int

    def parts(self) -> list[tuple[str, tuple[int, ...]]]:
        return [
            ("inputs", (self.rows, 3 * HIDDEN)),
            ("state", (HIDDEN, 3 * HIDDEN)),
            ("to_class", (HIDDEN, self.classes)),
            ("class_bias", (self.classes,)),
            ("to_word", (self.worded, HIDDEN, self.words)),
            ("word_bias", (self.worded, self.words)),
        ]

    def size(self) -> int:
        return sum(int(np.prod(shape)) for _, shape in self.parts())


def _sigmoid(x: np.ndarray) -> None:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


class Network:
    """Views of one flat vector of weights."""

    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat, at = shape, flat, 0
        for name, dims in shape.parts():
            size = int(np.prod(dims))
            setattr(self, name, flat[at : at + size].reshape(dims))
            at += size

    @classmethod
    def fresh(cls, shape: Shape, class_share: np.ndarray, seed: int = 1) -> Network:
        """Small random weights; classes start at their share of the corpus."""
        roll = np.random.default_rng(seed)
        made = cls(shape, (roll.standard_normal(shape.size()) * 0.1).astype(np.float32))
        made.class_bias[:] = np.log(np.maximum(class_share, 1e-9))
        made.word_bias[:] = 0
        return made

    def run(self, rows: np.ndarray, keep: np.ndarray, h: np.ndarray) -> tuple:
        """States before each of the window's tokens, what training needs, and the last state."""
        steps = len(rows)
        before = np.empty((steps, *h.shape), np.float32)
        updates, resets, news, pulled = (np.empty_like(before) for _ in range(4))
        given = self.inputs[rows]
        for t in range(steps):
            h = h * keep[t, :, None]
            before[t] = h
            pull = h @ self.state
            z, r, fresh = updates[t], resets[t], news[t]
            np.add(given[t, :, :HIDDEN], pull[:, :HIDDEN], out=z)
            np.add(given[t, :, HIDDEN : 2 * HIDDEN], pull[:, HIDDEN : 2 * HIDDEN], out=r)
            _sigmoid(z)
            _sigmoid(r)
            pulled[t] = pull[:, 2 * HIDDEN :]
            np.multiply(r, pulled[t], out=fresh)
            fresh += given[t, :, 2 * HIDDEN :]
            np.tanh(fresh, out=fresh)
            change = fresh - h
            change *= z
            h += change
        return before, (updates, resets, news, pulled), h

    def wild(self) -> bool:
        """Whether a score could overflow; states lie between -1 and 1."""
        classes = np.abs(self.to_class).sum(0) + self.class_bias
        words = np.abs(self.to_word).sum(1) + self.word_bias
        return max(classes.max(initial=0), words.max(initial=0)) > 60

    def predict(
        self,
        states: np.ndarray,
        classes: np.ndarray,
        words: np.ndarray,
        grad: Network | None,
        wild: bool | None = None,
    ):
        """Natural log probability of each token; with ``grad`` also the gradient of the states.

        ``words`` is a place within the class, unused for classes without words.
        """
        n = np.arange(len(states))
        score = states @ self.to_class
        score += self.class_bias
        if wild is None:
            wild = self.wild()
        if wild:
            score -= score.max(1, keepdims=True)
        out = score[n, classes]
        exp = np.exp(score, out=score)
        total = exp.sum(1)
        out -= np.log(total)
        pull = None
        if grad is not None:
            wrong = exp
            wrong /= total[:, None]
            wrong[n, classes] -= 1
            grad.to_class += states.T @ wrong
            grad.class_bias += wrong.sum(0)
            pull = wrong @ self.to_class.T
        self._predict_words(states, classes, words, grad, wild, out, pull)
        return out, pull

    def _predict_words(self, states, classes, words, grad, wild, out, pull) -> None:
        """Adds the words' part to ``out`` and ``pull``, by blocks of tokens of one class."""
        order = np.argsort(classes, kind="stable")
        ends = np.searchsorted(classes[order], np.arange(self.shape.worded + 1))
        counts = np.diff(ends)
        rows = order[: ends[-1]]
        if not len(rows):
            return
        blocks = -(-counts // BLOCK)
        first = np.cumsum(blocks) - blocks
        of_block = np.repeat(np.arange(self.shape.worded), blocks)
        slot = np.arange(len(rows)) + np.repeat(first * BLOCK - ends[:-1], counts)
        own = np.zeros((len(of_block) * BLOCK, HIDDEN), np.float32)
        own[slot] = states[rows]
        own = own.reshape(-1, BLOCK, HIDDEN)
        weights = self.to_word[of_block]
        score = own @ weights
        score += self.word_bias[of_block, None, :]
        score = score.reshape(-1, self.shape.words)
        if wild:
            score -= score.max(1, keepdims=True)
        told = score[slot, words[rows]]
        exp = np.exp(score, out=score)
        total = exp.sum(1)
        out[rows] += told - np.log(total[slot])
        if grad is None:
            return
        # Rows that only fill a block up get no weight.
        share = np.zeros_like(total)
        share[slot] = 1 / total[slot]
        exp *= share[:, None]
        exp[slot, words[rows]] -= 1
        met = np.flatnonzero(counts)
        tokens = own.reshape(-1, HIDDEN)
        for c in met.tolist():
            part = slice(first[c] * BLOCK, (first[c] + blocks[c]) * BLOCK)
            grad.to_word[c] += tokens[part].T @ exp[part]
        exp = exp.reshape(-1, BLOCK, self.shape.words)
        grad.word_bias[met] += np.add.reduceat(exp.sum(1), first[met])
        pull[rows] += (exp @ weights.transpose(0, 2, 1)).reshape(-1, HIDDEN)[slot]

    def back(self, rows, keep, before, gates, pull, grad: Network) -> None:
        """Gradients of a window, from those of its states."""
        carried = np.zeros(before.shape[1:], np.float32)
        given = np.empty((*rows.shape, 3 * HIDDEN), np.float32)
        pulls = np.empty_like(given)
        updates, resets, news, pulled = gates
        # Slopes that do not depend on what is carried back.
        rests = 1 - updates
        by_update = (news - before) * updates * rests
        by_fresh = updates * (1 - news * news)
        by_reset = pulled * resets * (1 - resets)
        back_to_state = np.ascontiguousarray(self.state.T)
        for t in range(len(rows) - 1, -1, -1):
            to_fresh = carried * by_fresh[t]
            given[t, :, :HIDDEN] = carried * by_update[t]
            given[t, :, HIDDEN : 2 * HIDDEN] = to_fresh * by_reset[t]
            given[t, :, 2 * HIDDEN :] = to_fresh
            pulls[t, :, : 2 * HIDDEN] = given[t, :, : 2 * HIDDEN]
            pulls[t, :, 2 * HIDDEN :] = to_fresh * resets[t]
            carried *= rests[t]
            carried += pulls[t] @ back_to_state
            carried += pull[t]
            carried *= keep[t, :, None]
        grad.state += before.reshape(-1, HIDDEN).T @ pulls.reshape(-1, 3 * HIDDEN)
        flat = rows.ravel()
        order = np.argsort(flat, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) != 0]))
        sums = np.add.reduceat(given.reshape(-1, 3 * HIDDEN)[order], starts)
        grad.inputs[flat[order][starts]] += sums


def lanes(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Texts dealt to lanes of about equal length, the longest first."""
    count = int(np.clip(lengths.sum() // max(1, lengths.max()), 1, most))
    heap = [(0, lane) for lane in range(count)]
    dealt: list[list[int]] = [[] for _ in range(count)]
    for text in np.argsort(-lengths, kind="stable").tolist():
        used, lane = heapq.heappop(heap)
        dealt[lane].append(text)
        heapq.heappush(heap, (used + int(lengths[text]), lane))
    return dealt


def windows(texts: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, keep, owner) of each window, steps by lanes; owner -1 where a lane has ended.

    ``keep`` is 0 where a text starts, so it starts without state.
    """
    lengths = np.array([len(t) for t in texts])
    dealt = lanes(lengths, most)
    steps = max(int(lengths[lane].sum()) for lane in dealt)
    steps += -steps % WINDOW
    tokens = np.zeros((steps, len(dealt)), np.int32)
    owner = np.full((steps, len(dealt)), -1, np.int32)
    keep = np.ones((steps, len(dealt)), np.float32)
    for lane, own in enumerate(dealt):
        at = 0
        for text in own:
            end = at + len(texts[text])
            tokens[at:end, lane] = texts[text]
            owner[at:end, lane] = text
            keep[at, lane] = 0
            at = end
    for at in range(0, steps, WINDOW):
        cut = slice(at, at + WINDOW)
        yield tokens[cut], keep[cut], owner[cut]


class Adam:
    def __init__(self, size: int, rate: float):
        self.first, self.second, self.room = (np.zeros(size, np.float32) for _ in range(3))
        self.rate, self.step = rate, 0

    def move(self, flat: np.ndarray, gradient: np.ndarray) -> None:
        self.step += 1
        room = np.subtract(gradient, self.first, out=self.room)
        room *= 0.1
        self.first += room
        np.multiply(gradient, gradient, out=room)
        room -= self.second
        room *= 0.01
        self.second += room
        np.divide(self.second, 1 - 0.99**self.step, out=room)
        np.sqrt(room, out=room)
        room += 1e-6
        np.divide(self.first, room, out=room)
        room *= self.rate / (1 - 0.9**self.step)
        flat -= room


def train(net: Network, texts: list[np.ndarray], codes: Codes, adam: Adam, most: int = 128) -> int:
    """One pass over ``texts`` (token codes); the number of tokens."""
    grad = Network(net.shape, np.zeros_like(net.flat))
    h, done = None, 0
    for tokens, keep, owner in windows(texts, most):
        if h is None:
            h = np.zeros((tokens.shape[1], HIDDEN), np.float32)
        rows = codes.row[tokens]
        before, gates, h = net.run(rows, keep, h)
        real = owner >= 0
        count = int(real.sum())
        grad.flat[:] = 0
        pull = np.zeros_like(before)
        told = tokens[real]
        _, pull[real] = net.predict(before[real], codes.group[told], codes.place[told], grad)
        net.back(rows, keep, before, gates, pull, grad)
        grad.flat /= count
        adam.move(net.flat, np.clip(grad.flat, -0.1, 0.1, out=grad.flat))
        done += count
    return done


def score(net: Network, texts: list[np.ndarray], codes: Codes, most: int = 512) -> np.ndarray:
    """Natural log probability of each text, less what its codes add by themselves."""
    total, wild = np.zeros(len(texts)), net.wild()
    h = None
    for tokens, keep, owner in windows(texts, most):
        if h is None:
            h = np.zeros((tokens.shape[1], HIDDEN), np.float32)
        before, _, h = net.run(codes.row[tokens], keep, h)
        real = owner >= 0
        told = tokens[real]
        found, _ = net.predict(before[real], codes.group[told], codes.place[told], None, wild)
        total += np.bincount(owner[real], found.astype(np.float64), len(texts))
    return total


@dataclass
class Codes:
    """Of each token code: its input row, its class and its place there."""

    row: np.ndarray
    group: np.ndarray
    place: np.ndarray
