"""The recurrent network's output layer against plain softmax and finite differences."""

import numpy as np
import pytest

from gaugeline.llm import recurrent

SHAPE = recurrent.Shape(rows=9, classes=5, worded=3, words=4)


def network(seed):
    roll = np.random.default_rng(seed)
    return recurrent.Network(SHAPE, roll.standard_normal(SHAPE.size()).astype(np.float32) * 0.5)


def plain(net, states, classes, words):
    soft = lambda s: s - np.log(np.exp(s).sum())
    out = []
    for h, c, w in zip(states.astype(float), classes, words):
        told = soft(h @ net.to_class + net.class_bias)[c]
        out.append(told + (soft(h @ net.to_word[c] + net.word_bias[c])[w] if c < SHAPE.worded else 0))
    return np.array(out)


@pytest.mark.parametrize("count", [1, 7, 40, 200])
def test_log_probabilities_and_gradients(count):
    """Classes of no token, of part of a block, of a block and of several."""
    roll, net = np.random.default_rng(count), network(3)
    states = roll.standard_normal((count, recurrent.HIDDEN)).astype(np.float32)
    classes = roll.choice([0, 2, 3, 4], count, p=[0.8, 0.1, 0.05, 0.05])
    words = roll.integers(0, SHAPE.words, count)
    grad = recurrent.Network(SHAPE, np.zeros(SHAPE.size(), np.float32))
    found, pull = net.predict(states, classes, words, grad)
    assert found == pytest.approx(plain(net, states, classes, words), abs=1e-4)
    step = 1e-3
    for name in ("to_class", "class_bias", "to_word", "word_bias"):
        weights, slopes = getattr(net, name).reshape(-1), getattr(grad, name).reshape(-1)
        for at in range(len(weights)):
            kept, ends = weights[at], []
            for move in (step, -step):
                weights[at] = kept + move
                ends.append(plain(net, states, classes, words).sum())
            weights[at] = kept
            assert -(ends[0] - ends[1]) / (2 * step) == pytest.approx(slopes[at], abs=2e-2, rel=2e-2)
    for at in range(recurrent.HIDDEN):
        moved = [states.copy(), states.copy()]
        moved[0][:, at] += step
        moved[1][:, at] -= step
        up, down = (plain(net, m, classes, words) for m in moved)
        assert -(up - down) / (2 * step) == pytest.approx(pull[:, at], abs=2e-2)


def test_no_tokens_of_worded_classes():
    net = network(1)
    states = np.ones((3, recurrent.HIDDEN), np.float32)
    classes, words = np.array([3, 4, 4]), np.zeros(3, int)
    grad = recurrent.Network(SHAPE, np.zeros(SHAPE.size(), np.float32))
    found, _ = net.predict(states, classes, words, grad)
    assert found == pytest.approx(plain(net, states, classes, words), abs=1e-4)
    assert not grad.to_word.any()
