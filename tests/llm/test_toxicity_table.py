import random
import tracemalloc

import numpy as np

from gaugeline.llm import toxicity


def test_scores_do_not_depend_on_the_table_and_it_is_bounded():
    """Words with blanks between them and texts without any; a small table is cleared often."""
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij漢字") for _ in range(rnd.randrange(1, 12))) for _ in range(3000)]
    weights = {f: rnd.uniform(-1, 1) for w in words[::3] for f in toxicity.features_of_word(w)}
    first = toxicity.Linear(0.1, weights, [])
    second = toxicity.Linear(-0.2, {f: -x for f, x in weights.items()}, [0.5])
    chain = toxicity.Chain(["low", "toxic"], [first, second], 0.5)
    large, small = toxicity.Scorer(chain), toxicity.Scorer(chain, 20_000)
    for _ in range(200):
        blank = rnd.choice([" ", "\n", "", "、"])
        text = blank.join(rnd.choices(words, k=rnd.randrange(120)))
        found = {f for w in toxicity.words_of(text) for f in toxicity.features_of_word(w)} & set(weights)
        expected = []
        for model in chain.models:
            expected.append(max(-10.0, min(10.0, model.log_odds(sorted(found), expected))))
        assert large.log_odds(text) == small.log_odds(text) == expected
        kept = sum(toxicity.ENTRY + 4 * len(k) + 40 * len(v) for k, v in small.table.items())
        assert kept == small.held <= 20_000
        assert all(len(k) <= toxicity.LONGEST for k in small.table)


def test_training_holds_little_beside_its_rows():
    """Eight million cells: no sort and no wide copy of all of them, and the telling features are kept."""
    roll = np.random.default_rng(3)
    labels = (np.arange(4_000) % 4 == 0).astype(float)
    rows = [np.sort(roll.integers(10, 400_000, 2_000).astype(np.int32)) for _ in labels]
    rows = [np.concatenate([np.int32([3] if label else [5]), r]) for r, label in zip(rows, labels)]
    tracemalloc.start()
    model = toxicity.fit_linear(rows, np.empty((4_000, 0)), labels, steps=5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights[3] > 0 > model.weights[5]
    assert most < 240 << 20
