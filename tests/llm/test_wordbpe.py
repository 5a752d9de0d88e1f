import random

import numpy as np
import public_tokenizers
import pytest

from gaugeline.llm import wordbpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SPACES = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c", "\x1c", "\x85", "\u00a0", "\u2003", "\u3000"]
WORDS = [
    "plain", "Plain,", "it's", "WE'LL", "x1y22", "naïve", "e\u0301tude", "\u0301", "\u0130stanbul", "ΣΑΣ",
    "漢字かな", "한국어", "🙂🙂", "...", "#$%", "<|endoftext|>", "<|startoftext|>x", "\u200b", "'s", "ﬁne", "ß",
]


@pytest.fixture(scope="module")
def library():
    return wordbpe.load(PATH)


def ids(encoded):
    return np.frombuffer(encoded, "<u4").tolist()


def test_ids_are_those_of_the_library(library):
    """Words parted by any white space, or by none; a small table is cleared many times."""
    rnd = random.Random(4)
    for encoder in (wordbpe.WordEncoder(PATH), wordbpe.WordEncoder(PATH, 4_000)):
        for _ in range(400):
            text = "".join(rnd.choice(WORDS) + rnd.choice([*SPACES, ""]) for _ in range(rnd.randrange(30)))
            assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert ids(encoder.encode("")) == []


@pytest.mark.parametrize("blank", ["\n", "", " "])
def test_table_is_bounded_in_bytes(library, blank):
    """Texts of lines, without any blank, and of very many words keep it small."""
    most = 200_000
    encoder = wordbpe.WordEncoder(PATH, most)
    rnd = random.Random(6)
    for _ in range(60):
        text = blank.join(f"{rnd.choice(WORDS)}{rnd.randrange(10**9)}" for _ in range(300))
        assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
        kept = sum(4 * len(k) + len(v) + wordbpe.ENTRY for k, v in encoder.table.items())
        assert kept == encoder.held <= most
        assert all(len(k) <= wordbpe.LONGEST for k in encoder.table)
