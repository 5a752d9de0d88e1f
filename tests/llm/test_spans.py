"""Repeated sentence runs against a version with its own way of finding sentences."""

import random

from gaugeline.llm import spans

SCHEMA = "doc_id bigint, text string, n_removed int, row string"


def split(text):
    """Sentences character by character: after . ! ? … and blanks, and at line ends."""
    found, start, at = [], 0, 0
    while at < len(text):
        if text[at] == "\n" or (text[at] in " \t" and at and text[at - 1] in ".!?…"):
            end = at
            while at < len(text) and text[at] in " \t\n":
                at += 1
            found.append((start, end, at))
            start = at
        else:
            at += 1
    found.append((start, len(text), len(text)))
    return [(s, n, tuple(text[s:e].lower().split())) for s, e, n in found if text[s:e].split()]


def brute(texts):
    """Texts (in order of identifier) without the sentences of non-first runs of three."""
    seen, results = set(), []
    for text in texts:
        parts, gone = split(text), set()
        for at in range(len(parts)):
            end = at + 3
            while end <= len(parts) and sum(len(w) for *_, w in parts[at:end]) < 20:
                end += 1
            if end > len(parts):
                break
            run = tuple(w for *_, w in parts[at:end])
            gone |= set(range(at, end)) if run in seen else set()
            seen.add(run)
        kept = "".join(text[s:n] for k, (s, n, _) in enumerate(parts) if k not in gone)
        results.append((kept.rstrip() if len(parts) - 1 in gone else kept, len(gone)))
    return results


def removed(spark, texts):
    docs = spark.createDataFrame([(i, t, 5, "r") for i, t in enumerate(texts)], SCHEMA)
    rows = spans.remove_repeats(docs.drop("n_removed")).orderBy("doc_id").collect()
    return [(r.text, r.n_removed) for r in rows]


def test_sentences_of_any_length_stay_whole(spark):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(400)]

    def sentence(most=24):
        return " ".join(draw.choices(words, k=draw.randint(1, most))) + draw.choice(".!?")

    passages = [" ".join(sentence() for _ in range(draw.randint(3, 8))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = [sentence() for _ in range(draw.randint(0, 6))] + draw.choices(passages, k=draw.randint(0, 2))
        draw.shuffle(parts)
        texts.append(draw.choice([" ", "\n"]).join(parts))
    texts = [t for t in texts if t]
    expected = brute(texts)
    assert sum(n for _, n in expected) > 100
    assert removed(spark, texts) == expected


def test_one_sentence_is_not_a_run(spark):
    """A long sentence that many documents share stays, however many words it has up to the limit."""
    shared = "the quick brown fox jumps over the lazy dog near the river bank while seventeen small birds sing quietly in the old trees."
    texts = [f"This is text number {i}. {shared} It ends with {i * 7}." for i in range(8)]
    assert removed(spark, texts) == [(t, 0) for t in texts]


def test_text_without_sentence_ends(spark):
    draw = random.Random(9)
    passage = " ".join(f"item{draw.randrange(10**6)}" for _ in range(120))
    texts = [passage, "other words here " * 3 + passage]
    found = removed(spark, texts)
    assert found[0] == (passage, 0)
    assert found[1][1] > 5 and len(found[1][0].split()) < 40


def test_a_run_met_very_often(spark):
    """One passage in all documents; it stays in the first."""
    passage = "one common sentence stands here for good. another common sentence follows it in turn. a third and last one ends the whole passage."
    texts = [f"start {i} is here. {passage} end {i} is there." for i in range(300)]
    found = removed(spark, texts)
    assert found[0][1] == 0 and all(n == 3 for _, n in found[1:])
