"""The numbered queries against SQL or brute force on the smallest tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import brute
import oracle
from gaugeline.llm import lm, queries, spans, spotsigs, stages, toxicity

SF = entry.SMOKE_DIR


def rows_of(spark, name):
    return entry.queries()[name](spark, SF).collect()


def tokenizer(name):
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, name):
    found = entry.queries()[name](spark, SF)
    assert oracle.differences(found, oracle.connect(SF), queries.ORACLE_SQL[name]) == []


def test_packing(spark, texts):
    found = rows_of(spark, "op1_best_fit_packing")
    library = tokenizer("word_bpe_49k.json")
    expected = {}
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes()
        for piece, start in enumerate(range(0, len(ids), 8192)):
            part = ids[start : start + 8192]
            expected[doc_id, piece] = (start // 4, len(part) // 4, zlib.crc32(part))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == expected
    held = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == held[r.sequence_id]
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 2048
    assert len(held) <= 1.03 * sum(held.values()) / 2048 + 1


def test_encoding(spark, texts):
    library = tokenizer("byte_bpe_50k.json")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows_of(spark, "op2_bpe_encode_decode"):
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(decoded))


def test_toxicity_on_rows_it_has_not_seen(spark, documents):
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 4 <> 0"), stages.CATEGORIES)
    held = toxicity.judge(docs, chain).drop("text").join(labels.select("doc_id", labels.toxic.alias("truth")), "doc_id")
    held = held.where("doc_id % 4 = 0").collect()
    assert sum(r.toxic == bool(r.truth) for r in held) >= 0.95 * len(held)
    assert not any(r.toxic and not r.truth for r in held)


def test_simhash(spark, texts):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, "op6_simhash_near_dedup")}
    marks = {i: brute.simhash(t) for i, t in texts.items()}
    parts = brute.roots(marks, lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    assert found == {i: (f"{marks[i]:016x}", parts[i]) for i in texts}


def test_extraction_of_marked_articles(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows_of(spark, "op7_html_extraction"):
        inner = re.search(r"(?s)<article>(.*?)(?:</article>|$)", pages[r.page_id])[1]
        plain = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert (r.text, r.n_chars) == (plain, len(plain))


def test_fingerprints(spark, texts):
    anchors = set(spotsigs.ANCHORS)
    order = sorted(texts, reverse=True)
    sets = {i: brute.spots(t, anchors, spotsigs.CHAIN) for i, t in texts.items()}
    found = {r.doc_id: r for r in rows_of(spark, "op8_document_fingerprints")}
    marks = {}
    for at, doc_id in enumerate(order):
        text, after = texts[doc_id], order[(at + 1) % len(order)]
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(brute.jaccard(sets[doc_id], brute.spots(edited, anchors, spotsigs.CHAIN)))
        assert r.near_next == pytest.approx(brute.jaccard(sets[doc_id], sets[after]))
        assert marks.setdefault(text, r.fingerprint) == r.fingerprint


def test_neighbours_over_many_ranges(documents, texts):
    rows = spotsigs.with_next(spotsigs.neighbours(documents, bucket_rows=7), ["text"]).collect()
    order = sorted(texts, reverse=True)
    assert {r.doc_id: r.next_text for r in rows} == {
        i: texts[order[(at + 1) % len(order)]] for at, i in enumerate(order)
    }


def test_spot_links(spark, documents, texts):
    anchors = set(spotsigs.ANCHORS)
    sets = {i: brute.spots(t, anchors, spotsigs.CHAIN) for i, t in texts.items()}
    parts = brute.roots(sets, lambda a, b: brute.jaccard(sets[a], sets[b]) >= 0.8)
    assert {r.doc_id: r.component_id for r in spotsigs.near_duplicates(documents).collect()} == parts


def test_language_model(spark, texts):
    found = rows_of(spark, "op9_lm_scoring")
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter()
    words = {i: t.encode().lower().split() + [b""] for i, t in texts.items()}
    for i, own in words.items():
        if not out[i]:
            counts.update(own)
    n, v = counts.total(), len(counts)
    for r in found:
        own = words[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(own), n)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert r.base_score == pytest.approx(base)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_is_a_distribution(spark):
    """What is left for words never met is no more than the shares of one occurrence each."""
    rows = [(i, "a b c d a b a " + "e" * (i % 12), "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    counts = lm.word_counts(docs)
    known = lm.vocabulary(counts, 4)
    net = lm.fresh_network(known)
    first = np.zeros((1, lm.recurrent.HIDDEN), np.float32)
    codes = np.arange(len(known.codes))
    group, place = known.map.group[codes], known.map.place[codes]
    log, _ = net.predict(np.repeat(first, len(codes), 0), group, place, None)
    total = np.exp(log + known.share[codes]).sum()
    forms = len(known.codes) + np.arange(lm.FORMS)
    log, _ = net.predict(np.repeat(first, lm.FORMS, 0), known.map.group[forms], known.map.place[forms], None)
    assert total + np.exp(log).sum() == pytest.approx(1, abs=1e-4)


def test_repeated_spans(spark, texts):
    gone = brute.repeated_runs(list(texts.items()), spans.sentences, spans.RUN, spans.MIN_WORDS)
    for r in rows_of(spark, "op10_substring_dedup"):
        text = texts[r.doc_id]
        places, _, _ = spans.sentences(text)
        assert r.n_removed == len(gone[r.doc_id])
        left = [text[s:e].split() for k, (s, e) in enumerate(places) if k not in gone[r.doc_id]]
        assert r.text.split() == [w for part in left for w in part]
