"""Odd rows and empty tables through every operator."""

import public_tokenizers
import pytest

from gaugeline.llm import bpe, extraction, lm, packing, quality, simhash, spans
from gaugeline.llm import spotsigs, stages, toxicity

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
NO_CHAIN = toxicity.Chain(["toxic"], [toxicity.Linear(-3.0, {}, [])], 0.5)


def judged(docs):
    return toxicity.judge(docs, NO_CHAIN)


PER_ROW = {
    "encode": lambda d: bpe.encode(d, BYTE),
    "quality": quality.judge,
    "toxicity": judged,
    "simhash": simhash.near_duplicates,
    "spots": spotsigs.near_duplicates,
    "edited": spotsigs.edited,
    "lm": lambda d: lm.score_corpus(d, warm_docs=5, table=50),
    "spans": spans.remove_repeats,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(name, odd_documents):
    found = PER_ROW[name](odd_documents).collect()
    ids = sorted((r["doc_id"] or 0) for r in found)
    assert ids == sorted((r["doc_id"] or 0) for r in odd_documents.collect())


@pytest.mark.parametrize("name", PER_ROW)
def test_no_rows(name, no_documents):
    assert PER_ROW[name](no_documents).count() == 0


def test_packing_covers_every_row(odd_documents, no_documents):
    found = packing.pack(odd_documents, WORD, capacity=64).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    assert sum(1 for r in found if r["doc_id"] is None and r["piece"] == 0) == 2
    assert [r["length"] for r in found if r["doc_id"] == 2] == [1]
    assert packing.pack(no_documents, WORD).count() == 0


def test_quality_of_odd_rows(odd_documents):
    rows = {r["doc_id"]: r for r in quality.judge(odd_documents).collect() if r["doc_id"]}
    assert (rows[2]["n_words"], rows[3]["n_words"], rows[4]["n_words"]) == (0, 0, 0)
    assert not rows[2]["kept"] and rows[7]["n_words"] == 1
    cleaned = quality.clean(odd_documents, min_words=1, max_repeat_percent=100)
    assert cleaned.columns == odd_documents.columns
    assert sorted(r["doc_id"] for r in cleaned.where("doc_id is not null").collect()) == [1, 1, 5, 6, 7, 8]


def test_simhash_of_odd_rows(odd_documents):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(odd_documents).collect()}
    assert {rows[i]["fingerprint"] for i in (2, 3, 4)} == {"0" * 16}
    assert {rows[i]["component_id"] for i in (2, 3, 4)} == {2}
    assert rows[6]["component_id"] == 5


def test_keep_one_loses_no_text(odd_documents, no_documents):
    kept = simhash.keep_one(odd_documents, simhash.near_duplicates(odd_documents)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 2, 5, 7, 8]
    assert sum(r["doc_id"] is None for r in kept) == 2
    assert simhash.keep_one(no_documents, simhash.near_duplicates(no_documents)).count() == 0


def test_spans_of_odd_rows(odd_documents):
    rows = {r["doc_id"]: r for r in spans.remove_repeats(odd_documents).collect()}
    assert rows[2]["text"] is None and rows[3]["text"] == ""
    assert rows[6]["text"] == "" and rows[5]["n_removed"] > 0
    assert rows[1]["n_removed"] == 0


def test_pages_of_any_kind(spark):
    schema = "page_id bigint, url string, html string, text string"
    rows = [(1, None, None, "t"), (2, "u", "", None), (None, "u", "plain < words", None), (3, "u", "<p>a</p>" * 9000, None), (3, "u", "<p>a</p>", None), (4, "u", "<div><p>not closed <b>x", None)]
    pages = spark.createDataFrame(rows, schema)
    model = extraction.train(pages)
    found = {r["page_id"]: r["text"] for r in extraction.extract(pages, model).collect() if r["page_id"] != 3}
    assert found == {1: "", 2: "", None: "plain < words", 4: "not closed x"}
    assert extraction.extract(spark.createDataFrame([], schema), model).count() == 0


def test_training_pages_are_drawn_among_different_ones(spark):
    """One page repeated very often leaves the others in the draw."""
    one = "<nav><a>home</a><a>about us</a></nav><article><p>{}</p><p>{}</p></article><footer>all rights reserved</footer>"
    texts = [(f"Story number {i} begins here, with words.", f"It goes on for {i * 3} lines and ends.") for i in range(40)]
    rows = [(i, "u", one.format(*text)) for i, text in enumerate(texts)]
    rows += [(100 + i, "u", one.format("The same page once more.", "It is always the same.")) for i in range(3_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    model = extraction.train(pages)
    found = {r["page_id"]: r["text"] for r in extraction.extract(pages.where("page_id < 40"), model).collect()}
    assert found == {i: " ".join(text) for i, text in enumerate(texts)}


def test_chain_without_labels(spark, odd_documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    chain = toxicity.train(odd_documents, labels, stages.CATEGORIES)
    assert not any(r["toxic"] for r in toxicity.judge(odd_documents, chain).collect())


def test_footer_of_three_lines_is_frequent(spark):
    """In fixed order its inner lines have one surrounding in all documents; copies count once."""
    footer = "imprint and contact\nall rights reserved here\nterms of use"
    rows = [(i, f"text number {i} " + f"own{i} " * 9 + "\n" + footer, "h") for i in range(30)]
    rows += [(100 + i, "copied first line\ncopied second line", "h") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = {r["doc_id"]: r for r in quality.judge(docs, min_words=1).collect()}
    lines = {quality.line_hash(line.encode()) for line in footer.split("\n")}
    assert all(set(judged[i]["removed"]) == lines for i in range(30))
    assert all(judged[100 + i]["removed"] is None for i in range(30))


def test_copies_move_no_limit_of_line_frequency(spark):
    """A footer of 30 texts stays furniture beside 4,000 copies of another text of the host."""
    footer = "imprint and contact\nall rights reserved here\nterms of use"
    rows = [(i, f"text number {i} " + f"own{i} " * 9 + "\n" + footer, "h") for i in range(30)]
    rows += [(100 + i, "copied first line\ncopied second line", "h") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = quality.judge(docs, min_words=1).where("doc_id < 30").collect()
    assert len(judged) == 30 and all(len(r["removed"]) == 3 for r in judged)


@pytest.mark.parametrize("tag", ['<svg class="i"/>', '<svg class="i">', "<select><option>a", "<template>", "<noscript>"])
@pytest.mark.parametrize("later", ["", "<footer><svg><path/></svg></footer>"])
def test_an_element_left_open_leaves_the_article(tag, later):
    page = f"<header>{tag}</header><article><p>First text.</p><p>Second text.</p></article>{later}"
    assert [b.text for b in extraction.blocks(page)] == ["First text.", "Second text."]
    closed = "<p>One</p><template><div>no</div></template><svg><path/><title>no</title></svg><p>Two</p>"
    assert [b.text for b in extraction.blocks(closed)] == ["One", "Two"]
