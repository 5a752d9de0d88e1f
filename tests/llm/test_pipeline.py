"""The pipeline's stages on the smallest tables, each held against its input."""

import pytest

import __spark_entry__ as entry
import brute
import corpus_pipeline
from gaugeline.llm import quality

SF = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def outputs(spark, documents, tmp_path_factory):
    """Input and rows of each stage, written and read again like in a run."""
    found, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, SF).write.parquet(path)
        found[name] = docs, spark.read.parquet(path)
        docs = found[name][1]
    return found


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_order_and_columns(outputs, documents):
    assert list(outputs) == ["quality rules", "toxicity", "near duplicates", "repeated spans", "packing"]
    for name in list(outputs)[:-1]:
        out = outputs[name][1]
        assert sorted(out.columns) == sorted(documents.columns)
        assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_quality_keeps_what_it_judges_good(outputs):
    before, after = outputs["quality rules"]
    kept = {r["doc_id"]: r["removed"] for r in quality.judge(before).where("kept").collect()}
    texts, left = by_id(before), by_id(after)
    assert set(left) == set(kept)
    for i, removed in kept.items():
        expected = quality.without(texts[i]["text"], set(removed)) if removed else texts[i]["text"]
        assert left[i]["text"] == expected


def test_toxicity_drops_labelled_toxic_documents(outputs, spark):
    before, after = map(by_id, outputs["toxicity"])
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = [i for i in before if i in labels]
    assert sum((i not in after) == bool(labels[i]) for i in known) >= 0.95 * len(known)
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_text_stays(outputs):
    before, after = map(by_id, outputs["near duplicates"])
    texts = [r["text"] for r in after.values()]
    assert len(set(texts)) == len(texts)
    first = {}
    for i in sorted(before):
        first.setdefault(before[i]["text"], i)
    assert set(after) <= set(first.values())
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_group_of_fingerprints_stays(outputs):
    before, after = map(by_id, outputs["near duplicates"])
    marks = {i: brute.simhash(r["text"]) for i, r in before.items()}
    parts = brute.roots(marks, lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    assert set(after) == set(parts.values())


def test_no_passage_is_left_twice(outputs):
    before, after = map(by_id, outputs["repeated spans"])
    assert set(after) <= set(before)
    seen = set()
    for i in sorted(after):
        words = after[i]["text"].lower().split()
        own = {tuple(words[k : k + 50]) for k in range(len(words) - 49)}
        assert not own & seen
        seen |= own


def test_every_document_is_packed(outputs):
    before, after = outputs["packing"]
    assert {r["doc_id"] for r in after.collect()} == set(by_id(before))


def test_run_is_its_stages(spark, outputs):
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], bytes(r["ids"])) for r in found) == sorted(
        (r["doc_id"], r["piece"], bytes(r["ids"])) for r in outputs["packing"][1].collect()
    )
