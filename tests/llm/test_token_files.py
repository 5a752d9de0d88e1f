"""Token files against the tokenizers library; metadata; lookups."""

import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

import __spark_entry__ as entry
from gaugeline.llm import token_files
from gaugeline.session import scratch_dir

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(BYTE)
    found.no_truncation()
    found.no_padding()
    return lambda text: found.encode(text, add_special_tokens=False).ids


def expected(rows, library):
    found, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library(text or ""), 0], "<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def by_key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def test_query(spark, documents, library):
    found = entry.queries()["op13_token_files"](spark, entry.SMOKE_DIR)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, library)


def test_batches_equal_the_library(library):
    """Every kind of meeting of chunks, blanks, white space and special tokens."""
    draw = random.Random(3)
    bits = ["a", "b", " ", " ", "\n", "\t", "'s", "1", ",", "é", "<|endoftext|>", " ", " ", "\x0b", "\x1c", "日", "🙂"]
    texts = ["".join(draw.choices(bits, k=draw.randint(0, 14))) for _ in range(2000)]
    texts += ["", " ", "a  b", "word " * 3000, "x" * 40_000, "a \n b"]
    ids, ends = token_files.BatchEncoder(BYTE).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [library(t) for t in texts]


def test_odd_rows(spark, odd_documents, no_documents, library, monkeypatch):
    path = scratch_dir(spark, "token-files")
    token_files.write(odd_documents, path, BYTE)
    found = sorted((tuple(r) for r in token_files.checksums(token_files.read(spark, path)).collect()), key=by_key)
    lengths = sorted((r.doc_id, len(library(r.text or "")) + 1) for r in odd_documents.collect() if r.doc_id)
    assert sorted((i, n) for i, _, n, _ in found if i) == lengths
    start = 0
    for _, at, n, _ in sorted(found, key=lambda r: r[1]):
        assert at == start
        start += n
    assert [r[0] for r in sorted(found, key=lambda r: r[1])] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    empty = scratch_dir(spark, "token-files")
    token_files.write(no_documents, empty, BYTE)
    assert token_files.read(spark, empty).count() == 0


def test_readers_skip_by_metadata(spark):
    """Several stripes a file; a lookup reads a few row groups of all the rows."""
    path = scratch_dir(spark, "token-files")
    rows = spark.range(20_000).selectExpr("2 * id as doc_id", "repeat(concat('w', id, ' '), 50) as text")
    token_files.write(rows.coalesce(1), path, BYTE, stripe_bytes=1 << 16)
    files = [orc.ORCFile(str(p)) for p in Path(path).glob("*.orc")]
    assert sum(f.nrows for f in files) == 20_000 and max(f.nstripes for f in files) > 1
    assert all(f.nstripes > 1 for f in files if f.nrows > 5_000)

    def read_rows(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))

    files = spark.read.schema(token_files.SCHEMA).orc(path).select("doc_id", "n_tokens")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert read_rows(files) == 20_000
        assert 0 < read_rows(files.where("doc_id in (2468, 31000)")) <= 2 * token_files.ROW_STRIDE
        # An odd id lies within every file's range: only Bloom filters tell it is absent.
        assert read_rows(files.where("doc_id = 2469")) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = token_files.lookup(spark, path, [2468, 2469, 31000]).collect()
    assert sorted(r.doc_id for r in found) == [2468, 31000]


def test_a_hot_doc_id_is_dealt_out(spark):
    rows = spark.range(0, 6_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "repeat('same text here ', 60) as text")
    path = scratch_dir(spark, "token-files")
    token_files.write(rows, path, BYTE)
    files = spark.read.schema(token_files.SCHEMA).orc(path)
    found = token_files.read(spark, path).select("start", "n_tokens").orderBy("start").collect()
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    assert files.where("doc_id = 7").select("part").distinct().count() >= files.select("part").distinct().count() // 4
