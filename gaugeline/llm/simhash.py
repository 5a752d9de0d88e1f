"""SimHash near duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Where two fingerprints differ in
at most three bits, one segment differs in at most one, so the two share a signature that
leaves out (wildcards) that bit: 64 signatures a fingerprint find every link by equality.

Only distinct fingerprints are indexed. Rows of one signature are met in sorted order and
linked inside: the links found there are handed on as one star for each connected part,
never as all pairs. A signature with more than ``GROUP`` fingerprints is cut once more, by
the same rule, over the halves of the other segment; what then shares a signature has 18
free bits, so such a group is bounded by construction and walked bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.components import components
from gaugeline.llm.text import lower_words, slices
from gaugeline.session import materialise

RADIUS = 3
GROUP = 1024
SEED = 42

# Bits of each byte value, highest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
BYTE_PLACES = np.arange(8, dtype=np.int64) * 256


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words, blank-joined; a shorter text is one run."""
    text = b" ".join(words)
    if len(words) <= size:
        return [text] if words else []
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[: -size] + 1])
    return [text[s:e] for s, e in zip(starts.tolist(), ends[size - 1 :].tolist())]


def fingerprint(text: str | None, size: int = 3) -> int:
    """Majority bits of the shingles' hashes; zero without words."""
    runs = shingles(lower_words(text), size)
    if not runs:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(r, SEED) for r in runs], ">u8")
    places = hashes.view(np.uint8).reshape(-1, 8) + BYTE_PLACES
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ BITS
    return int.from_bytes(np.packbits(2 * counts.ravel() > len(runs)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp: 64 bits as a signed number) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id")
            for first, texts in slices(batch.column("text")):
                found = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
                yield pa.record_batch(
                    [keys.slice(first, len(texts)), pa.array(found)], ["doc_id", "fp"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def signatures(classes: DataFrame) -> DataFrame:
    """(key, fp): 64 one-wildcard signatures of every fingerprint.

    A key is the number of the left-out bit and the segment's other bits.
    """
    segment = F.when(F.col("v") < 32, F.expr("fp & 4294967295L")).otherwise(
        F.shiftrightunsigned("fp", 32)
    )
    others = F.expr("~shiftleft(1L, v % 32)")
    key = F.shiftleft(F.col("v").cast("bigint"), 32).bitwiseOR(segment.bitwiseAND(others))
    exploded = classes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    return exploded.select(key.alias("key"), "fp")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def star(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each connected part of over one fingerprint: (members, smallest)."""
    left = np.sort(members)
    found = []
    while len(left) > 1:
        part, frontier, left = [left[:1]], left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for block in range(0, len(frontier), 256):
                near |= (distances(frontier[block : block + 256, None], left) <= RADIUS).any(0)
            frontier, left = left[near], left[~near]
            part.append(frontier)
        part = np.concatenate(part)
        if len(part) > 1:
            found.append((part[1:], np.full(len(part) - 1, part[0])))
    return found


def _masks(bits: int) -> np.ndarray:
    """All numbers of ``bits`` bits of which one to three are set."""
    one = np.int64(1) << np.arange(bits)
    two = one[:, None] | one
    return np.setdiff1d((two[:, :, None] | one).ravel(), [0])


def wide_star(members: np.ndarray, free: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """As ``star``, for members that agree outside the bits ``free``; linear in their number."""
    places = np.zeros(len(members), np.int64)
    for at, bit in enumerate(free):
        places |= ((members >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << at
    owner = np.full(1 << len(free), -1)
    order = np.argsort(members)
    owner[places[order]] = order
    masks, found = _masks(len(free)), []
    for first in order:
        if owner[places[first]] < 0:
            continue
        owner[places[first]] = -1
        frontier, part = places[first : first + 1], []
        while len(frontier):
            reached = []
            for block in range(0, len(frontier), 256):
                near = np.unique(frontier[block : block + 256, None] ^ masks)
                near = near[owner[near] >= 0]
                part.append(members[owner[near]])
                owner[near] = -1
                reached.append(near)
            frontier = np.concatenate(reached)
        part = np.concatenate(part) if part else members[:0]
        if len(part):
            found.append((part, np.full(len(part), members[first])))
    return found


def _groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple]:
    """Runs of one key from batches sorted by key, as (keys, members, starts, closed).

    A run longer than ``limit`` comes in several parts, of which only the last is closed.
    """
    keys, members = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        members = np.concatenate([members, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(keys):
            continue
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        if starts[-1]:
            yield keys[: starts[-1]], members[: starts[-1]], starts[:-1], True
        keys, members = keys[starts[-1] :], members[starts[-1] :]
        if len(keys) > limit:
            yield keys, members, np.zeros(1, np.int64), False
            keys, members = keys[:0], members[:0]
    if len(keys):
        yield keys, members, np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), True


def finer(key: int, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Second signatures of one group: 32 for the halves of the segment the key leaves out."""
    other = np.uint64(32 if key >> 32 < 32 else 0)
    value = (members >> other) & np.uint64(0xFFFFFFFF)
    keys = []
    for v in range(32):
        half = (value >> np.uint64(16 * (v // 16))) & np.uint64(0xFFFF & ~0)
        half &= np.uint64(0xFFFF & ~(1 << v % 16))
        keys.append((np.int64(key) << np.int64(21)) | np.int64(v << 16) | half.astype(np.int64))
    return np.concatenate(keys), np.tile(members, 32)


def free_bits(key: int) -> list[int]:
    """Bits in which members of a second signature may differ."""
    first, v = key >> 21, (key >> 16) & 31
    bit, base = first >> 32, 32 if first >> 32 < 32 else 0
    other = range(base + 16 * (1 - v // 16), base + 16 * (2 - v // 16))
    return [bit, *other, base + v]


OUT = "kind int, a bigint, b bigint"


def _rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
        ["kind", "a", "b"],
    )


def link_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars (kind 0) of the groups; of large groups second signatures (kind 1)."""
    large = None
    for keys, members, starts, closed in _groups(batches, GROUP):
        if not closed or keys[0] == large:
            whole = len(keys) if not closed else (starts[1] if len(starts) > 1 else len(keys))
            large = int(keys[0])
            for block in range(0, whole, 50_000):
                yield _rows(1, *finer(large, members[block : min(whole, block + 50_000)]))
            if whole == len(keys):
                continue
            starts, keys, members = starts[1:] - whole, keys[whole:], members[whole:]
        sizes = np.diff(np.append(starts, len(keys)))
        pairs = starts[sizes == 2]
        near = distances(members[pairs], members[pairs + 1]) <= RADIUS
        a, b = [members[pairs + 1][near]], [members[pairs][near]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            group = members[start : start + size]
            if size > GROUP:
                yield _rows(1, *finer(int(keys[start]), group))
                continue
            for part, root in star(group):
                a.append(part)
                b.append(root)
        yield _rows(0, np.concatenate(a), np.concatenate(b))


def link_wide_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of second signatures; a group has at most 2**18 members."""
    for keys, members, starts, _ in _groups(batches, 1 << 18):
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
            group = np.unique(members[start:end])
            if len(group) > 1:
                found = star(group) if len(group) <= GROUP else wide_star(group, free_bits(int(keys[start])))
                for part, root in found:
                    yield _rows(0, part, root)


def links(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``classes`` within the radius."""
    order = ["key", "fp"]
    found = materialise(
        signatures(classes)
        .repartition("key")
        .sortWithinPartitions(*order)
        .mapInArrow(link_groups, OUT),
        "simhash-links",
    )
    again = (
        found.where("kind = 1")
        .select(F.col("a").alias("key"), F.col("b").alias("fp"))
        .repartition("key")
        .sortWithinPartitions(*order)
        .mapInArrow(link_wide_groups, OUT)
    )
    return found.where("kind = 0").union(again).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    The fingerprint is over runs of ``size`` words, A-Z lower-cased, as 16 hex digits.
    Documents whose fingerprints differ in at most three bits are linked; component_id is
    the smallest doc_id that links reach.

    A missing text has no words and the fingerprint zero, which is linked like any other.
    Repeated rows are linked; a row without doc_id is linked but names no component, so
    the component of such rows alone is NULL. Other columns are ignored; no rows give none.
    """
    marks = materialise(fingerprints(docs, size), "simhash")
    classes = materialise(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(links(classes.select("fp")))
    parts = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    smallest = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    named = parts.join(smallest, "root").select("fp", "component_id")
    return marks.join(named, "fp").select("doc_id", hex16("fp").alias("fingerprint"), "component_id")


def hex16(column: str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` with one document of each component of ``groups``, the smallest doc_id's.

    ``groups``: (doc_id, component_id), as from ``near_duplicates``. Rows without doc_id
    cannot be told apart and stay. Rows of one doc_id and different texts are different
    documents; of rows with the same doc_id and text one stays.
    """
    groups = materialise(groups.select("doc_id", "component_id").where("doc_id is not null"), "simhash-groups")
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first.hint("merge"), "doc_id", "left_semi")
    repeated = groups.groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = materialise(repeated, "simhash-repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, "doc_id", "left_anti")
        several = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        kept = once.union(several)
    return kept.select(*docs.columns).union(docs.where("doc_id is null"))
