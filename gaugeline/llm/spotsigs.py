"""Document fingerprints by spot signatures, with DataFrame functions only.

Common words are anchors. Each anchor and the next ``CHAIN`` words that are not anchors
make a signature; a document's fingerprint is the set of its signatures' hashes. Two
documents are as alike as the Jaccard ratio of their sets.

``near_duplicates`` compares sets pruned in two ways: only sets of the same or the next
length class can reach the threshold, and such a pair shares one of its rarest signatures,
so only those are joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.components import components
from gaugeline.llm.text import text_or_empty
from gaugeline.session import materialise

CHAIN = 2

# Frequent function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have in is it of on or that the this to was were will with "
    "das dem den der des die ein eine im in ist mit nicht sich und von zu "
    "au dans de des du en est et la le les pas pour qui que se sur un une "
    "con de del el en es la las lo los para por que se su un una y"
).split()


def _with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sorted distinct 32-bit signatures of a text column, never empty.

    The n-th anchor at word p is followed by the content word p - n, counted from 0. A text
    without a whole chain has the hash of its own content as only signature.
    """
    anchors = sorted(set(ANCHORS))
    word_list, content, spots = f"_{out}_words", f"_{out}_content", f"_{out}_spots"
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    df = df.withColumn(word_list, F.split(plain, " "))
    df = df.withColumn(content, F.filter(word_list, lambda w: ~w.isin(anchors)))
    places = F.transform(word_list, lambda w, p: F.when(w.isin(anchors), p).otherwise(-1))
    df = df.withColumn(spots, F.filter(places, lambda p: p >= 0))

    def signature(p: Column, n: Column) -> Column:
        chain = [F.get(F.col(content), p - n + k) for k in range(CHAIN)]
        found = F.xxhash64(F.get(F.col(word_list), p), *chain)
        return F.when(p - n + CHAIN <= F.size(content), _fold(found))

    chains = F.array_distinct(F.array_compact(F.transform(spots, signature)))
    df = df.withColumn(out, F.sort_array(chains))
    alone = F.array(_fold(F.xxhash64(F.array_join(word_list, " "))))
    df = df.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(alone))
    return df.drop(word_list, content, spots)


def _fold(found: Column) -> Column:
    """The upper half of a 64-bit hash."""
    return F.shiftright(found, 32).cast("int")


def fingerprint_text(signatures: str) -> Column:
    """Eight hex digits for each signature, in order."""
    return F.array_join(
        F.transform(signatures, lambda s: F.substring(F.lpad(F.hex(s.cast("bigint")), 16, "0"), 9, 8)), ""
    )


def likeness(a: str, b: str) -> Column:
    """Jaccard ratio of two signature sets."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, signatures) for every row of ``docs``; a missing text counts as empty."""
    filled = docs.select("doc_id", text_or_empty().alias("text"))
    return _with_signatures(filled, "text", "signatures").drop("text")


def neighbours(docs: DataFrame, bucket_rows: int = 2_000) -> DataFrame:
    """(doc_id, text, next_text): each text with that of the next doc_id, falling; a ring.

    doc_ids are dealt to ranges of about ``bucket_rows`` rows. The first row of each range
    also goes to the range before, so every row has its neighbour at hand: texts move once.
    Rows without doc_id come last; rows of one doc_id follow each other by falling text.
    """
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    rows = docs.select("doc_id", text_or_empty().alias("text"), key.alias("_key"))
    narrow = docs.select(key.alias("_key"))
    count = narrow.count()
    parts = max(1, min(65_536, count // bucket_rows))
    cuts = sorted(
        set(
            narrow.agg(
                F.percentile_approx("_key", [i / parts for i in range(1, parts)], 20 * parts)
            ).first()[0]
            if parts > 1
            else []
        )
    )
    # Cuts are looked up in two steps, so a row meets about twice their root.
    width = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    if cuts:
        upper = F.array(*[F.lit(b[0]).cast("bigint") for b in blocks])
        inner = F.array(*[F.array(*[F.lit(c).cast("bigint") for c in b]) for b in blocks])
        block = F.size(F.filter(upper, lambda c: c <= F.col("_key")))
        inside = F.size(F.filter(F.get(inner, F.greatest(block - 1, F.lit(0))), lambda c: c <= F.col("_key")))
        bucket = F.greatest(block - 1, F.lit(0)) * width + inside
    else:
        bucket = F.lit(0)
    # One row for each range, at most 65,536 of them.
    heads = narrow.withColumn("_bucket", bucket).groupBy("_bucket").agg(F.max("_key").alias("_head"))
    above = Window.orderBy("_bucket")
    heads = heads.withColumn("_target", F.lead("_bucket").over(above)).withColumn(
        "_target", F.coalesce("_target", F.min("_bucket").over(Window.partitionBy()))
    )
    heads = materialise(heads.select(F.col("_head").alias("_key"), "_target"), "ranges")
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_target").alias("bucket"), F.lit(True).alias("guest"))
    return (
        rows.join(F.broadcast(heads), "_key", "left")
        .withColumn("_own", own)
        .withColumn("_place", F.explode(F.when(F.col("_target").isNull(), F.array("_own")).otherwise(F.array(F.col("_own"), guest))))
        .select("doc_id", "text", "_key", "_place.bucket", "_place.guest")
    )


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``neighbours`` with next_<column> of the row that follows each."""
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("_key"), F.desc("text"))
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    return rows.where("not guest").drop("bucket", "guest", "_key")


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness.

    The edited text has its last half (rounded down, in code points) replaced by as many
    first code points of the next text, falling by doc_id. Columns: doc_id, n_chars,
    edited_text, fingerprint, edited_fingerprint, near_edited, near_next.

    A missing text counts as empty. Texts without anchors are alike only if their words
    are the same. Repeated rows follow each other; other columns are ignored; no rows give
    no rows.
    """
    rows = _with_signatures(neighbours(docs), "text", "signatures")
    rows = with_next(rows, ["text", "signatures"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("bigint")).withColumn(
        "edited_text",
        F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)),
    )
    rows = _with_signatures(rows, "edited_text", "edited_signatures")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_text",
        fingerprint_text("signatures").alias("fingerprint"),
        fingerprint_text("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
    )


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, component_id, n_links): documents alike to ``threshold`` or more, linked.

    n_links counts the linked documents of other fingerprints, as classes of equal
    fingerprints; component_id is the smallest doc_id that links reach. Equal fingerprints
    form one class and are compared once.

    A missing text counts as empty; rows without doc_id are linked but name no component;
    repeated rows are linked; other columns are ignored; no rows give no rows.
    """
    marks = materialise(
        fingerprints(docs).select("doc_id", "signatures", F.xxhash64("signatures").alias("a")), "spots"
    )
    sets = marks.groupBy("a").agg(
        F.first("signatures").alias("signatures"), F.min("doc_id").alias("least")
    )
    sets = sets.withColumn("n", F.size("signatures"))
    # Class k holds the lengths from threshold**-k on: pairs lie in one class or adjacent ones.
    length_class = F.floor(F.log("n") / F.lit(-math.log(threshold)) + F.lit(1e-9)).cast("int")
    sets = materialise(sets.withColumn("k", length_class), "spot-sets")
    spots = sets.select("a", "n", "k", F.explode("signatures").alias("s"))
    rarity = spots.groupBy("s").agg(F.count("*").alias("f"))
    ranked = spots.join(rarity, "s").withColumn(
        "at", F.row_number().over(Window.partitionBy("a").orderBy("f", "s"))
    )
    prefix = materialise(
        ranked.where(F.col("at") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1).select(
            "a", "n", "k", "s"
        ),
        "spot-prefixes",
    )
    other = prefix.select(F.col("a").alias("b"), F.col("n").alias("m"), F.col("k").alias("j"), "s")
    pairs = (
        prefix.join(other, "s")
        .where(
            (F.col("a") < F.col("b"))
            & (F.abs(F.col("k") - F.col("j")) <= 1)
            & (F.least("n", "m") >= F.lit(threshold) * F.greatest("n", "m"))
        )
        .select("a", "b")
        .distinct()
    )
    left = sets.select("a", F.col("signatures").alias("x"))
    right = sets.select(F.col("a").alias("b"), F.col("signatures").alias("y"))
    edges = materialise(
        pairs.join(left, "a").join(right, "b").where(likeness("x", "y") >= threshold).select("a", "b"),
        "spot-links",
    )
    degree = (
        edges.select("a").union(edges.select(F.col("b").alias("a"))).groupBy("a").agg(F.count("*").alias("n_links"))
    )
    roots = components(edges)
    named = sets.join(roots, F.col("a") == F.col("node"), "left").select(
        "a", F.coalesce("root", "a").alias("root"), "least"
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, "root").join(degree, "a", "left")
    return marks.join(classes, "a").select(
        "doc_id", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
