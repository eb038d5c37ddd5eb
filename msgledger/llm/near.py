"""Near copies beyond the reach of four fingerprint bits: MinHash candidates, exact Jaccard.

Texts become sets of five-word shingles, and equal sets are one. MinHash bands of six values bring
texts together; with 18 bands, a pair of similarity 0.8 shares none of them with probability
(1 - 0.8^6)^18, below 0.005. Each text is first compared with two of those it shares a band
with, then, without a limit, with all those it is not yet connected with. The sets are compared whole.
Pairs of similarity 0.8 and more become links.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from msgledger.llm.common import map_arrow, small_batches, stage_table, utf8
from msgledger.llm.graph import components

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 18, 6
PIECE = 4096  # shingles hashed with all functions at a time
_FACTORS = np.array([xxhash.xxh64_intdigest(b"factor %d" % k) | 1 for k in range(BANDS * ROWS)], np.uint64)
_OFFSETS = np.array([xxhash.xxh64_intdigest(b"offset %d" % k) for k in range(BANDS * ROWS)], np.uint64)


def shingles(data: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; a shorter text is one, one without words has none."""
    words = (data or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    ends = starts[size:] if len(words) >= size else starts[-1:]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b - 1]) for a, b in zip(starts, ends, strict=False)), np.uint64))


def bands(found: np.ndarray) -> np.ndarray:
    """One key per band of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), PIECE):
        mixed = found[at:at + PIECE, None] * _FACTORS + _OFFSETS
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), seed=k) for k, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def texts_of(docs: DataFrame) -> DataFrame:
    """id, digest of the set, number of its shingles and band keys of every text with a word."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = shingles(text)
            if len(found):
                rows.append((doc, xxhash.xxh3_128_digest(found.tobytes()), len(found), bands(found)))
        if rows:
            ids, digests, sizes, keys = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(list(keys), pa.list_(pa.int64()))],
                ["id", "digest", "n", "bands"])

    return map_arrow(docs.select("doc_id", utf8("text").alias("text")), run, "id long, digest binary, n long, bands array<long>")


def first_pairs(members: DataFrame) -> DataFrame:
    """(hi, lo): every member of a band with two of the others, the one with the smallest id and one by hash."""
    chosen = members.groupBy("band").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.min_by("id", F.xxhash64("id", "band")).alias("drawn"))
    chosen = stage_table(chosen.where("least < most").select(F.col("band").alias("b"), "least", "drawn"), "near-chosen")
    met = members.join(chosen, F.col("band") == F.col("b")).select("id", F.explode(F.array_distinct(F.array("least", "drawn"))).alias("other"))
    return met.where("id <> other").select(F.greatest("id", "other").alias("hi"), F.least("id", "other").alias("lo")).distinct()


def other_pairs(members: DataFrame, links: DataFrame, met: DataFrame, similar: float) -> DataFrame:
    """(hi, lo): all pairs of a band that ``links`` do not connect yet, but those already ``met`` and those whose sizes rule them out.

    Members that are connected need no comparison, so a large group of near copies makes few pairs; a band
    of many texts that are all unlike makes all of its pairs, since only comparing can tell.
    """
    rooted = members.join(components(links), F.col("id") == F.col("node"), "left").select("band", "id", "n", F.coalesce("root", "id").alias("root"))
    rooted = stage_table(rooted, "near-rooted")
    unsettled = rooted.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("z")).where("a < z").select("band")
    rest = stage_table(rooted.join(unsettled, "band", "left_semi"), "near-unsettled")
    one, two = (rest.select("band", *[F.col(c).alias(f"{c}{k}") for c in ("id", "n", "root")]) for k in (1, 2))
    sizes = (F.col("n1") >= similar * F.col("n2")) & (F.col("n2") >= similar * F.col("n1"))
    pairs = one.join(two, "band").where((F.col("id1") > F.col("id2")) & (F.col("root1") != F.col("root2")) & sizes)
    return pairs.select(F.col("id1").alias("hi"), F.col("id2").alias("lo")).distinct().join(met, ["hi", "lo"], "left_anti")


def compared(pairs: DataFrame, docs: DataFrame, similar: float) -> DataFrame:
    """Those of ``pairs`` whose sets have a similarity of ``similar`` or more."""

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["id", "s"])

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(k).to_pylist()] for k in (2, 3))
        near = pa.array([similarity(x, y) >= similar for x, y in zip(a, b, strict=True)], pa.bool_())
        yield batch.select(["hi", "lo"]).filter(near)

    wanted = pairs.select(F.explode(F.array("hi", "lo")).alias("w")).distinct()
    texts = docs.join(wanted, F.col("doc_id") == F.col("w"), "left_semi")
    known = stage_table(map_arrow(texts.select("doc_id", utf8("text").alias("text")), sets, "id long, s binary"), "near-sets")
    both = pairs.join(known.select(F.col("id").alias("hi"), F.col("s").alias("s1")), "hi").join(
        known.select(F.col("id").alias("lo"), F.col("s").alias("s2")), "lo").select("hi", "lo", "s1", "s2")
    return map_arrow(both, check, "hi long, lo long")


def similar_pairs(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(hi, lo): links between the texts of ``docs`` (doc_id, text) that connect every two texts of a band
    whose sets have a similarity of ``similar`` or more, directly or through others.

    Equal sets are linked to the smallest doc_id that has them, which alone is compared with others.
    """
    texts = stage_table(texts_of(docs), "near-bands")
    classes = texts.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stage_table(classes, "near-classes")
    copies = texts.select("id", "digest").join(classes.select("digest", "rep"), "digest").where("id <> rep").select(F.col("id").alias("hi"), F.col("rep").alias("lo"))
    members = stage_table(classes.select(F.explode("bands").alias("band"), F.col("rep").alias("id"), "n"), "near-members")
    met = stage_table(first_pairs(members), "near-candidates")
    links = stage_table(compared(met, docs, similar).unionByName(copies).distinct(), "near-links")
    others = stage_table(other_pairs(members, links, met, similar), "near-others")
    return links if others.isEmpty() else links.unionByName(compared(others, docs, similar))


def keep_distinct(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` but those linked to a smaller doc_id; all columns pass through.

    Words are whole-text runs of non-blanks, A-Z lowered; texts are whole, however long. Null, empty and
    blank texts and rows without a doc_id are linked to nothing. Rows that share a doc_id are one
    document of which any text may link; they stay or go together. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    links = similar_pairs(rows, similar).where("hi <> lo").distinct()
    gone = components(links).select(F.col("node").alias("__node"))
    return docs.join(gone, F.col("doc_id").cast("bigint") == F.col("__node"), "left_anti")
