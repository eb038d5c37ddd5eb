"""Near-duplicate documents by SimHash fingerprints and deletion variants.

Two fingerprints at 4 differing bits or fewer, cut into three segments, have one segment that
differs by one bit at most. Each segment is indexed once per wildcard bit (64 variants in all);
an equality on a variant brings such pairs together, and the whole fingerprints are compared.
Only distinct fingerprints are indexed. Within one variant, members are joined to components by
a search that compares each reached member with those not reached yet, so a large group of
near copies costs about its size and leaves a star of edges, not all pairs.
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

SHINGLE = 4
BITS = 4
SEED = 42
# First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PIECE = 1 << 16  # hashes counted at a time
PAIRED = 8  # runs up to this size are compared as pairs, all at once


def fingerprint(data: bytes | None, size: int = SHINGLE) -> int:
    """64 bits: each is set if it is set in over half of the shingles' hashes; no words: zero."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(len(words) - size + 1, 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, PIECE):
        ends = starts[at + size:at + size + PIECE] if len(words) >= size else starts[-1:]
        hashes = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts[at:at + PIECE], ends, strict=False)), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch):
        fps = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), utf8("text").alias("text")), run, "doc_id long, fp long")


def variants(fps: np.ndarray) -> np.ndarray:
    """One row per fingerprint, one column per wildcard bit: the bit's number over its segment
    with that bit cleared."""
    out = np.empty((len(fps), 64), np.int64)
    bits = fps.view(np.uint64)
    for first, width in SEGMENTS:
        segment = ((bits >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
        for k in range(width):
            out[:, first + k] = (segment & ~(1 << k)) | ((first + k) << 22)
    return out


def signatures(reps: DataFrame) -> DataFrame:
    """(sig, fp): 64 rows per distinct fingerprint."""

    def run(batch: pa.RecordBatch):
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 2000):
            part = fps[at:at + 2000]
            yield pa.RecordBatch.from_arrays([pa.array(variants(part).ravel()), pa.array(np.repeat(part, 64))], ["sig", "fp"])

    return map_arrow(reps.select("fp"), run, "sig long, fp long")


def _far(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) > bits


def reached(fps: np.ndarray, bits: int) -> list[np.ndarray]:
    """The members of one run as groups, each linked within itself."""
    groups, left = [], np.sort(fps)
    while len(left):
        group, front, left = [left[:1]], left[:1], left[1:]
        while len(front) and len(left):
            part, front = front[:1], front[1:]
            hit = ~_far(part, left, bits)
            if hit.any():
                new, left = left[hit], left[~hit]
                group.append(new)
                front = np.concatenate((front, new))
        groups.append(np.concatenate(group))
    return groups


def links(signed: DataFrame, bits: int = BITS) -> DataFrame:
    """(hi, lo): edges that join all linked members of each variant.

    Rows come sorted by variant, so only one variant's fingerprints, 8 bytes each, are held.
    """

    def edges(sig: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        sizes = np.diff(np.append(starts, len(sig)))
        hi, lo = [], []
        few = np.repeat((sizes > 1) & (sizes <= PAIRED), sizes)
        a, s = fps[few], sig[few]
        for step in range(1, PAIRED):
            x, y = a[:-step], a[step:]
            near = (s[:-step] == s[step:]) & ~_far(x, y, bits)
            hi.append(np.maximum(x[near], y[near]))
            lo.append(np.minimum(x[near], y[near]))
        for k in np.flatnonzero(sizes > PAIRED):
            for group in reached(fps[starts[k]:starts[k] + sizes[k]], bits):
                least = group.min()
                rest = group[group != least]
                hi.append(rest)
                lo.append(np.full(len(rest), least))
        return np.concatenate(hi), np.concatenate(lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                hi, lo = edges(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                pairs = np.unique(np.stack((hi, lo)), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["hi", "lo"])

        for batch in batches:
            sig, fps = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not len(sig):
                continue
            cut = int(np.searchsorted(sig, sig[-1], "left"))
            if cut:  # the last variant may go on in the next batch
                held.append((sig[:cut], fps[:cut]))
                yield from flush()
                held = []
            held.append((sig[cut:], fps[cut:]))
        yield from flush()

    # Signatures are mixed by Spark's hash; the number of tasks follows spark.sql.shuffle.partitions.
    return signed.repartition("sig").sortWithinPartitions("sig").mapInArrow(run, "hi long, lo long")


def groups(docs: DataFrame, size: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Words are whole-text runs of non-blanks, A-Z lowered. Null, empty and blank texts have
    fingerprint zero and are linked like any other. component_id is the smallest doc_id reachable
    over links; rows with a null doc_id link too, but give no component_id, so a component of such
    rows alone has null. Repeated rows give repeated results; other columns are ignored; an empty
    table gives no rows.
    """
    if bits > 4:
        raise ValueError("three segments with one wildcard find at most 4 differing bits")
    small_batches(docs.sparkSession)
    rows = stage_table(fingerprints(docs, size), "simhash-rows")
    reps = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-reps")
    found = stage_table(components(links(signatures(reps), bits)), "simhash-roots")
    rooted = reps.join(found, reps["fp"] == found["node"], "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    rooted = stage_table(rooted, "simhash-rooted")
    ids = stage_table(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "simhash-ids")
    by_fp = stage_table(rooted.select("fp", F.col("root").alias("r")).join(ids, F.col("r") == F.col("root")).select(
        F.col("fp").alias("f"), "component_id"), "simhash-components")
    return rows.join(by_fp, F.col("fp") == F.col("f")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's smallest; all columns pass through.

    Rows that share that doc_id all stay, and so do rows of components without any doc_id.
    """
    found = groups(docs, size, bits)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__kept")), "left_semi")
