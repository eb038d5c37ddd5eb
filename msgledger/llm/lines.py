"""Drop lines that many documents share.

Lines are exploded as 128-bit hashes of their normalised form, once per document; distinct
documents are counted per hash with map-side combine, and the hashes to drop come back to each
document as a list, by which its lines are put together again in their order.
"""
from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from msgledger.llm.common import map_arrow, small_batches, stage_table, utf8

MIN_CHARS = 20
MIN_DOCS = 3
RESULT = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The line without outer ASCII blanks, A-Z lowered; None if it has too few code points."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def hash_of(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h): each long enough key of a document once."""

    def explode(batch: pa.RecordBatch):
        at, hashes = [], []
        for i, data in enumerate(batch.column(1).to_pylist()):
            if data:
                keys = {key_of(line, min_chars) for line in data.split(b"\n")}
                keys.discard(None)
                hashes.extend(map(hash_of, keys))
                at.extend([i] * len(keys))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(hashes, pa.binary())], ["doc_id", "h"])

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), utf8("text").alias("text")), explode, "doc_id long, h binary")


def drop_lists(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(d, drop): the hashes a document loses; at most as many as it has lines."""
    keys = stage_table(line_keys(docs, min_chars), "line-keys")
    shared = stage_table(
        keys.groupBy("h").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs).select("h", "keeper"), "line-shared")
    lost = keys.join(shared, "h").where(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("keeper")))
    return lost.groupBy(F.col("doc_id").alias("__d")).agg(F.collect_set("h").alias("__drop"))


def _without(min_chars: int):
    @F.arrow_udf(RESULT)
    def without(text: pa.Array, drop: pa.Array) -> pa.Array:
        texts, counts, dropped = [], [], []
        for data, lost in zip(text.to_pylist(), drop.to_pylist(), strict=True):
            lines = (data or b"").split(b"\n")
            kept = lines
            if lost:
                lost = set(lost)
                kept = [x for x in lines if (k := key_of(x, min_chars)) is None or hash_of(k) not in lost]
            texts.append(b"\n".join(kept).decode("utf-8", "replace"))
            counts.append(len(lines))
            dropped.append(len(lines) - len(kept))
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
            ["text", "n_lines", "n_dropped"])

    return without


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, result: str = "result") -> DataFrame:
    """``docs`` with a struct ``result``: the text left, ``n_lines`` before and ``n_dropped``.

    Keys with ``min_chars`` code points or more, found in ``min_docs`` documents or more, lose
    their lines in all but the largest doc_id holding them. Needs doc_id and text; all columns
    pass through. Null and empty texts are one empty line. Rows that share a doc_id count as one
    document and are treated alike; a null doc_id counts as no document and keeps no shared line.
    An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    lists = drop_lists(docs, min_chars, min_docs)
    joined = docs.join(lists, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__d")), "left")
    done: Column = _without(min_chars)(utf8("text"), F.col("__drop"))
    return joined.select(*[joined[c] for c in docs.columns], done.alias(result))
