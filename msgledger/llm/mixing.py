"""Mix sources to target weights.

Documents are dealt by a hash to a fixed number of blocks per source. A source takes whole
passes over its blocks and, for the rest of its target, a random few of them; the last of these
is cut where the target is reached. A splitting tree then deals each source's exact block quota
to the output shards: at every node the left half's share is drawn from a multivariate
hypergeometric distribution, seeded by the node, so any task can walk from the root to its own
shards. A shard's blocks are a stretch of the source's permuted blocks, disjoint from all
others, and a shard is put in random order by itself.
"""
from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from msgledger.llm.common import map_arrow, stage_table

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_BITS = 10  # 1,024 blocks per source; more for more data
SHARDS = 64
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _hash60(*parts: Column) -> Column:
    """60 bits of MD5, so that SQL engines agree on them."""
    mixed = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]))
    return F.conv(F.substring(mixed, 1, 15), 16, 10).cast("bigint")


def sized(docs: DataFrame, seed: str = SEED, bits: int = BLOCK_BITS) -> DataFrame:
    """doc_id, source, size, the document's hash ``u`` and its block."""
    u = _hash60(F.lit(seed), F.col("source"), F.col("doc_id"))
    return docs.select("doc_id", "source", n_words("text").alias("size"), u.alias("u"),
                       F.shiftright(u, KEY_BITS - bits).cast("int").alias("block"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target from (source, source_size); one row per source.

    Weights go round over the sources in code point order, null last. A source takes at most
    ``max_repeat`` times its size; filling the sources in order of cap by weight gives the level
    at which the rest share what is left, which is where resharing by weight ends.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("place", place).withColumn("weight", weight.cast("bigint"))
    rows = rows.withColumn("cap", F.col("source_size") * max_repeat)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("level", level).withColumn("at", F.row_number().over(order))
    rows = rows.withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    first = F.min_by("level", F.when(~F.col("full"), F.col("at"))).over(every)
    target = F.least(F.col("cap").cast("double"), F.coalesce(first * F.col("weight"), F.col("cap").cast("double")))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def instances(rows: DataFrame, goal: DataFrame, seed: str = SEED) -> DataFrame:
    """Every taking of a block: s, block, epoch, and for the cut block where it is cut.

    One row per block and pass, and one cut per source. In the cut block documents come by
    (u, doc_id): those before (cut_u, cut_id) are taken, that one gives ``cut_take`` words.
    """
    blocks = rows.groupBy("source", "block").agg(F.sum("size").alias("words"))
    want = goal.select(F.col("source").alias("s"), F.col("source_size"), F.floor("target").alias("want")).where("source_size > 0")
    passes = F.expr("want div source_size")
    blocks = blocks.join(want, _same(F.col("source"), F.col("s"))).select(
        "s", "block", "words", passes.alias("passes"), (F.col("want") - passes * F.col("source_size")).alias("rest"))
    drawn = _hash60(F.lit(seed), F.lit("block"), F.col("s"), F.col("block"))
    order = Window.partitionBy("s").orderBy(drawn, "block")
    blocks = blocks.withColumn("before", F.sum("words").over(order) - F.col("words")).withColumn(
        "room", F.greatest(F.least(F.col("rest") - F.col("before"), F.col("words")), F.lit(0)))
    blocks = stage_table(blocks, "mix-blocks")
    cut = blocks.where("room > 0 AND room < words").select("s", F.col("block").alias("b"), "room")
    inside = rows.join(cut, _same(F.col("source"), F.col("s")) & (F.col("block") == F.col("b"))).withColumn(
        "upto", F.sum("size").over(Window.partitionBy("s").orderBy("u", "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
    ends = inside.where("upto >= room AND upto - size < room").groupBy("s").agg(
        F.min(F.struct("u", "doc_id", (F.col("size") + F.col("room") - F.col("upto")).alias("take"))).alias("cut"))
    whole = blocks.select("s", "block", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int") + 1)).alias("epoch"),
                          "passes", "room", "words").where("epoch <= passes OR room > 0")
    is_cut = (F.col("epoch") > F.col("passes")) & (F.col("room") < F.col("words"))
    out = whole.join(ends.withColumnRenamed("s", "cut_s"), _same(F.col("s"), F.col("cut_s")), "left")
    return out.select("s", "block", "epoch", F.when(is_cut, F.col("cut")).alias("cut"))


def split(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Walk the splitting tree to one shard: where its stretch of each source's blocks starts, and
    how many blocks it has."""
    low, high = 0, shards
    start, left = np.zeros_like(quotas), quotas.copy()
    while high - low > 1:
        middle = (low + high) // 2
        take = int(left.sum()) * (middle - low) // (high - low)
        drawn = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(left, take, method="marginals")
        if shard < middle:
            high, left = middle, drawn
        else:
            low, start, left = middle, start + drawn, left - drawn
    return start, left


def placements(takings: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``takings`` with the shard each goes to.

    The block quotas, one number per source, are all the driver sees.
    """
    spark = takings.sparkSession
    drawn = _hash60(F.lit(seed), F.lit("taking"), F.col("s"), F.col("block"), F.col("epoch"))
    numbered = stage_table(takings.withColumn("pos", F.row_number().over(
        Window.partitionBy("s").orderBy(drawn, "block", "epoch")) - 1), "mix-takings")
    quotas = numbered.groupBy("s").agg(F.count("*").alias("n")).orderBy(F.col("s").asc_nulls_last()).collect()
    names, counts = [q["s"] for q in quotas], np.array([q["n"] for q in quotas], np.int64)
    number = int.from_bytes(seed.encode(), "big") % (1 << 63)

    def walk(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for shard in batch.column(0).to_pylist():
            start, size = split(counts, shards, shard, number)
            has = np.flatnonzero(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in has], pa.string()), pa.array(start[has]), pa.array(size[has]),
                 pa.array(np.full(len(has), shard, np.int32))], ["p", "first", "size", "shard"])

    stretches = map_arrow(spark.range(shards), walk, "p string, first long, size long, shard int").select(
        "p", "shard", F.explode(F.expr("sequence(first, first + size - 1)")).alias("at"))
    return numbered.join(stretches, _same(F.col("s"), F.col("p")) & (F.col("pos") == F.col("at"))).select(
        "s", "block", "epoch", "cut", "shard")


def taken_words(cut: Column, size: Column, u: Column, doc_id: Column) -> Column:
    """Words one taking of a block takes from a document of it."""
    here, there = F.struct(u.alias("u"), doc_id.alias("doc_id")), F.struct(cut["u"].alias("u"), cut["doc_id"].alias("doc_id"))
    return F.when(cut.isNull() | (here < there), size).when(here == there, F.least(cut["take"], size)).otherwise(F.lit(0))


def plan(docs: DataFrame, shards: int = SHARDS, bits: int = BLOCK_BITS, seed: str = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized rows, the targets by source and the placements of blocks."""
    rows = stage_table(sized(docs, seed, bits), "mix-sizes")
    goal = stage_table(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    return rows, goal, stage_table(placements(instances(rows, goal, seed), shards, seed), "mix-placements")


def taken(docs: DataFrame, shards: int = SHARDS, bits: int = BLOCK_BITS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and the shards of every row of ``docs``.

    Null and empty texts have size 0 and give nothing; a null source is a source, the last.
    ``taken`` counts repeats and is at most three times the size. Rows that share source and
    doc_id lie in one block; where a target ends among such rows they are cut alike. Other
    columns are ignored, an empty table gives no rows, and reruns agree.
    """
    rows, goal, placed = plan(docs, shards, bits, seed)
    by_block = placed.groupBy("s", "block").agg(F.collect_list(F.struct("shard", "cut")).alias("takings"))
    got = rows.join(by_block.withColumnRenamed("block", "b"), _same(F.col("source"), F.col("s")) & (F.col("block") == F.col("b")), "left")
    words = F.transform("takings", lambda t: taken_words(t["cut"], F.col("size"), F.col("u"), F.col("doc_id")))
    got = got.select("doc_id", "source", "size", F.coalesce(F.aggregate(
        words, F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(0)).alias("taken"))
    # One row per source.
    goal = goal.withColumnRenamed("source", "s")
    return got.join(goal, _same(F.col("source"), F.col("s")), "left").select("doc_id", "size", "source_size", "target", "taken")


@F.arrow_udf(T.StringType())
def _first_words(text: pa.Array, n: pa.Array) -> pa.Array:
    """The text up to its n-th word; rows that are not cut come as null."""
    def cut(data: str, k: int) -> str:
        ends = (m.end() for m in re.finditer(WORD, data))
        return data[:next(islice(ends, k - 1, None), len(data))]

    return pa.array([None if t is None else cut(t, k) for t, k in zip(text.to_pylist(), n.to_pylist(), strict=True)], pa.string())


def mix(docs: DataFrame, shards: int = SHARDS, bits: int = BLOCK_BITS, seed: str = SEED) -> DataFrame:
    """The mixed rows: ``docs`` repeated, left out or cut, with their ``shard``, in random order
    within each shard; see ``taken`` for what each row gives. Rows without words are left out.
    All columns of ``docs`` pass through.
    """
    _, _, placed = plan(docs, shards, bits, seed)
    place = F.struct("source", "doc_id", n_words("text").alias("size"), _hash60(F.lit(seed), F.col("source"), F.col("doc_id")).alias("u"))
    rows = docs.withColumn("__place", place)
    block = F.shiftright(F.col("__place.u"), KEY_BITS - bits).cast("int")
    placed = placed.select(F.struct(*placed.columns).alias("__taking"))
    rows = rows.join(placed, _same(F.col("__place.source"), F.col("__taking.s")) & (block == F.col("__taking.block")))
    rows = rows.withColumn("__take", taken_words(
        F.col("__taking.cut"), F.col("__place.size"), F.col("__place.u"), F.col("__place.doc_id"))).where("__take > 0")
    is_cut = F.col("__take") < F.col("__place.size")
    text = F.coalesce(_first_words(F.when(is_cut, F.col("text")), F.col("__take")), F.col("text"))
    shard = F.col("__taking.shard")
    order = F.xxhash64(F.lit(seed), shard, F.col("__taking.epoch"), F.col("__place.doc_id"))
    mixed = rows.withColumn("__order", order).repartition(shard).sortWithinPartitions(shard, "__order")
    return mixed.select(*[text.alias(c) if c == "text" else mixed[c] for c in docs.columns], shard.alias("shard"))
