"""Work that needs a global order, without one task seeing all of it."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from msgledger.operators.joins import lookup
from msgledger.options import LIMITS, Limits
from msgledger.session import stage_table

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def ordered_chunks(df: DataFrame, order: Sequence[str | Column], chunks: int | None, label: str) -> DataFrame:
    """Cut a frame into contiguous pieces of a total order: adds ``_chunk`` and ``_pos``.

    Range partitioning samples the order columns, so a hot key spans several pieces.
    The result is staged, which fixes the cut for every later use and for retries.
    ``order`` must end in a unique column.
    """
    cut = df.repartitionByRange(chunks, *order) if chunks else df.repartitionByRange(*order)
    placed = cut.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    staged = stage_table(placed, label)
    return staged.select(
        *df.columns,
        F.shiftright("_at", _POSITION_BITS).cast("int").alias("_chunk"),
        F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def global_rank(
    df: DataFrame, order: Sequence[str | Column], name: str, start: int | Column = 0,
    chunks: int | None = None, limits: Limits = LIMITS,
) -> DataFrame:
    """Row number (from ``start`` + 1) in a total order, as ``name``.

    One range shuffle. The window runs over one row per piece, never over the data.
    """
    placed = ordered_chunks(df, order, chunks, "rank")
    sizes = placed.groupBy("_chunk").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    start = F.lit(start) if isinstance(start, int) else start
    return lookup(placed, offsets, ["_chunk"], "inner", limits, dim_rows=chunks).select(
        *df.columns, (start + F.col("_base") + F.col("_pos") + 1).cast("bigint").alias(name)
    )


def chunk_count(rows: int, limits: Limits = LIMITS) -> int:
    return max(1, math.ceil(rows / limits.chunk_rows))
