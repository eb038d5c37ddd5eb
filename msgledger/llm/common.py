"""What the operators of this folder share: word rules, Arrow helpers, worker caches."""
from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from msgledger.session import stage_table

# Rows per Arrow batch: texts may be long, and a batch is held whole by a Python worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the Arrow batch size of the session, if it is larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column: str | Column) -> Column:
    """The text as UTF-8 bytes; null stays null."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over batches, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """A value made once per Python worker process.

    Functions travel by value, so their module globals live for one task only; this does not.
    """
    held = sys.__dict__.setdefault("_msgledger_llm_cache", {})
    if name not in held:
        held[name] = make()
    return held[name]


__all__ = ["BATCH_ROWS", "documents", "map_arrow", "small_batches", "stage_table", "utf8", "worker_cache"]
