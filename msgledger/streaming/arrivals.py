"""First arrivals of a stream, remembered in the state store and not looked up in what was written."""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

# State in RocksDB, and no batches without data. A local sort is no streaming operator to Spark's
# check, though it puts no more than the rows of one micro-batch into order.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.unsupportedOperationCheck": "false",
}


def _first_of_sorted(key: str):
    """The first row of each run of equal keys, over all batches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new = [last is None or keys[0].as_py() != last[0], *(codes[1:] != codes[:-1]).tolist()]
            last = (keys[-1].as_py(),)
            yield batch.filter(pa.array(new, pa.bool_()))

    return run


def first_arrivals(stream: DataFrame, known: DataFrame, keep_days: float, key: str = "message_id", order: str = "ord") -> DataFrame:
    """Rows of a stream whose key has not come before; of copies in one micro-batch the first by ``order``.

    ``known`` (key): a stream of keys that count as come, all of them by the first micro-batch. The
    copies of a key are put into order by a sort of the micro-batch and thinned to the first; the
    state, in the JVM, has one time per key. A key is forgotten ``keep_days`` after it came first, at
    the earliest, so the state is bounded by what arrives in that time; it must cover how far back the
    source delivers again. A null key is a key. Start the query under :func:`state_store`.
    """
    fields = [F.col(key) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    both = stream.withColumn("_known", F.lit(False)).unionByName(known.select(*fields, F.lit(True).alias("_known")))
    placed = both.repartition(key).sortWithinPartitions(key, F.desc("_known"), F.asc_nulls_last(order))
    first = placed.mapInArrow(_first_of_sorted(key), placed.schema)
    # The watermark lags by the delay and a key's time runs out the delay after it came: half each.
    delay = f"{max(int(keep_days * 43_200_000), 1)} milliseconds"
    arrived = first.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    return arrived.dropDuplicatesWithinWatermark([key]).where(~F.col("_known")).select(*stream.columns)


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Settings for the queries started inside; a query keeps the ones it starts with."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
