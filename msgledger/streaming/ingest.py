"""Incremental ingest of landed messages with Structured Streaming."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from msgledger.operators.accounts import account_sizes
from msgledger.operators.ledger import dedupe_batch, known_ids, new_records
from msgledger.options import LIMITS, Limits, Options
from msgledger.plans.runs import LEDGER, Paths, batch_run
from msgledger.session import scratch, stage_table
from msgledger.sinks.tables import read_ledger, read_run, write_ledger
from msgledger.streaming.arrivals import first_arrivals, state_store


def landed_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                  max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """New files of a landing folder; ``max_files`` bounds the size of a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that belongs to a checkpoint: made with it, kept next to it, lost with it.

    A stream that starts anew without its checkpoint counts its batches from zero again; under
    another name it cannot take the partitions of the old one for its own.
    """
    path = f"{checkpoint}/name"
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.text(path)
    return spark.read.text(path).first()["value"]


def check_replaced(ledger: DataFrame, run: str, ids: DataFrame) -> None:
    """Refuse to replace a partition that holds ids the batch does not have."""
    lost = ledger.where(F.col("run_id") == run).select("message_id").join(ids, "message_id", "left_anti")
    if not lost.isEmpty():
        raise RuntimeError(f"{run}: the ledger holds messages under this name that are not in the batch")


def _each_batch(stream: DataFrame, checkpoint: str, one_batch: Callable[[DataFrame, str], None]) -> None:
    name = stream_name(stream.sparkSession, checkpoint)
    query = (
        stream.writeStream.foreachBatch(lambda batch, n: one_batch(batch, f"{name}-{n:08d}"))
        .option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_incremental(
    stream: DataFrame, to_records: Callable[[DataFrame], DataFrame], ledger: str, checkpoint: str,
    limits: Limits = LIMITS,
) -> None:
    """Records of everything that has arrived since the last call into the ledger, then stop.

    Each micro-batch is freed of its own copies and of ids the ledger already has, and written
    as its own run partition, named by stream and batch. A batch that is tried again after a
    failure leaves its own partition out of the id check and overwrites it, so the ledger
    comes out the same; a partition that holds anything else is never replaced.
    """
    def one_batch(batch: DataFrame, run: str) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            first = stage_table(dedupe_batch(to_records(batch).withColumn("run_id", F.lit(run))), "batch")
            check_replaced(read_run(spark, ledger, run, first.schema), run, first)
            known = known_ids(read_ledger(spark, ledger, first.schema).where(F.col("run_id") != run), first, first.count(), limits)
            # Staged, because the ledger cannot be read and written in one job.
            fresh = stage_table(new_records(first, known, limits=limits, deduped=True), "fresh")
            write_ledger(fresh, ledger, run_id=run)

    _each_batch(stream, checkpoint, one_batch)


def ingest_messages(
    stream: DataFrame, to_messages: Callable[[DataFrame], DataFrame], accounts: DataFrame, paths: Paths,
    checkpoint: str, options: Options = Options(),
) -> None:
    """Mail that has arrived since the last call through the whole batch path, then stop.

    ``to_messages`` makes message_id, ord, body, generated_text (and sender, subject) of what
    landed. Each micro-batch is one run: known messages dropped, the rest parsed, accounts
    resolved, balances filled (with ``paths.balances`` from where they stood), records numbered
    on, flags written. Every micro-batch asks the ledger for its ids; :func:`ingest_arrivals`
    does not.
    """
    sizes = account_sizes(accounts, options.limits)

    def one_batch(batch: DataFrame, run: str) -> None:
        messages = to_messages(batch)
        check_replaced(read_run(batch.sparkSession, paths.ledger, run, LEDGER), run, messages.select("message_id"))
        batch_run(messages, accounts, run, paths, options, sizes=sizes)

    _each_batch(stream, checkpoint, one_batch)


def _known_stream(spark: SparkSession, ledger: str, folder: str, key: T.StructField) -> DataFrame:
    """The ledger's ids as they were when the checkpoint began, kept next to it."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        ids = read_ledger(spark, ledger, LEDGER).where(F.col("message_id") != "")
        ids.select(F.col("message_id").cast(key.dataType).alias(key.name)).write.mode("overwrite").option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)
    return landed_stream(spark, folder, T.StructType([key]))


def ingest_arrivals(
    stream: DataFrame, to_messages: Callable[[DataFrame], DataFrame], accounts: DataFrame, paths: Paths,
    checkpoint: str, keep_days: float = 30, options: Options = Options(), key: str = "message_id", order: str = "ord",
) -> None:
    """:func:`ingest_messages` with the ids that came before in the state store.

    The work of a micro-batch depends on what arrives and not on the ledger: an id (``key`` of the
    stream, equal to ``message_id``) is remembered for ``keep_days``; the last record id is kept in a mark,
    balances in their own table. Only a stream that begins without its checkpoint reads the
    ledger's ids, once. ``to_messages`` must keep one row per id.
    """
    spark, sizes = stream.sparkSession, account_sizes(accounts, options.limits)
    known = _known_stream(spark, paths.ledger, f"{checkpoint}/known", stream.schema[key])

    def one_batch(batch: DataFrame, run: str) -> None:
        with scratch(batch.sparkSession):
            # Staged, so that the state is worked on once.
            messages = to_messages(stage_table(batch, "arrivals"))
            check_replaced(read_run(batch.sparkSession, paths.ledger, run, LEDGER), run, messages.select("message_id"))
            batch_run(messages, accounts, run, paths, options, arrived=True, sizes=sizes)

    with state_store(spark):
        _each_batch(first_arrivals(stream, known, keep_days, key, order), checkpoint, one_batch)


def drop_overlap(stream: DataFrame, overlap: str, key: str = "message_id", salts: int = 16) -> DataFrame:
    """Drop messages read again within the overlap, with state bounded by it.

    The overlap is counted from when a message first came in, not from its own date, so a
    message that arrives late is kept. An id may have very many copies: they are dropped
    per (id, input task) first, so that at most ``salts`` rows per id meet in one place.
    Ids older than the overlap may come back; the id check against the ledger catches those.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", overlap)
    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        arrived = arrived.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return arrived.dropDuplicatesWithinWatermark([key]).drop("_arrived")
