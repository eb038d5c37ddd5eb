"""Ledger, flag, run and attachment writers."""
from __future__ import annotations

import logging
import operator
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from msgledger.operators.validate import FLAG_COLUMNS, blank_nulls
from msgledger.schema import RECORD
from msgledger.session import delete_folder, stage_table
from msgledger.sources.tables import RUN_LOG, RUN_META

log = logging.getLogger(__name__)


def _escaped(spark: SparkSession, value: str) -> str:
    """Spark's own escaping of partition values."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def clear_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Remove one run's partition, if there is one.

    Dynamic overwrite leaves a partition alone that gets no rows, so a run that is repeated
    and comes out empty is cleared by this.
    """
    delete_folder(spark, f"{path}/run_id={_escaped(spark, run_id)}")


def _replace_runs(rows: DataFrame, path: str, run_id: str | None) -> None:
    """Replace the runs that ``rows`` belong to; ``run_id`` also if it turns out to have none.

    The rows are counted on their way to the files, so the plan runs once.
    """
    written = Observation()
    observed = rows if run_id is None else rows.observe(written, F.count(F.lit(1)).alias("n"))
    writer = observed.write.partitionBy("run_id").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if "message_id" in rows.columns:
        # For looking up a few ids: a row group is read only if its filter may hold one of them.
        writer = writer.option("parquet.bloom.filter.enabled#message_id", True).option("parquet.bloom.filter.adaptive.enabled", True)
    writer.parquet(path)
    if run_id is not None and not written.get["n"]:
        clear_run(rows.sparkSession, path, run_id)


def write_ledger(rows: DataFrame, path: str, many_runs: bool = False, run_id: str | None = None) -> None:
    """Write rows into the ``run_id`` partitions they belong to, replacing those runs only.

    Writing a run again gives the same table; with ``run_id`` also if it has no rows any more. Order is made when reading, so an older batch
    never forces a rewrite. One run is written as it comes, a file per task, without a
    shuffle. ``many_runs`` at once are rebalanced by size first, so that a huge run becomes
    many files and small ones do not leave a tiny file per task.
    """
    _replace_runs(rows.hint("rebalance", "run_id") if many_runs else rows, path, run_id)


def read_ledger(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole ledger, or an empty one when there is none yet."""
    fields = schema or T.StructType([*RECORD.fields, T.StructField("ord", T.LongType())])
    try:
        return spark.read.schema(fields).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)


def read_run(spark: SparkSession, path: str, run_id: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of one run: a single partition of the ledger, whose other partitions are not even listed."""
    fields = schema or T.StructType([*RECORD.fields, T.StructField("ord", T.LongType())])
    inside = T.StructType([f for f in fields if f.name != "run_id"])
    rows = read_ledger(spark, f"{path}/run_id={_escaped(spark, run_id)}", inside)
    return rows.withColumn("run_id", F.lit(run_id)).select(*fields.fieldNames())


def export_run_csv(rows: DataFrame, directory: str, run_id: str) -> str:
    """One run as CSV under ``{directory}/{run_id}/records_{run_id}.csv`` (a folder of parts)."""
    path = f"{directory}/{run_id}/records_{run_id}.csv"
    blank_nulls(rows).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
    return path


def write_flags(flags: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add the flags of one or more runs; writing a run's flags again replaces them, with
    ``run_id`` also if it has none any more."""
    _replace_runs(flags.select(*FLAG_COLUMNS).hint("rebalance", "run_id"), path, run_id)


def append_run_log(runs: DataFrame, path: str) -> None:
    """Run log as CSV with the columns of the log, empty where not known yet."""
    have = set(runs.columns)
    row = runs.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields
    ])
    row.write.mode("append").option("header", True).csv(path)


def append_run_meta(meta: DataFrame, path: str) -> None:
    """Run metadata, one JSON line per run."""
    meta.select(*RUN_META.fieldNames()).write.mode("append").json(path)


def load_warehouse(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> bool:
    """Append to a relational table over JDBC, creating it if need be.

    Best effort: a failed connection is logged and reported as False, it does not stop a run.
    """
    try:
        rows.write.jdbc(url, table, mode="append", properties=properties or {})
        return True
    except (PySparkException, Py4JError) as e:
        log.warning("warehouse load of %s skipped: %s", table, str(e).splitlines()[0])
        return False


MAX_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_RUNS = 32  # files a task writes side by side


def write_replicates(matches: DataFrame, summary: DataFrame, directory: str) -> None:
    """Replicate results (one folder per run) and their summary, as CSV.

    The rows are written as they come, a file per run and task: neither moved nor sorted by run.
    """
    conf = matches.sparkSession.conf
    before = conf.get(MAX_WRITERS)
    conf.set(MAX_WRITERS, OPEN_RUNS)
    try:
        matches.write.partitionBy("run").mode("overwrite").option("header", True).csv(f"{directory}/results")
    finally:
        conf.set(MAX_WRITERS, before)
    summary.write.mode("overwrite").option("header", True).csv(f"{directory}/summary")


def attachment_targets(attachments: DataFrame) -> DataFrame:
    """Adds bucket (Company or Personal), year and month for filing an attachment.

    ``attachments``: owner_class, date and whatever else is to be kept.
    """
    return attachments.withColumns({
        "bucket": F.when(F.col("owner_class") == "business", "Company").otherwise("Personal"),
        "year": F.date_format("date", "yyyy"),
        "month": F.date_format("date", "MM"),
    })


def write_attachments(attachments: DataFrame, path: str) -> None:
    """File attachments under bucket / year / month; big months become several files.

    What is filed already, by message and part, is left out, so filing again adds nothing.
    Attachments without these two columns are told apart by all their columns.
    """
    keys = [c for c in ("message_id", "part") if c in attachments.columns] or attachments.columns
    try:
        filed = attachments.sparkSession.read.parquet(path).select(*keys)
        same = reduce(operator.and_, [attachments[k].eqNullSafe(filed[k]) for k in keys])
        # Staged: a folder cannot be read and written in one job.
        attachments = stage_table(attachments.join(filed, same, "left_anti"), "attachments")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    (
        attachment_targets(attachments).hint("rebalance", "bucket", "year", "month")
        .write.partitionBy("bucket", "year", "month").mode("append").parquet(path)
    )
