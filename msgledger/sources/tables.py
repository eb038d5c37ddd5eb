"""Dimensions, history tables and the mark where the last run stopped."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from msgledger.functions.clean import digits_only

ACCOUNT = T.StructType([
    T.StructField("internal_account_number", T.StringType()),
    T.StructField("internal_entity", T.StringType()),
    T.StructField("institution", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("position", T.LongType()),
])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_timestamp", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("fetched_messages", T.LongType()),
    T.StructField("processed_transactions", T.LongType()),
    T.StructField("run_hash", T.StringType()),
    T.StructField("config_hash", T.StringType()),
    T.StructField("prompt_hash", T.StringType()),
    T.StructField("model_digest", T.StringType()),
])

RUN_META = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("run_hash", T.StringType()),
    T.StructField("success", T.LongType()),
    T.StructField("failed", T.LongType()),
    T.StructField("latency_sec", T.DoubleType()),
])


def accounts_from(spark: SparkSession, accounts: Sequence[Mapping[str, str]]) -> DataFrame:
    """Account dimension from a configured list; the list order decides clashes."""
    rows = [
        (a["internal_account_number"], a["internal_entity"], a["institution"], a.get("currency"), i)
        for i, a in enumerate(accounts)
    ]
    return spark.createDataFrame(rows, ACCOUNT)


def with_last4(accounts: DataFrame) -> DataFrame:
    """Digits-only number and its last four; accounts with fewer digits are left out."""
    return (
        accounts.withColumn("digits", digits_only(F.trim("internal_account_number")))
        .where(F.length("digits") >= 4)
        .withColumn("last4", F.right("digits", F.lit(4)))
    )


def scan_owners(spark: SparkSession, path: str) -> DataFrame:
    """Owner table: internal_account_number, institution, owner_type, position (file order)."""
    schema = "internal_account_number string, institution string, owner_type string"
    return (
        spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
        .withColumn("position", F.monotonically_increasing_id())
    )


def scan_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).csv(path, header=True)


def scan_run_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_META).json(path)


def high_water_mark(history: DataFrame, column: str, overlap_hours: int = 1,
                    start: str | None = None, force: bool = False) -> DataFrame:
    """One row ``since``: null when forced, else the given start, else the latest mark minus the overlap."""
    overlap = F.expr(f"INTERVAL {int(overlap_hours)} HOURS")
    latest = F.max(F.col(column).cast("timestamp")) - overlap
    if force:
        since = F.lit(None).cast("timestamp")
    elif start:
        since = F.lit(start).cast("timestamp")
    else:
        since = latest
    return history.agg(since.alias("since")) if not (force or start) else history.sparkSession.range(1).select(since.alias("since"))
