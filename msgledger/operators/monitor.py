"""Control charts over runs and days."""
from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window, functions as F

from msgledger.functions.stats import clopper_pearson

Z_LIMIT = 3.0
SIGMAS = 3.0


def daily_counts(rows: DataFrame, column: str = "date") -> DataFrame:
    """Records per day; map-side combine, at most one row per calendar day."""
    return rows.groupBy(F.col(column).cast("date").alias("date")).agg(F.count("*").alias("tx_count"))


def global_zscores(daily: DataFrame) -> DataFrame:
    """z of each day against all days (population deviation); null when all are equal.

    The window without keys runs over days, not records.
    """
    days = Window.partitionBy()
    mean, dev = F.avg("tx_count").over(days), F.stddev_pop("tx_count").over(days)
    return daily.withColumn("z", F.when(dev > 0, (F.col("tx_count") - mean) / dev))


def trailing_zscores(daily: DataFrame, days: int = 30) -> DataFrame:
    """z of each day against the ``days`` days before it; null without spread.

    As above, one row per day.
    """
    before = Window.orderBy(F.unix_date("date")).rangeBetween(-days, -1)
    mean, dev = F.avg("tx_count").over(before), F.stddev_pop("tx_count").over(before)
    return daily.withColumn("z", F.when(dev > 0, (F.col("tx_count") - mean) / dev))


def outliers(scored: DataFrame, limit: float = Z_LIMIT) -> DataFrame:
    return scored.where(F.abs("z") > limit)


def run_rates(results: DataFrame, ok: Column) -> DataFrame:
    """Successes and failures per run_id, with the success rate (null without any)."""
    return results.groupBy("run_id").agg(
        F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed")
    ).withColumn("rate", F.try_divide("success", F.col("success") + F.col("failed")))


def last_runs(runs: DataFrame, n: int, by: tuple[str, ...] = ("timestamp", "run_id")) -> DataFrame:
    """The ``n`` latest runs: a top-n per task, then of those."""
    return runs.orderBy(*[F.col(c).desc() for c in by]).limit(n)


def p_chart(runs: DataFrame, n: int | None = None, alpha: float = 0.05) -> DataFrame:
    """One verdict row over the last ``n`` runs (all if None); no row without runs.

    ``runs``: run_id, timestamp, success, failed. ALERT when the latest rate lies outside
    mean +- 3 sigma, or the mean outside the latest run's exact interval.
    """
    window = runs if n is None else last_runs(runs, n)
    total = F.col("success") + F.col("failed")
    p = F.try_divide("success", total)
    rated = window.select(
        "run_id", "timestamp", "success", total.alias("total"), p.alias("p"),
        F.sqrt(F.try_divide(p * (1 - p), total)).alias("dev"),
    )
    chart = rated.agg(
        F.count("*").alias("runs"),
        F.avg("p").alias("mean_rate"),
        F.avg("dev").alias("sigma"),
        F.max_by(F.struct("p", "success", "total"), F.struct("timestamp", "run_id")).alias("latest"),
    ).where("runs > 0")
    bounds = chart.select(
        "runs", "mean_rate",
        F.col("latest.p").alias("last_rate"),
        (F.col("mean_rate") - SIGMAS * F.col("sigma")).alias("lcl"),
        (F.col("mean_rate") + SIGMAS * F.col("sigma")).alias("ucl"),
        clopper_pearson(F.col("latest.success"), F.col("latest.total"), alpha).alias("_ci"),
    ).select("*", F.col("_ci.pmin").alias("ci_low"), F.col("_ci.pmax").alias("ci_high")).drop("_ci")
    outside = F.coalesce((F.col("last_rate") > F.col("ucl")) | (F.col("last_rate") < F.col("lcl")), F.lit(False))
    covered = F.coalesce(F.col("mean_rate").between(F.col("ci_low"), F.col("ci_high")), F.lit(False))
    return bounds.withColumn("status", F.when(outside | ~covered, "ALERT").otherwise("OK"))


def run_summary(batch: DataFrame, run_id: str | Column) -> DataFrame:
    """One row of counts for a run.

    ``batch``: message_id, date, parsed, duplicate (booleans), one row per fetched message.
    """
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    written = F.col("parsed") & ~F.col("duplicate")
    return batch.agg(
        F.count("*").alias("fetched"),
        F.count_if("parsed").alias("parsed"),
        F.count_if("duplicate").alias("duplicate"),
        F.count_if(~F.col("parsed")).alias("failed"),
        F.count_if(written).alias("written"),
        F.max(F.when(written, F.col("date"))).alias("last_transaction"),
    ).select(run.alias("run_id"), "*")
