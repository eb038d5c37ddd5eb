"""Replicate runs: agreement with the baseline run, rates, verdicts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from msgledger.functions.stats import clopper_pearson
from msgledger.operators.joins import lookup
from msgledger.options import LIMITS, Limits, Thresholds

RUN_KEYS = ("run_id",)


def sorted_entries(record: Column) -> Column:
    """Entries of a record map by key, without the run id, which differs by design."""
    kept = F.map_filter(record, lambda k, _: ~k.isin(*RUN_KEYS))
    return F.array_sort(F.map_entries(kept))


def replicate_matches(replicates: DataFrame, baseline_run: int = 1, limits: Limits = LIMITS) -> DataFrame:
    """Each run's record against the baseline run's record of the same message.

    ``replicates``: run, message_id, record (map), latency_ms. Records become two digests
    before anything is shuffled.
    """
    signed = replicates.select(
        "run", "message_id", "latency_ms",
        F.sha2(F.to_json(F.array_sort(F.map_keys("record"))), 256).alias("keys_digest"),
        F.sha2(F.to_json(sorted_entries(F.col("record"))), 256).alias("record_digest"),
    )
    base = signed.where(F.col("run") == baseline_run).select(
        "message_id",
        F.col("keys_digest").alias("base_keys"),
        F.col("record_digest").alias("base_record"),
    )
    return lookup(signed, base, ["message_id"], "inner", limits).select(
        "run", "message_id",
        (F.col("keys_digest") == F.col("base_keys")).alias("struct_match"),
        (F.col("record_digest") == F.col("base_record")).alias("id_match"),
        "latency_ms",
    )


def match_rates(matches: DataFrame) -> DataFrame:
    """Per run: messages, successes and shares; map-side combine, one row per run."""
    return matches.groupBy("run").agg(
        F.count("*").alias("n"),
        F.count_if("struct_match").alias("struct_ok"),
        F.count_if("id_match").alias("id_ok"),
        F.max("latency_ms").alias("latency_ms"),
    ).select(
        "run", "n", "struct_ok", "id_ok",
        (F.col("struct_ok") / F.col("n")).alias("p_struct"),
        (F.col("id_ok") / F.col("n")).alias("p_id"),
        "latency_ms",
    )


def with_interval(counts: DataFrame, successes: str, trials: str, alpha: float = 0.05) -> DataFrame:
    """Adds the exact binomial bounds ``pmin`` and ``pmax``. For aggregated rows."""
    return counts.withColumn("_ci", clopper_pearson(F.col(successes), F.col(trials), alpha)).select(
        "*", "_ci.pmin", "_ci.pmax"
    ).drop("_ci")


def latency_cv(latencies: Column) -> Column:
    """Sample standard deviation over mean; 0 for a single run. An aggregate."""
    return F.when(F.count(latencies) > 1, F.try_divide(F.stddev_samp(latencies), F.avg(latencies))).otherwise(F.lit(0.0))


def replicate_summary(matches: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """One row per run with rates, bounds, latency spread and verdicts.

    The spread is taken over all runs: a window over one row per run.
    """
    rates = with_interval(match_rates(matches), "id_ok", "n", thresholds.alpha)
    runs = Window.partitionBy()
    spread = F.when(
        F.count("latency_ms").over(runs) > 1,
        F.try_divide(F.stddev_samp("latency_ms").over(runs), F.avg("latency_ms").over(runs)),
    ).otherwise(F.lit(0.0))
    return rates.withColumn("latency_cv", spread).select(
        "run",
        "p_struct", (F.col("p_struct") >= thresholds.struct).alias("struct_pass"),
        "p_id", "pmin", "pmax", (F.col("pmin") >= thresholds.identity).alias("id_pass"),
        "latency_ms", "latency_cv", (F.col("latency_cv") <= thresholds.latency_cv).alias("latency_pass"),
    )
