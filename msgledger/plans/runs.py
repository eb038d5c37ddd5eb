"""A batch run and a replicate run, from messages to ledger and reports."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from msgledger.operators.accounts import Sizes
from msgledger.operators.fingerprint import table_fingerprint
from msgledger.operators.ledger import assign_record_ids, dedupe_batch, fill_balances, known_ids, last_balances, max_record_id, new_records
from msgledger.operators.messages import parse_messages, unparsed_flags
from msgledger.operators.replicates import replicate_matches, replicate_summary
from msgledger.operators.validate import missing_flags
from msgledger.options import Options
from msgledger.schema import RECORD
from msgledger.session import scratch, stage_table
from msgledger.sinks import state, tables as sinks


LEDGER = T.StructType([
    *[f if f.name != "available_balance" else T.StructField(f.name, T.DecimalType(28, 2)) for f in RECORD.fields],
    T.StructField("ord", T.LongType()),
    T.StructField("record_id", T.LongType()),
])


SUMMARY = "run_id string, fetched long, parsed long, duplicate long, failed long, written long, last_transaction date"


@dataclass(frozen=True)
class Paths:
    """Where a run writes. With ``balances``, each run goes on from where the accounts stood after the others."""

    ledger: str
    flags: str
    run_log: str
    balances: str | None = None


def batch_run(messages: DataFrame, accounts: DataFrame, run_id: str, paths: Paths,
              options: Options = Options(), arrived: bool = False, sizes: Sizes | None = None) -> DataFrame:
    """Drop copies and known messages, parse, fill balances, number, write; the one-row run summary.

    ``messages``: message_id, ord, body, generated_text, and sender and subject for the flags.
    Ids are settled on their own before any text is read, so only new messages are parsed, once
    each; the parse result is staged once and feeds ledger and flags, and is counted on its way.
    A run may be repeated: its own rows do not count as known, and ledger and flags are replaced.
    What was staged is removed when the run has ended. ``arrived``: the messages are known to be
    new and without copies, so the ledger is not looked at. ``sizes``: of the account table, if
    counted already.
    """
    spark = messages.sparkSession
    with scratch(spark):
        return spark.createDataFrame([_run(messages, accounts, run_id, paths, options, arrived, sizes)], SUMMARY)


def new_messages(messages: DataFrame, master: DataFrame, options: Options = Options()) -> tuple[DataFrame, int]:
    """First copies of messages the master does not have, and the number of messages there were.

    Works on ids; texts move once, and not at all where every message is new. Of copies with
    equal ``ord`` the one with the least content hash counts; only these few are compared by
    content. Ids up to ``options.limits.pushed_ids`` are looked up in the master by name.
    """
    limits = options.limits
    placed = messages.groupBy("message_id", "ord").agg(F.count("*").alias("n"))
    ids = placed.groupBy("message_id").agg(
        F.min("ord").alias("ord"), F.sum("n").alias("copies"), F.coalesce(F.min_by("n", "ord"), F.sum("n")).alias("ties"))
    ids = stage_table(ids, "ids")
    counted = ids.agg(F.sum("copies").alias("fetched"), F.count("*").alias("n")).first()
    fetched = counted["fetched"] or 0
    # An anti-join does not mind repeated ids on its right.
    known = known_ids(master, ids, counted["n"], limits)
    wanted = stage_table(new_records(ids, known, limits=limits, deduped=True), "wanted").select(
        F.col("message_id").alias("_id"), F.col("ord").alias("_ord"), "ties")
    found = wanted.agg(F.count("*").alias("n"), F.max("ties").alias("ties")).first()
    if found["n"] == fetched:
        return messages, fetched

    def of(ids: DataFrame) -> DataFrame:
        same = F.col("message_id").eqNullSafe(F.col("_id")) & F.col("ord").eqNullSafe(F.col("_ord"))
        return messages.join(ids, same, "left_semi")

    if (found["ties"] or 1) == 1:
        return of(wanted), fetched
    hashable = [f.name for f in messages.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tied = of(wanted.where("ties > 1")).withColumn("_hash", F.xxhash64(*hashable))
    return of(wanted.where("ties = 1")).unionByName(dedupe_batch(tied, order="_hash").drop("_hash")), fetched


def _run(messages: DataFrame, accounts: DataFrame, run_id: str, paths: Paths, options: Options, arrived: bool,
         sizes: Sizes | None) -> tuple:
    spark, limits = messages.sparkSession, options.limits
    master = sinks.read_ledger(spark, paths.ledger, LEDGER).where(F.col("run_id") != run_id)
    chosen, fetched = (messages, None) if arrived else new_messages(messages, master, options)
    ok, seen = F.col("parse_path") != "failed", Observation()
    parsed = stage_table(parse_messages(chosen, accounts, run_id, options, sizes).observe(
        seen, F.count_if(ok).alias("good"), F.count_if(~ok).alias("failed"), F.max(F.when(ok, F.col("date"))).alias("last")), "parsed")
    good, count = parsed.where(ok), seen.get
    written = count["good"]
    fetched = written + count["failed"] if fetched is None else fetched
    start = state.last_record_id(spark, paths.ledger, run_id)
    start = max_record_id(master) if start is None else start
    state.mark_record_ids(spark, paths.ledger, run_id, start + written)
    carried = state.carried_balances(spark, paths.balances, run_id) if paths.balances else None
    # Ids depend on dates and input order only, so they come before the balances: sampling
    # for the range shuffle then reads a staged table and not the outcome of a window.
    numbered = assign_record_ids(good, start, limits=limits, total=written)
    filled = fill_balances(numbered, limits=limits, count_on=good, total=written, carried=carried)
    sinks.write_ledger(
        filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER.fields]), paths.ledger, run_id=run_id
    )
    sinks.write_flags(missing_flags(good).unionByName(unparsed_flags(parsed)), paths.flags, run_id)
    if paths.balances:
        state.save_balances(last_balances(sinks.read_run(spark, paths.ledger, run_id, LEDGER)), paths.balances, run_id, start + written)
        state.merge_balances(spark, paths.balances)
    return run_id, fetched, written, fetched - written - count["failed"], count["failed"], written, count["last"]


def replicate_run(messages: DataFrame, parse: Callable[[DataFrame, int], DataFrame], runs: int,
                  options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """Parse the same messages ``runs`` times; returns (matches, summary).

    ``parse`` gives run, message_id, record (map) and latency_ms for one replicate. Each
    replicate is staged, so that comparing does not run the parser again.
    """
    replicates = None
    for run in range(1, runs + 1):
        one = stage_table(parse(messages, run), f"replicate-{run}")
        replicates = one if replicates is None else replicates.unionByName(one)
    matches = replicate_matches(replicates, limits=options.limits)
    return matches, replicate_summary(matches, options.thresholds)


def run_metadata(rows: DataFrame, flags: DataFrame, run_id: str, latency_sec: float) -> DataFrame:
    """One metadata row for a run: fingerprint of its rows, success and failed counts."""
    counted = flags.where(F.col("run_id") == run_id).agg(F.count("*").alias("failed"))
    print_ = table_fingerprint(rows)
    return print_.select(
        F.lit(run_id).alias("run_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("fingerprint").alias("run_hash"),
        (F.col("n_rows") > 0).cast("bigint").alias("success"),
        F.lit(counted.first()["failed"]).cast("bigint").alias("failed"),
        F.lit(round(latency_sec, 3)).alias("latency_sec"),
    )
