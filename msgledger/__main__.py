"""Command line: one batch run, a replicate run, or the monitors.

    spark-submit ... -m msgledger run --messages IN --generated GEN --accounts ACC --out DIR
    ... replicates --messages IN --generated GEN --accounts ACC --out DIR --runs N
    ... quality --meta FILE [--runs N]
    ... zscores --ledger DIR
"""
from __future__ import annotations

import argparse
import time
import uuid
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from msgledger.operators import monitor as mon
from msgledger.operators.fingerprint import fingerprint_of
from msgledger.operators.messages import parse_messages, read_messages, schema_text
from msgledger.operators.validate import FLAG_COLUMNS
from msgledger.options import Options, Thresholds
from msgledger.plans.runs import LEDGER, Paths, batch_run, replicate_run, run_metadata
from msgledger.session import get_spark, stage_table
from msgledger.sinks import tables as sinks
from msgledger.sources import landing, tables as src


def inbox(spark: SparkSession, args) -> DataFrame:
    """Landed messages that pass the filter, with the text generated for them."""
    messages = read_messages(landing.scan_messages(spark, args.messages, args.format))
    cond = landing.query_filter(args.query, label=args.label, since=args.since, words_in=("subject", "body"))
    messages = messages.where(cond)
    if args.senders:
        messages = landing.from_senders(messages, landing.scan_senders(spark, args.senders))
    if args.max_results:
        messages = landing.first_messages(messages, args.max_results)
    return messages.select("message_id", "ord", "sender", "subject", "body")


def generated(spark: SparkSession, args, run: int | None = None) -> DataFrame:
    """message_id and generated_text, of one replicate if asked for."""
    texts = spark.read.schema("message_id string, generated_text string, run int").format(args.format).load(args.generated)
    if run is not None:
        texts = texts.where(F.col("run") == run)
        if texts.isEmpty():
            raise ValueError(f"{args.generated}: no texts of run {run}; replicates compare texts generated once per run")
    return texts.select("message_id", "generated_text")


def accounts(spark: SparkSession, path: str) -> DataFrame:
    fields = "internal_account_number string, internal_entity string, institution string, currency string, position bigint"
    return spark.read.schema(fields).csv(path, header=True, enforceSchema=False)


def since(spark: SparkSession, args) -> str | None:
    """Where to start: nowhere when forced, the given date, else when the last run began less the overlap.

    Run times are this program's own; a date read from a message may lie in any year.
    """
    if args.force:
        return None
    if args.start_date:
        return args.start_date
    try:
        mark = src.high_water_mark(src.scan_run_log(spark, f"{args.out}/run_log"), "run_timestamp", args.overlap_hours).first()["since"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return mark.strftime("%Y-%m-%d") if mark else None


def run(spark: SparkSession, args) -> None:
    started, run_id = time.time(), args.run_id or uuid.uuid4().hex
    args.since = since(spark, args)
    paths = Paths(f"{args.out}/ledger", f"{args.out}/flags", f"{args.out}/run_log")
    messages = inbox(spark, args).join(generated(spark, args), "message_id", "left")
    summary = batch_run(messages, accounts(spark, args.accounts), run_id, paths).first()
    rows = sinks.read_run(spark, paths.ledger, run_id, LEDGER)
    sinks.append_run_log(
        spark.createDataFrame(
            [(run_id, time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(started)), args.since, summary["fetched"], summary["written"],
              fingerprint_of(rows), sha256(repr(Options()).encode()).hexdigest(), sha256(schema_text().encode()).hexdigest(), args.model_digest)],
            "run_id string, run_timestamp string, start_date string, fetched_messages bigint, processed_transactions bigint, "
            "run_hash string, config_hash string, prompt_hash string, model_digest string",
        ), paths.run_log,
    )
    flag_schema = ", ".join(f"{c} string" for c in FLAG_COLUMNS)
    flags = spark.read.schema(flag_schema).parquet(paths.flags)
    sinks.append_run_meta(run_metadata(rows, flags, run_id, time.time() - started), f"{args.out}/run_meta")
    print(summary.asDict())


def replicates(spark: SparkSession, args) -> None:
    args.since = None if args.force else args.start_date
    messages, listed = stage_table(inbox(spark, args), "inbox"), accounts(spark, args.accounts)

    def parse(rows: DataFrame, n: int) -> DataFrame:
        """One replicate: the texts generated for it, timed over the whole parse."""
        start = time.time()
        rows = rows.join(generated(spark, args, n), "message_id", "left")
        parsed = stage_table(parse_messages(rows, listed, f"replicate-{n}"), "replicate")
        latency = int((time.time() - start) * 1000)
        fields = [c for c in parsed.columns if c not in ("ord", "sender", "subject", "errors", "parse_path")]
        record = F.map_from_arrays(
            F.array(*[F.lit(c) for c in fields]), F.array(*[F.col(c).cast("string") for c in fields])
        )
        return parsed.select(F.lit(n).alias("run"), "message_id", record.alias("record"),
                             F.lit(latency).cast("bigint").alias("latency_ms"))

    options = Options(thresholds=Thresholds(alpha=args.alpha))
    matches, summary = replicate_run(messages, parse, args.runs, options)
    sinks.write_replicates(matches, summary, args.out)
    summary.show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="msgledger")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "replicates"):
        p = commands.add_parser(name)
        for option in ("--messages", "--generated", "--accounts", "--out"):
            p.add_argument(option, required=True)
        p.add_argument("--format", default="json")
        for option in ("--label", "--query", "--senders", "--start-date", "--run-id", "--model-digest"):
            p.add_argument(option)
        p.add_argument("--max-results", type=int)
        p.add_argument("--overlap-hours", type=int, default=1)
        p.add_argument("--force", action="store_true")
        p.add_argument("--runs", type=int, default=30)
        p.add_argument("--alpha", type=float, default=0.05)
    quality = commands.add_parser("quality")
    quality.add_argument("--meta", required=True)
    quality.add_argument("--runs", type=int)
    commands.add_parser("zscores").add_argument("--ledger", required=True)
    args = parser.parse_args(argv)

    spark = get_spark()
    if args.command == "run":
        run(spark, args)
    elif args.command == "replicates":
        replicates(spark, args)
    elif args.command == "quality":
        mon.p_chart(src.scan_run_meta(spark, args.meta), args.runs).show(truncate=False)
    else:
        daily = mon.daily_counts(sinks.read_ledger(spark, args.ledger, LEDGER))
        mon.outliers(mon.trailing_zscores(daily)).show(truncate=False)


if __name__ == "__main__":
    main()
