"""What a run leaves for the next one beside the ledger: the last record id, and where accounts stand."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from msgledger.operators.fingerprint import combined, digest_sums
from msgledger.session import delete_folder, stage_table
from msgledger.sinks.tables import _escaped, _replace_runs, clear_run, read_ledger, read_run

BALANCES = "account string, balance decimal(28,2), upto bigint, run_id string"
DIGESTS = "n_rows bigint, w0 decimal(20,0), w1 decimal(20,0), w2 decimal(20,0), w3 decimal(20,0), run_id string"
MERGED = "earlier runs"
MAX_RUNS = 64  # runs of balances kept apart before old ones are merged


def _marks(spark: SparkSession, ledger: str) -> list[tuple[int, str, object]] | None:
    """(last record id, run, path) of the runs that keep a mark, highest first; None if there is no folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/_marks")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [(s.getPath().getName(), s.getPath()) for s in files.listStatus(folder)]
    return sorted(((int(n[:20]), n[21:], p) for n, p in names), key=lambda m: m[:2], reverse=True)


def last_record_id(spark: SparkSession, ledger: str, run_id: str) -> int | None:
    """The last id given out by other runs, without reading the ledger; None if no run has kept a mark."""
    marks = _marks(spark, ledger)
    if marks is None:
        return None
    return max((last for last, run, _ in marks if run != _escaped(spark, run_id)), default=0)


def mark_record_ids(spark: SparkSession, ledger: str, run_id: str, last: int) -> None:
    """Keep the ids up to ``last`` for a run, before its rows are written.

    A mark is an empty file that bears both in its name; those of the two highest runs are enough
    to number any run, also one that is repeated. Rows that get into the ledger without a mark
    must not bring higher record ids.
    """
    name = _escaped(spark, run_id)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/_marks/{last:020d}-{name}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.create(path, True).close()
    seen: set[str] = set()
    for at, run, old in _marks(spark, ledger) or []:
        if len(seen) >= 2 or (run == name and at != last):
            files.delete(old, False)
        elif run not in seen:
            seen.add(run)


def save_balances(balances: DataFrame, path: str, run_id: str, upto: int) -> None:
    """Keep the (account, balance) at the end of a run, whose last record id is ``upto``."""
    rows = balances.select("account", F.col("balance").cast("decimal(28,2)").alias("balance"), F.lit(upto).cast("bigint").alias("upto"),
                           F.lit(run_id).alias("run_id"))
    _replace_runs(rows, path, run_id)


def carried_balances(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """(account, balance) as the other runs have left them. Grows with the accounts and not with the ledger."""
    rows = read_ledger(spark, path, spark.createDataFrame([], BALANCES).schema).where(F.col("run_id") != run_id)
    return rows.groupBy("account").agg(F.max_by("balance", "upto").alias("balance"))


def merge_balances(spark: SparkSession, path: str, keep: int = MAX_RUNS // 2, above: int = MAX_RUNS) -> bool:
    """Make one partition of all but the last ``keep`` runs once there are more than ``above``.

    A run that has been merged can no longer be repeated without seeing its own balances.
    """
    rows = read_ledger(spark, path, spark.createDataFrame([], BALANCES).schema)
    runs = rows.groupBy("run_id").agg(F.max("upto").alias("upto")).orderBy(F.desc("upto")).collect()
    old = [r["run_id"] for r in runs if r["run_id"] != MERGED][keep:]
    if len(runs) <= above or not old:
        return False
    merged = rows.where(F.col("run_id").isin([*old, MERGED])).groupBy("account").agg(
        F.max_by("balance", "upto").alias("balance"), F.max("upto").alias("upto")).withColumn("run_id", F.lit(MERGED))
    # Staged: a folder cannot be read and written in one job. The old runs go last, so none is ever missing.
    _replace_runs(stage_table(merged, "balances"), path, MERGED)
    for run in old:
        delete_folder(spark, f"{path}/run_id={_escaped(spark, run)}")
    return True


def save_digest(spark: SparkSession, ledger: str, manifest: str, run_id: str, schema: T.StructType) -> None:
    """Digest the rows that a run has in the ledger, and no others, into the manifest; a run without rows leaves it."""
    sums = digest_sums(read_run(spark, ledger, run_id, schema)).withColumn("run_id", F.lit(run_id))
    _replace_runs(sums.where("n_rows > 0"), manifest, run_id)


def forget_run(spark: SparkSession, ledger: str, manifest: str, run_id: str) -> None:
    """Take a run out of the ledger and out of its manifest."""
    clear_run(spark, ledger, run_id)
    clear_run(spark, manifest, run_id)


def ledger_fingerprint(spark: SparkSession, manifest: str, schema: T.StructType) -> DataFrame:
    """``n_rows`` and ``fingerprint`` of the whole ledger, from one manifest row per run.

    Equal to ``table_fingerprint`` of its rows. Every run that writes, repeats or leaves the ledger has to
    go through :func:`save_digest` or :func:`forget_run`.
    """
    return combined(read_ledger(spark, manifest, spark.createDataFrame([], DIGESTS).schema), schema.fieldNames())
