"""Table fingerprints that do not depend on row order or partitioning."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from msgledger.functions.digest import row_digest
from msgledger.operators.joins import collect_small

_WORDS = 4
_WORD_HEX = 16
_MODULUS = Decimal(1 << 64)

# Columns that order a table by time, best first.
TIME_COLUMNS = ("timestamp", "date", "run_timestamp")

FINGERPRINT_COLUMNS = ("run_hash", "config_hash", "prompt_hash", "model_digest")


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``fingerprint`` of the table as a multiset of rows.

    Row digests are added up word by word modulo 2^64, so each task sends on one row
    whatever the size or skew, and copies count as often as they occur. The sums hold 10^18
    rows. A table without rows is told from others by its column names, too.
    """
    return combined(digest_sums(df), df.columns)


def digest_sums(df: DataFrame) -> DataFrame:
    """One row that stands for a part of a table: ``n_rows`` and four sums of row digests modulo 2^64."""
    words = df.select(row_digest(df.columns).alias("h")).select(F.lit(1).alias("n_rows"), *[
        F.conv(F.substring("h", 1 + i * _WORD_HEX, _WORD_HEX), 16, 10).cast("decimal(38,0)").alias(f"w{i}")
        for i in range(_WORDS)
    ])
    return _added(words)


def _added(words: DataFrame) -> DataFrame:
    sums = words.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        # Null only without rows: a sum that overflows must not pass for zero.
        *[F.when(F.count("*") == 0, F.lit(0).cast("decimal(38,0)")).otherwise(F.sum(f"w{i}")).alias(f"s{i}") for i in range(_WORDS)],
    )
    return sums.select("n_rows", *[(F.col(f"s{i}") % F.lit(_MODULUS)).cast("decimal(20,0)").alias(f"w{i}") for i in range(_WORDS)])


def combined(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The fingerprint of a table with these columns from the sums of its parts, in any order."""
    whole = _added(parts.select("n_rows", *[F.col(f"w{i}").cast("decimal(38,0)").alias(f"w{i}") for i in range(_WORDS)]))
    text = F.concat_ws(":", F.lit(",".join(sorted(columns))), F.col("n_rows").cast("string"), *[F.col(f"w{i}").cast("string") for i in range(_WORDS)])
    return whole.select("n_rows", F.sha2(text, 256).alias("fingerprint"))


def folder_fingerprint(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: digest over several tables, in name order."""
    parts = None
    for name in sorted(tables):
        part = table_fingerprint(tables[name]).select(F.lit(name).alias("name"), "n_rows", "fingerprint")
        parts = part if parts is None else parts.unionByName(part)
    # One row per table, so the list is as long as the argument.
    listed = F.array_sort(F.collect_list(F.struct("name", "fingerprint")))
    return parts.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sha2(F.array_join(F.transform(listed, lambda p: p["fingerprint"]), "\n"), 256).alias("fingerprint"),
    )


def canonical_order(df: DataFrame) -> DataFrame:
    """Columns by name; rows by the first time column there is, then by all columns.

    A running tag ends the sort key, so that copies of one row may share many tasks.
    """
    columns = sorted(df.columns)
    time = [c for c in TIME_COLUMNS if c in columns][:1]
    return (
        df.select(*columns).withColumn("_tag", F.monotonically_increasing_id())
        .orderBy(*time, *columns, "_tag").drop("_tag")
    )


def update_run_log(log: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Write fingerprint columns to the rows of their run; columns not there yet are added."""
    names = [c for c in fingerprints.columns if c != "run_id"]
    new = fingerprints.select("run_id", *[F.col(c).alias(f"_{c}") for c in names])
    for c in names:
        if c not in log.columns:
            log = log.withColumn(c, F.lit(""))
    joined = log.join(new, "run_id", "left")
    return joined.select(*[
        F.coalesce(f"_{c}", c).alias(c) if c in names else F.col(c) for c in log.columns
    ])


def fingerprint_of(df: DataFrame) -> str:
    return collect_small(table_fingerprint(df), 1, "fingerprint")[0]["fingerprint"]
