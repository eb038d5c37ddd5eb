"""Ledger building: duplicates, balance filling, order, record ids."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from msgledger.operators.joins import any_of, first_per_key, hottest, lookup
from msgledger.operators.ordered import chunk_count, global_rank, ordered_chunks
from msgledger.options import LIMITS, Limits

ACCOUNT = "internal_account_number"


def account_key() -> Column:
    """Rows without an account are one account, whether null or empty."""
    return F.coalesce(F.col(ACCOUNT), F.lit(""))


# --- duplicates --------------------------------------------------------------

def dedupe_batch(rows: DataFrame, key: str = "message_id", order: str = "ord",
                 count_as: str | None = None) -> DataFrame:
    """First occurrence of each message id; ``count_as`` adds how many there were."""
    return first_per_key(rows, [key], [order], count_as)


def new_records(rows: DataFrame, master_ids: DataFrame, key: str = "message_id",
                limits: Limits = LIMITS, deduped: bool = False) -> DataFrame:
    """Rows whose id the master does not hold yet. ``deduped``: the rows' ids are unique."""
    return lookup(rows, master_ids.select(key), [key], "left_anti", limits, unique=deduped)


def known_ids(master: DataFrame, ids: DataFrame, n: int, limits: Limits = LIMITS, key: str = "message_id") -> DataFrame:
    """The ids that ``ids`` (``n`` rows) has to be told apart from.

    A few ids are named in the scan of the master, which then reads only row groups whose Bloom
    filters may hold one of them; with more, the id column is read whole.
    """
    known = master.where(F.col(key) != "").select(key)
    if n > limits.pushed_ids:
        return known
    return known.where(any_of(key, [r[key] for r in ids.select(key).collect() if r[key]]))


def processed_ids(master: DataFrame, key: str = "message_id") -> DataFrame:
    """Distinct non-empty ids of the master."""
    return master.where(F.col(key) != "").select(key).distinct()


def union_ids(known: DataFrame, batch: DataFrame, key: str = "message_id") -> DataFrame:
    """Ids processed so far plus the batch's non-empty ones."""
    return known.select(key).unionByName(processed_ids(batch, key)).distinct()


# --- balances ----------------------------------------------------------------

def _filled(known: Column, last_base: Column, first_base: Column, running: Column, amount: Column,
            mode: str, carried: Column) -> Column:
    """A balance from the last known one before, here or in an earlier run, else from the first known one after.

    ``last_base`` / ``first_base`` are known balance minus running total at that row. Going
    back, the default takes off each row's own amount; ``ledger`` takes off the next row's.
    """
    if mode == "ledger":
        backward = first_base + running
    elif mode == "own":
        backward = first_base + running - amount
    else:
        raise ValueError(f"mode {mode!r}: use 'own' or 'ledger'")
    return F.coalesce(known, last_base + running, carried + running, backward).cast("decimal(28,2)")


def _carried(rows: DataFrame) -> Column:
    return F.col("_carried") if "_carried" in rows.columns else F.lit(None).cast("decimal(28,2)")


def _amount() -> Column:
    return F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(18,2)")


def _first_base(running: Column, mode: str) -> Column:
    base = F.col("available_balance") - running
    return base if mode == "ledger" else base + _amount()


def _fill_by_window(rows: DataFrame, order: list[str], mode: str, forward_only: bool) -> DataFrame:
    """One shuffle by account; the frames run over the same sorted rows."""
    # A column of its own: the windows would not share a shuffle by an expression.
    rows = rows.withColumn("_account", account_key())
    by_account = Window.partitionBy("_account").orderBy(*order)
    so_far = by_account.rowsBetween(Window.unboundedPreceding, 0)
    # The whole partition, not "from here on": that frame is evaluated once per account,
    # and only rows before the first known balance use it.
    whole = by_account.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = rows.withColumn("_s", F.sum(_amount()).over(so_far))
    based = running.withColumns({
        "_last": F.last(F.col("available_balance") - F.col("_s"), ignorenulls=True).over(so_far),
        "_first": F.lit(None).cast("decimal(28,2)") if forward_only
        else F.first(_first_base(F.col("_s"), mode), ignorenulls=True).over(whole),
    })
    filled = _filled(F.col("available_balance"), F.col("_last"), F.col("_first"), F.col("_s"), _amount(), mode, _carried(rows))
    return based.withColumn("available_balance", filled).drop("_s", "_last", "_first", "_account")


def _fill_by_chunks(rows: DataFrame, order: list[str], mode: str, forward_only: bool, chunks: int,
                    limits: Limits) -> DataFrame:
    """The same for accounts too big for one task.

    The account's rows are cut into contiguous pieces, each piece is filled on its own, and
    one summary row per (account, piece) carries totals and known balances across pieces.
    """
    rows = rows.withColumn("_account", account_key())
    placed = ordered_chunks(rows, ["_account", *order], chunks, "balances")
    in_chunk = Window.partitionBy("_account", "_chunk").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_s", F.sum(_amount()).over(in_chunk)).withColumn(
        "_last", F.last(F.col("available_balance") - F.col("_s"), ignorenulls=True).over(in_chunk)
    )
    known_at = F.when(F.col("available_balance").isNotNull(), F.col("_pos"))
    summary = local.groupBy("_account", "_chunk").agg(
        F.sum(_amount()).alias("_total"),
        F.max_by(F.col("available_balance") - F.col("_s"), known_at).alias("_chunk_last"),
        F.min_by(_first_base(F.col("_s"), mode), known_at).alias("_chunk_first"),
    )
    pieces = Window.partitionBy("_account").orderBy("_chunk")
    before = pieces.rowsBetween(Window.unboundedPreceding, -1)
    whole = pieces.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = (
        summary.withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("decimal(28,2)"))
        .withColumns({
            "_carry": F.last(F.col("_chunk_last") - F.col("_base"), ignorenulls=True).over(before),
            "_first": F.lit(None).cast("decimal(28,2)") if forward_only
            else F.first(F.col("_chunk_first") - F.col("_base"), ignorenulls=True).over(whole),
        })
        # The piece number alone is not unique.
        .select(F.struct("_account", "_chunk").alias("_piece"), "_base", "_carry", "_first")
    )
    keyed = local.withColumn("_piece", F.struct("_account", "_chunk"))
    joined = lookup(keyed, carried, ["_piece"], "left", limits)
    total = F.col("_base") + F.col("_s")
    last_base = F.coalesce(F.col("_last") - F.col("_base"), F.col("_carry"))
    filled = _filled(F.col("available_balance"), last_base, F.col("_first"), total, _amount(), mode, _carried(rows))
    return joined.withColumn("available_balance", filled).select(*[c for c in rows.columns if c != "_account"])


def fill_balances(rows: DataFrame, mode: str = "own", forward_only: bool = False,
                  order: tuple[str, ...] = ("date", "ord"), limits: Limits = LIMITS,
                  count_on: DataFrame | None = None, total: int | None = None,
                  carried: DataFrame | None = None) -> DataFrame:
    """Missing balances per account, forward from the last known one, then backward.

    Accounts are counted first (key column only). Those within the limit take one window;
    the others are split in order over many tasks. A missing amount counts as zero.
    ``count_on``: a frame with the same rows that is cheaper to count; ``total``: their number, if
    known. ``carried`` (account, balance; see :func:`last_balances`): where the accounts stood
    before these rows. Rows before the first known balance then go on from there, so runs over
    consecutive slices give the forward balances of one run over all.
    """
    few = total is not None and total <= limits.hot_key_rows
    if carried is not None:
        keyed = rows.withColumn("_key", account_key())
        before = carried.select(F.col("account").alias("_key"), F.col("balance").cast("decimal(28,2)").alias("_carried"))
        joined = lookup(keyed, before, ["_key"], "left", limits, few=few).drop("_key")
        return fill_balances(joined, mode, forward_only, order, limits, count_on, total).drop("_carried")
    if few:
        return _fill_by_window(rows, list(order), mode, forward_only)
    counted = (rows if count_on is None else count_on).select(account_key().alias(ACCOUNT))
    hot = hottest(counted, [ACCOUNT], limits)
    if not hot:
        return _fill_by_window(rows, list(order), mode, forward_only)
    spark = rows.sparkSession
    names = spark.createDataFrame([(r[ACCOUNT],) for r in hot], "hot_account string")
    is_hot = account_key() == F.col("hot_account")
    hot_rows = rows.join(F.broadcast(names), is_hot, "left_semi")
    cold_rows = rows.join(F.broadcast(names), is_hot, "left_anti")
    chunks = chunk_count(sum(r["n"] for r in hot), limits)
    return _fill_by_window(cold_rows, list(order), mode, forward_only).unionByName(
        _fill_by_chunks(hot_rows, list(order), mode, forward_only, chunks, limits)
    )


def last_balances(filled: DataFrame, order: tuple[str, ...] = ("date", "ord")) -> DataFrame:
    """(account, balance) of the accounts that have one: the balance of their last row."""
    known = filled.where(F.col("available_balance").isNotNull())
    return known.groupBy(account_key().alias("account")).agg(F.max_by("available_balance", F.struct(*order)).alias("balance"))


# --- order and ids -----------------------------------------------------------

def bucket_order(rows: DataFrame, limits: Limits = LIMITS, few: bool = False) -> DataFrame:
    """Adds ``bucket_ord``: where the row's account first appears in the input."""
    first = rows.groupBy(account_key().alias("_bucket")).agg(F.min("ord").alias("bucket_ord"))
    keyed = rows.withColumn("_bucket", account_key())
    return lookup(keyed, first, ["_bucket"], "inner", limits, few=few).drop("_bucket")


BATCH_ORDER = ("date", "bucket_ord", "ord")


def order_batch(rows: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Batch in ledger order: by date, then by account appearance, then input order."""
    return bucket_order(rows, limits).orderBy(*BATCH_ORDER)


def max_record_id(master: DataFrame, column: str = "record_id") -> int:
    """Largest integer id in the master; text that is no integer does not count."""
    top = master.agg(F.max(F.col(column).try_cast("bigint")).alias("top")).first()["top"]
    return max(int(top or 0), 0)


def assign_record_ids(rows: DataFrame, start: int | Column = 0, name: str = "record_id",
                      limits: Limits = LIMITS, total: int | None = None) -> DataFrame:
    """Sequential ids in ledger order, from ``start`` + 1.

    Uses the rows' ``bucket_ord`` where :func:`bucket_order` has already been applied.
    ``total``: the number of rows, if known, sets how many pieces they are sorted in.
    """
    chunks = None if total is None else max(
        chunk_count(total, limits), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    few = total is not None and total <= limits.hot_key_rows
    placed = rows if "bucket_ord" in rows.columns else bucket_order(rows, limits, few)
    return global_rank(placed, BATCH_ORDER, name, start, chunks, limits).drop("bucket_ord")


def append(master: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is null there."""
    return master.unionByName(batch, allowMissingColumns=True)


def merged(master: DataFrame, batch: DataFrame, date: str = "date", tie: str = "ord") -> DataFrame:
    """Master and batch in date order, unreadable dates first, the master before the batch."""
    both = append(
        master.withColumn("_side", F.lit(0)), batch.withColumn("_side", F.lit(1))
    )
    return both.orderBy(F.col(date).cast("string").try_cast("date").asc_nulls_first(), "_side", tie).drop("_side")


def last_date(master: DataFrame) -> DataFrame:
    """One row: the latest date in the master."""
    return master.agg(F.max("date").alias("last_date"))
