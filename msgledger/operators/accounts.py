"""Account resolution: suffixes, transfers, owners."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from msgledger.functions.clean import digits_only, merchant_name
from msgledger.operators.joins import lookup
from msgledger.options import LIMITS, Limits, MaskOptions
from msgledger.session import stage_table


@dataclass(frozen=True)
class Sizes:
    """Upper bounds for everything derived from an account table; None when it is not small."""

    accounts: int | None
    endings: int | None

    @property
    def small(self) -> bool:
        return self.accounts is not None and self.endings is not None


def account_sizes(accounts: DataFrame, limits: Limits = LIMITS) -> Sizes:
    """One count of the account table that bounds all look-ups made from it."""
    top = limits.broadcast_rows
    counted = accounts.limit(top + 1).agg(
        F.count("*").alias("n"), F.sum(F.length("internal_account_number")).alias("endings")
    ).first()
    n, endings = counted["n"], counted["endings"] or 0
    return Sizes(n if n <= top else None, endings if n <= top and endings <= top else None)


def suffix_dimension(accounts: DataFrame, length: int = 4) -> DataFrame:
    """suffix -> account; on a clash the account listed last wins."""
    fields = ["internal_account_number", "internal_entity", "institution"]
    return (
        accounts.withColumn("suffix", F.right("internal_account_number", F.lit(length)))
        .groupBy("suffix")
        .agg(F.max_by(F.struct(*fields), "position").alias("account"))
    )


def suffix_lookup(rows: DataFrame, accounts: DataFrame, number: str, length: int = 4,
                  limits: Limits = LIMITS) -> DataFrame:
    """Adds ``account`` (struct or null): the account with the same last digits as ``number``."""
    keyed = rows.withColumn("suffix", F.right(number, F.lit(length)))
    return lookup(keyed, suffix_dimension(accounts, length), ["suffix"], "left", limits).drop("suffix")


def ending_dimension(accounts: DataFrame, limits: Limits = LIMITS, rows: int | None = None) -> DataFrame:
    """Every ending of every account number -> the account listed first that has it.

    Turns the ends-with match into an equi-join on the whole value. Each account becomes as many
    rows as its number has characters, so a table that few tasks would read is dealt out to more of
    them first. ``rows``: an upper bound of the accounts, if counted already.
    """
    tasks = -(-(accounts.count() if rows is None else rows) // max(limits.exploded_rows, 1))
    if tasks > 1:
        accounts = accounts.repartition(tasks, "internal_account_number", "position")
    ending = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.length("internal_account_number")),
            lambda n: F.right("internal_account_number", n),
        )
    )
    return (
        accounts.where(F.length("internal_account_number") > 0)
        .select(ending.alias("ending"), "position", "internal_entity", "institution")
        .groupBy("ending")
        .agg(F.min_by(F.struct("internal_entity", "institution"), "position").alias("owner"))
    )


def ends_with_lookup(rows: DataFrame, accounts: DataFrame, number: str, limits: Limits = LIMITS) -> DataFrame:
    """Adds ``owner`` (struct or null): first listed account whose number ends with ``number``."""
    keyed = rows.withColumn("ending", F.col(number))
    return lookup(keyed, ending_dimension(accounts, limits), ["ending"], "left", limits).drop("ending")


def is_transfer() -> Column:
    """Whether the type is 'transfer' in any case; only texts of its size are lower-cased, which costs much."""
    kind = F.coalesce("transaction_type", F.lit(""))
    return (F.octet_length(kind) == len("transfer")) & (F.lower(kind) == "transfer")


def _resolution_keys(rows: DataFrame, mask: MaskOptions) -> DataFrame:
    """Adds the look-up keys: ``_ours`` and ``_other`` for transfers, ``_ending`` for the rest.

    Our side is the ending of the internal number; the other side is the second mask when
    the first is ours, else the first.
    """
    masks = F.regexp_extract_all(
        F.when(is_transfer(), F.coalesce("description", F.lit(""))), F.lit(mask.pattern), F.lit(1)
    )
    first, second = F.get("_masks", F.lit(0)), F.get("_masks", F.lit(1))
    ours = F.right(F.coalesce("internal_account_number", F.lit("")), F.lit(mask.suffix_length))
    return (
        rows.withColumn("_masks", masks)
        .withColumn("_ours", F.when(F.size("_masks") >= 2, ours))
        .withColumns({
            "_other": F.when(F.col("_ours").isNotNull(), F.when(first == F.col("_ours"), second).otherwise(first)),
            "_ending": F.when(~is_transfer(), F.nullif("internal_account_number", F.lit(""))),
        })
        .drop("_masks")
    )


_TRANSFER_FIELDS = {
    "internal_account_number": "_own_account.internal_account_number",
    "internal_entity": "_own_account.internal_entity",
    "institution": "_own_account.institution",
    "external_account_number": "_other_account.internal_account_number",
    "external_entity": "_other_account.internal_entity",
}


def resolve_accounts(
    rows: DataFrame, accounts: DataFrame, mask: MaskOptions = MaskOptions(), limits: Limits = LIMITS,
    transfers: bool = True, owners: bool = True, merchants: bool = True, check_allowed: bool = False,
    sizes: Sizes | None = None,
) -> DataFrame:
    """Transfers from both masked numbers, other rows from the account they end with, then merchants.

    A transfer of which not both sides resolve stays as it is. ``check_allowed`` adds
    ``entity_allowed`` and ``institution_allowed``: whether the resolved value is one of the
    account table's. All look-ups are keyed on the rows as they come in. When the account
    table is too big to broadcast, the rows are staged once, the look-ups run on their key
    columns alone, each bounded by its own table, and what they find is joined back once: other
    columns, such as the text, move one time. ``sizes``: of the account table, if counted already.
    """
    sizes = sizes or account_sizes(accounts, limits)
    if "external_account_number" not in rows.columns:
        rows = rows.withColumn("external_account_number", F.lit(None).cast("string"))
    keyed = _resolution_keys(rows, mask)
    keys = ["_ours", "_other", "_ending", "internal_entity", "institution"]
    if not sizes.small:
        # Staged, so that the numbers stay with their rows.
        keyed = stage_table(keyed.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    out = keyed if sizes.small else keyed.select("_row", *keys)

    def held(dim: DataFrame) -> DataFrame:
        return dim if sizes.small else stage_table(dim, "accounts")

    def find(dim: DataFrame, key: str, dim_rows: int | None) -> DataFrame:
        return lookup(out, held(dim), [key], "left", limits, dim_rows if sizes.small else None)

    if transfers:
        dim = held(suffix_dimension(accounts, mask.suffix_length))
        for key in ("_ours", "_other"):
            name = {"_ours": "_own_account", "_other": "_other_account"}[key]
            out = find(dim.select(F.col("suffix").alias(key), F.col("account").alias(name)), key, sizes.accounts)
    if owners:
        out = find(ending_dimension(accounts, limits, sizes.accounts).select(F.col("ending").alias("_ending"), F.col("owner").alias("_owner")),
                   "_ending", sizes.endings)
    if check_allowed:
        for column in ("internal_entity", "institution"):
            known = accounts.select(column).distinct().withColumn(f"_{column}_known", F.lit(True))
            out = find(known, column, sizes.accounts)

    if not sizes.small:
        out = keyed.join(out.drop(*keys), "_row")

    both = F.lit(False)
    if transfers:
        both = F.col("_own_account").isNotNull() & F.col("_other_account").isNotNull()

    def resolved(column: str) -> Column:
        value = F.col(column)
        if owners and column in ("internal_entity", "institution"):
            value = F.coalesce(F.col(f"_owner.{column}"), value)
        if transfers and column in _TRANSFER_FIELDS:
            value = F.when(both, F.col(_TRANSFER_FIELDS[column])).otherwise(value)
        return value

    found = [resolved(c).alias(c) for c in rows.columns]
    if check_allowed:
        from_account = both | F.col("_owner").isNotNull() if owners else both
        found += [
            (from_account | F.coalesce(F.col(f"_{c}_known"), F.lit(False))).alias(flag)
            for c, flag in (("internal_entity", "entity_allowed"), ("institution", "institution_allowed"))
        ]
    out = out.select(*found)
    return fix_merchants(out) if merchants else out


def resolve_transfers(rows: DataFrame, accounts: DataFrame, mask: MaskOptions = MaskOptions(),
                      limits: Limits = LIMITS) -> DataFrame:
    """Only the two-sided transfers."""
    return resolve_accounts(rows, accounts, mask, limits, owners=False, merchants=False)


def fix_merchants(rows: DataFrame) -> DataFrame:
    """Repair counterparties that only repeat the bank's name (no transfers)."""
    fixed = merchant_name(F.col("external_entity"), F.col("institution"), F.col("description"))
    return rows.withColumn("external_entity", F.when(is_transfer(), F.col("external_entity")).otherwise(fixed))


def classify_owners(rows: DataFrame, owners: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Adds ``full_number``, ``owner_institution`` and ``owner_class``.

    A four-digit number is completed from the owner listed last with those digits. An
    owner type other than personal counts as business; no owner is unclassified.
    """
    dim = owners.withColumn(
        "owner_class", F.when(F.col("owner_type") == "personal", "personal").otherwise("business")
    )
    by_last4 = (
        dim.withColumn("_last4", F.right("internal_account_number", F.lit(4)))
        .groupBy("_last4")
        .agg(F.max_by("internal_account_number", "position").alias("_completed"))
    )
    by_number = dim.groupBy(F.col("internal_account_number").alias("full_number")).agg(
        F.max_by("institution", "position").alias("owner_institution"),
        # A number listed under both types counts as personal.
        F.max("owner_class").alias("owner_class"),
    )
    digits = digits_only(F.col("internal_account_number"))
    keyed = rows.withColumn("_last4", F.when(F.length(digits) == 4, digits))
    completed = lookup(keyed, by_last4, ["_last4"], "left", limits).withColumn(
        "full_number", F.coalesce("_completed", "internal_account_number")
    )
    classed = lookup(completed, by_number, ["full_number"], "left", limits)
    return classed.select(
        *rows.columns,
        "full_number",
        F.coalesce("owner_institution", F.lit("")).alias("owner_institution"),
        F.coalesce("owner_class", F.lit("unclassified")).alias("owner_class"),
    )


def duplicate_suffixes(accounts: DataFrame, length: int = 4, limits: Limits = LIMITS) -> DataFrame:
    """Accounts whose last digits also belong to a different account, one row each."""
    keyed = (
        accounts.withColumn("number", F.trim("internal_account_number"))
        .withColumn("digits", digits_only(F.col("number")))
        .where(F.length("digits") >= length)
        .select(F.right("digits", F.lit(length)).alias("suffix"), "number")
    )
    clashing = (
        keyed.groupBy("suffix").agg(F.min("number").alias("low"), F.max("number").alias("high"))
        .where("low <> high").select("suffix")
    )
    return lookup(keyed, clashing, ["suffix"], "left_semi", limits).distinct()
