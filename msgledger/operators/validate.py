"""Record validation and flagging."""
from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from msgledger.functions.clean import coerce
from msgledger.operators.joins import lookup
from msgledger.options import LIMITS, Limits
from msgledger.schema import RECORD, string_fields

FLAG_COLUMNS = ("run_id", "message_id", "sender", "subject", "reason")
# Set by the run itself or filled by account resolution, so no key is asked for.
STAMPED = ("message_id", "run_id")


def with_allowed(rows: DataFrame, accounts: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Adds ``entity_allowed`` and ``institution_allowed``: whether the account table has the value."""
    for column, flag in (("internal_entity", "entity_allowed"), ("institution", "institution_allowed")):
        allowed = accounts.select(column).distinct().withColumn(flag, F.lit(True))
        rows = lookup(rows, allowed, [column], "left", limits)
        rows = rows.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return rows


def typed_record(schema: T.StructType = RECORD) -> Column:
    """struct of the record fields read into their types; null where a text does not fit."""
    return F.struct(*[coerce(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def record_errors(keys: Column, typed: Column, schema: T.StructType = RECORD, allowed: bool = True) -> Column:
    """array<string>: what is wrong with a row of raw (text) record columns; empty when valid.

    ``keys`` lists the fields that were present; a required field may be present and null
    unless the schema says otherwise. ``typed`` is the row's ``typed_record``.
    """
    checks: list[tuple[Column, str]] = []
    for f in schema.fields:
        col = F.col(f.name)
        if not f.metadata["nullable"]:
            checks.append((col.isNull(), f"{f.name}: null"))
        elif f.metadata["required"] and f.name not in STAMPED:
            present = F.coalesce(F.array_contains(keys, f.name), F.lit(False))
            checks.append((col.isNull() & ~present, f"{f.name}: missing"))
        if not isinstance(f.dataType, T.StringType):
            checks.append((col.isNotNull() & typed[f.name].isNull(), f"{f.name}: unreadable"))
    if allowed:
        for name, flag in (("internal_entity", "entity_allowed"), ("institution", "institution_allowed")):
            checks.append((F.col(name).isNotNull() & ~F.col(flag), f"{name}: not allowed"))
    # Most rows are valid: those stop at the plain test and build no list.
    wrong = reduce(operator.or_, [c for c, _ in checks])
    found = F.array_compact(F.array(*[F.when(c, F.lit(text)) for c, text in checks]))
    return F.when(wrong, found).otherwise(F.array().cast("array<string>"))


def missing_fields(schema: T.StructType = RECORD, also: Sequence[str] = ("available_balance",)) -> Column:
    """array<string>: text fields that are null or empty, then ``also`` fields that are null."""
    texts = [F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in string_fields(schema)]
    others = [F.when(F.col(c).isNull(), F.lit(c)) for c in also]
    return F.array_compact(F.array(*texts, *others))


def missing_flags(rows: DataFrame, schema: T.StructType = RECORD) -> DataFrame:
    """One flag row per record with missing fields, with the message's sender and subject where known."""
    sender = [F.col(c) for c in ("sender", "source_email") if c in rows.columns]
    subject = [F.col("subject")] if "subject" in rows.columns else []
    return (
        rows.withColumn("_missing", missing_fields(schema))
        .where(F.size("_missing") > 0)
        .select(
            F.coalesce("run_id", F.lit("")).alias("run_id"),
            F.coalesce("message_id", F.lit("")).alias("message_id"),
            F.coalesce(*sender, F.lit("")).alias("sender"),
            F.coalesce(*subject, F.lit("")).alias("subject"),
            F.concat(F.lit("missing: "), F.array_join("_missing", ", ")).alias("reason"),
        )
    )


def blank_nulls(rows: DataFrame, schema: T.StructType = RECORD) -> DataFrame:
    """Null text becomes an empty text, dates become text: the shape of the CSV files."""
    out = rows.na.fill("", subset=[c for c in string_fields(schema) if c in rows.columns])
    for f in schema.fields:
        if isinstance(f.dataType, T.DateType) and f.name in rows.columns:
            out = out.withColumn(f.name, F.date_format(f.name, "yyyy-MM-dd"))
    return out
