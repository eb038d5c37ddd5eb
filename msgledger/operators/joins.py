"""Joins that hold up when one key has a third of the rows."""
from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from msgledger.options import LIMITS, Limits


def collect_small(df: DataFrame, max_rows: int, what: str) -> list[Row]:
    """Rows of a frame that must be small; one row too many is an error, not a truncation."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows")
    return rows


def any_of(column: str, values: Sequence[str]) -> Column:
    """Whether a column has one of a few values, as equalities that a Parquet scan tests against its
    Bloom filters; a list of more than ten values would reach it as a range only."""
    tests = [F.col(column) == v for v in values] or [F.lit(False)]
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[k:k + 2]) for k in range(0, len(tests), 2)]
    return tests[0]


def is_small(df: DataFrame, limits: Limits) -> bool:
    """Whether a frame may be broadcast, by rows and by bytes; reads one row too many at most."""
    size = F.lit(0)
    for f in df.schema.fields:
        simple = isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))
        bytes_ = F.lit(8) if simple else F.octet_length(F.col(f"`{f.name}`").cast("string"))
        size = size + F.coalesce(bytes_, F.lit(0)) + 8
    got = df.limit(limits.broadcast_rows + 1).agg(F.count("*").alias("n"), F.sum(size.cast("bigint")).alias("bytes")).first()
    return got["n"] <= limits.broadcast_rows and (got["bytes"] or 0) <= limits.broadcast_bytes


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Keys with more than ``rows`` rows, with their counts.

    Counted with map-side combine on the key columns only; at most (all rows / ``rows``)
    keys can come out.
    """
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > rows)


def hottest(df: DataFrame, keys: Sequence[str], limits: Limits) -> list[Row]:
    """The hot keys with their counts, hottest first.

    A key is hot above ``hot_key_rows`` rows and above its share of all rows divided by
    ``broadcast_rows``; no more than ``broadcast_rows`` keys can be, so none is cut off and
    the list may be broadcast.
    """
    counts = hot_keys(df, keys, 0)
    top = counts.agg(F.max("n").alias("top"), F.sum("n").alias("every")).first()
    least = max(limits.hot_key_rows, (top["every"] or 0) // max(limits.broadcast_rows, 1))
    if (top["top"] or 0) <= least:
        return []
    return sorted(counts.where(F.col("n") > least).collect(), key=lambda r: -r["n"])


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limits: Limits = LIMITS,
    dim_rows: int | None = None,
    count_on: DataFrame | None = None,
    unique: bool = False,
    few: bool = False,
) -> DataFrame:
    """Equi-join a large frame with a dimension that is unique in ``on``.

    A dimension counted as small, in rows and bytes, is broadcast. A larger one is joined by shuffle; the rows
    of a hot key (null counts as one) are then spread over as many salts as they need, and
    only the dimension rows of those keys are repeated, once per salt.

    ``dim_rows``: an upper bound the caller has already counted. ``count_on``: a frame with
    the same key columns that is cheaper to count than ``facts``. ``unique``: ``facts`` has
    each key once, so there is nothing hot to look for. ``few``: so few facts that no key can be
    hot; nothing is counted, and adaptive execution picks the join by the sizes it meets.
    """
    on = list(on)
    if few:
        return facts.join(dim, on, how)
    small = is_small(dim, limits) if dim_rows is None else dim_rows <= limits.broadcast_rows
    if small:
        return facts.join(F.broadcast(dim), on, how)
    if unique:
        return facts.join(dim, on, how)
    hot = hottest((facts if count_on is None else count_on).select(*on), on, limits)
    if not hot:
        return facts.join(dim, on, how)
    spread = _splits(facts, hot, on, limits)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on])
    # By row content, not at random: a repeated task must put each row where it was.
    hashable = [f.name for f in facts.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.when(F.col("_splits").isNotNull(), F.pmod(F.xxhash64(*hashable), F.col("_splits"))).otherwise(F.lit(0))
    salted = facts.join(spread, same, "left").withColumn("_salt", salt.cast("bigint")).select(*facts.columns, "_salt")
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_splits", F.lit(1)) - 1))
    repeated = dim.join(spread, same, "left").select(*dim.columns, salts.alias("_salt"))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def _splits(facts: DataFrame, hot: list[Row], on: list[str], limits: Limits) -> DataFrame:
    """Hot keys with the number of salts each needs, for broadcast."""
    rows = [(*(r[c] for c in on), math.ceil(r["n"] / max(limits.hot_key_rows, 1)) + 1) for r in hot]
    keys = [T.StructField(f"_hot_{c}", facts.schema[c].dataType) for c in on]
    schema = T.StructType([*keys, T.StructField("_splits", T.LongType())])
    return F.broadcast(facts.sparkSession.createDataFrame(rows, schema))


def keep_found(df: DataFrame, column: str) -> DataFrame:
    """The rows in which ``column`` is not null.

    For columns that cost much to make: a filter would be moved below them together with copies of
    their expressions, and each use in a copy would be worked out again. A generator stays in place.
    """
    found = F.explode(F.array_compact(F.array(F.col(f"`{column}`")))).alias(column)
    return df.select(*[found if c == column else F.col(f"`{c}`") for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], count_as: str | None = None) -> DataFrame:
    """The first row of each key by ``order``.

    An aggregate with map-side combine, not a window: the copies of one key collapse in
    every input task before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")]
    if count_as:
        aggs.append(F.count("*").alias(count_as))
    first = df.groupBy(*keys).agg(*aggs)
    return first.select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns],
        *([count_as] if count_as else []),
    )
