"""Field extraction from free text and from generated JSON."""
from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from msgledger.functions.text import let, strip
from msgledger.schema import MONEY

# The patterns that decide what counts as a currency, a number, a date,
# a masked account and a balance.
CURRENCY = r"[A-Z]{3}|[$£\u20A0-\u20CF]"
SPACE = r"[ \u00A0\u2000-\u2060]"
NUMBER = r"\d{1,3}(?:[ ,]\d{3})*(?:[.,]\d{2})|\d+(?:[.,]\d{2})"
AMOUNT = rf"(?iu)({CURRENCY}){SPACE}?({NUMBER})|({NUMBER}){SPACE}?({CURRENCY})"
ISO_DATE = r"(?U)\b(\d{4}-\d{2}-\d{2})\b"
MASKED_LAST4 = r"\*{2,}(\d{4})"
BALANCE_LABELS = (r"Available\s*balance", r"Balance\s*after\s*.*?transaction", r"New\s*balance")
SIMPLE_BALANCE = r"(?iu)Available balance[^\d]{0,20}?(?:R|ZAR)?\s*([\d.,]+)"
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1c-\x1e\x85\u2028\u2029]"
COUNTERPARTY_CHARS = 50

# Cheap tests that every amount and every date pass; they spare texts without any the
# slower patterns.
_CENTS = r"\d[.,]\d{2}"
_DIGIT = r"(?U)\d"


def _group(text: Column, pattern: str, idx: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, idx), F.lit(""))


def clean_number(raw: Column, to: T.DataType | str = MONEY) -> Column:
    """Drop spaces; with a point, commas group thousands, else the comma is the point."""
    packed = F.regexp_replace(raw, SPACE, "")
    plain = F.when(F.contains(packed, F.lit(".")), F.replace(packed, F.lit(","), F.lit(""))).otherwise(
        F.replace(packed, F.lit(","), F.lit("."))
    )
    return plain.try_cast(to)


def labelled_value(text: Column, aliases: Sequence[str]) -> Column:
    """Value after ``alias:``; the last one in the text wins, null when there is none."""
    if not aliases:
        return F.lit(None).cast("string")
    names = "|".join(rf"\Q{a}\E" for a in aliases)
    pattern = rf"(?iudU)(?:{names})\s*:\s*(.+)"
    values = F.regexp_extract_all(F.when(F.contains(text, F.lit(":")), text), F.lit(pattern), F.lit(1))
    return let(values, lambda v: strip(F.get(v, F.size(v) - 1)))


def first_date(text: Column) -> Column:
    """First ISO date; null when it is no day of the calendar."""
    return F.regexp_extract(text, ISO_DATE, 1).try_cast("date")


def first_amount(text: Column) -> Column:
    """struct<amount, currency> of the first currency amount.

    The text is searched once; the groups are read from the short match.
    """
    def read(match: Column) -> Column:
        raw = F.coalesce(_group(match, AMOUNT, 2), _group(match, AMOUNT, 3))
        code = F.coalesce(_group(match, AMOUNT, 1), _group(match, AMOUNT, 4))
        return F.struct(clean_number(raw).alias("amount"), F.upper(code).alias("currency"))

    match = F.when(text.rlike(_CENTS), F.regexp_extract(text, AMOUNT, 0))
    return let(F.coalesce(match, F.lit("")), read)


def masked_last4(text: Column) -> Column:
    """Four digits after two or more stars."""
    # Bound once, since a test for the empty text would search once more.
    return let(F.regexp_extract(text, MASKED_LAST4, 1), lambda g: F.nullif(g, F.lit("")))


def balance(text: Column, with_currency: bool = False) -> Column:
    """struct<balance, currency> after a balance label.

    The label pattern eats everything up to the first digit, so by default no currency
    is read; ``with_currency`` reads it. The gap stops at another whole label: the number
    behind it is the same, and a text of labels alone is read once, not once per label.
    """
    again = f"(?!{BALANCE_LABELS[0]}|{BALANCE_LABELS[2]})"

    def pattern_of(labels: Sequence[str]) -> str:
        gap = rf"(?:{again}[^\d])*?({CURRENCY})?" if with_currency else rf"(?:{again}[^\d])*+"
        return rf"(?iudU)(?:{'|'.join(labels)}){gap}{SPACE}?({NUMBER})"

    pattern = pattern_of(BALANCE_LABELS)
    # Without its last word the second label cannot match, and looking for it in vain from
    # every 'Balance after' would read a long line many times over.
    short = pattern_of((BALANCE_LABELS[0], BALANCE_LABELS[2]))
    match = F.when(text.rlike(r"(?iu)transaction"), F.regexp_extract(text, pattern, 0)).otherwise(
        F.regexp_extract(text, short, 0)
    )

    def read(match: Column) -> Column:
        number = _group(match, pattern, 2 if with_currency else 1)
        code = _group(match, pattern, 1) if with_currency else F.lit(None).cast("string")
        return F.struct(clean_number(number).alias("balance"), F.upper(code).alias("currency"))

    return let(match, read)


def simple_balance(text: Column) -> Column:
    """Number after 'Available balance'; commas group thousands."""
    raw = _group(text, SIMPLE_BALANCE, 1)
    return F.replace(raw, F.lit(","), F.lit("")).try_cast(MONEY)


def counterparty_line(text: Column) -> Column:
    """First line that is not blank and holds neither a date nor an amount, cut to 50 characters."""
    lines = F.transform(F.split(text, LINE_BREAK), strip)

    def has_value(line: Column) -> Column:
        return line.rlike(_DIGIT) & (line.rlike(ISO_DATE) | line.rlike(AMOUNT))

    plain = F.filter(lines, lambda l: (l != "") & ~has_value(l))
    return F.substring(F.get(plain, F.lit(0)), 1, COUNTERPARTY_CHARS)


REGEX_RECORD = T.StructType([
    T.StructField("internal_entity", T.StringType()),
    T.StructField("external_entity", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("internal_account_number", T.StringType()),
    T.StructField("available_balance", MONEY),
])


def text_record(text: Column, synonyms: Mapping[str, Sequence[str]]) -> Column:
    """All text patterns in one struct, under record field names."""
    def read(t: Column) -> Column:
        external = labelled_value(t, synonyms.get("external_entity", ()))

        def combine(amount: Column, bal: Column) -> Column:
            return F.struct(
                labelled_value(t, synonyms.get("internal_entity", ())).alias("internal_entity"),
                F.coalesce(external, counterparty_line(t)).alias("external_entity"),
                first_date(t).alias("date"),
                amount["amount"].alias("amount"),
                F.coalesce(amount["currency"], bal["currency"]).alias("currency"),
                masked_last4(t).alias("internal_account_number"),
                bal["balance"].alias("available_balance"),
            )

        return let(first_amount(t), lambda a: let(balance(t), lambda b: combine(a, b)))

    return let(F.coalesce(text, F.lit("")), read)


def text_record_found(record: Column) -> Column:
    """Whether the patterns read anything at all."""
    return reduce(operator.or_, [record[f.name].isNotNull() for f in REGEX_RECORD.fields])


# --- generated JSON ----------------------------------------------------------

# The first brace opens an object, and the next one closes it.
_FLAT_OBJECT = r"^[^{}]*+(\{[^{}]*+\})"


def first_json_object(text: Column) -> Column:
    """First balanced ``{...}`` of a text, to any depth; braces inside strings count.

    An object without braces inside is found by one plain pattern. Else the text is cut
    after each brace. Read backward, a brace opens a pair if more have closed than opened
    behind it, so a brace that is never closed does not hide the object behind it; the first
    such brace starts the object, and counting forward from there finds its end. Both passes
    keep two numbers.
    """
    pieces = F.split(text, r"(?<=[{}])")

    def backward(s: Column, piece: Column) -> Column:
        brace = F.right(piece, F.lit(1))
        pairs = (brace == "{") & (s["closed"] > 0)
        return F.struct(
            (s["at"] - 1).alias("at"),
            F.when(brace == "}", s["closed"] + 1).when(pairs, s["closed"] - 1).otherwise(s["closed"]).alias("closed"),
            F.when(pairs, s["at"]).otherwise(s["start"]).alias("start"),
        )

    def forward(s: Column, piece: Column) -> Column:
        brace = F.right(piece, F.lit(1))
        depth = s["depth"] + F.when(brace == "{", 1).when(brace == "}", -1).otherwise(0)
        done = F.struct(s["depth"].alias("depth"), s["size"].alias("size"))
        return F.when((s["depth"] == 0) & (s["size"] > 0), done).otherwise(
            F.struct(depth.alias("depth"), (s["size"] + 1).alias("size")))

    def from_start(parts: Column, start: Column) -> Column:
        tail = F.slice(parts, start, F.size(parts) - start + 1)
        size = F.aggregate(tail, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("size")), forward, lambda s: s["size"])
        inner = let(size, lambda n: F.concat(F.lit("{"), F.array_join(F.slice(tail, F.lit(2), n - 1), "")))
        return F.when(start > 0, inner)

    def cut(parts: Column) -> Column:
        first = F.struct(F.size(parts).alias("at"), F.lit(0).alias("closed"), F.lit(0).alias("start"))
        start = F.aggregate(F.reverse(parts), first, backward, lambda s: s["start"])
        # Position 1 where nothing closes keeps the slice valid; its outcome is not used.
        return let(start, lambda at: F.when(at > 0, from_start(parts, F.greatest(at, F.lit(1)))))

    nested = F.when(F.contains(text, F.lit("{")) & F.contains(text, F.lit("}")), let(pieces, cut))
    # One match tells whether the object is flat and gives it.
    return let(F.regexp_extract(text, _FLAT_OBJECT, 1), lambda flat: F.when(flat != "", flat).otherwise(nested))


_CORRUPT = "_corrupt"
_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}


def decode_object(json: Column, fields: Sequence[str]) -> Column:
    """struct of the named keys as strings, null when the JSON is not valid."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in (*fields, _CORRUPT)])
    return let(
        F.from_json(json, schema, _JSON_OPTIONS),
        lambda r: F.when(
            json.isNotNull() & r[_CORRUPT].isNull(), F.struct(*[r[f].alias(f) for f in fields])
        ),
    )


def record_aliases(fields: Sequence[str], synonyms: Mapping[str, Sequence[str]],
                   renames: Mapping[str, str]) -> dict[str, list[str]]:
    """For each record field, every key it may appear under, best first."""
    out: dict[str, list[str]] = {}
    for f in fields:
        names = [f, *synonyms.get(f, ())]
        for old, new in renames.items():
            if new == f:
                names += [old, *synonyms.get(old, ())]
        out[f] = list(dict.fromkeys(names))
    return out


def canonical_fields(decoded: Column, aliases: Mapping[str, Sequence[str]]) -> Column:
    """Pick each record field from its own key, else from the first alias that is present."""
    return F.struct(*[
        F.coalesce(*[decoded[n] for n in names]).alias(f) for f, names in aliases.items()
    ])
