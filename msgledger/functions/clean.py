"""Type coercion and small repairs of single values."""
from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from msgledger.functions.text import let
from msgledger.schema import MONEY

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_YEAR = r"(\d{4}|\d{2})(?!\d)"
_NUMERIC_DATE = rf"^(\d{{1,2}})[-/. ](\d{{1,2}})[-/. ]{_YEAR}"
_YEAR_FIRST = r"^(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})(?!\d)"
_SCIENTIFIC = r"^\d(?:\.\d+)?[eE]\+?\d{1,2}$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?!\d)"
# A time of day and a weekday may come before the date, a time also before the year.
_TIME = r"\d{1,2}:\d{2}(?::\d{2})?\s+"
_BEFORE = rf"^(?:{_TIME})?(?:[A-Za-z]+(?:,\s*|\s+))?"
_DAY_MONTH = rf"{_BEFORE}(\d{{1,2}})(?:st|nd|rd|th)?[-\s]*([A-Za-z]{{3}})[A-Za-z]*\.?,?[-\s]*(?:{_TIME})?{_YEAR}"
_MONTH_DAY = rf"{_BEFORE}([A-Za-z]{{3}})[A-Za-z]*\.?[-\s]+(\d{{1,2}})(?:st|nd|rd|th)?(?:,\s*|[-\s]+)(?:{_TIME})?{_YEAR}"
_YEAR_MONTH = r"^(\d{4})[-\s]+([A-Za-z]{3})[A-Za-z]*\.?[-\s]+(\d{1,2})(?!\d)"


def to_number(text: Column, to: T.DataType | str = MONEY) -> Column:
    """Commas and spaces group thousands; null when the rest is no number."""
    return F.translate(text, ", ", "").try_cast(to)


def _month(name: Column) -> Column:
    at = F.instr(F.lit(_MONTHS), F.lower(name))
    return F.when(at % 3 == 1, ((at + 2) / 3).cast("int"))


def _full_year(year: Column) -> Column:
    """Two digits mean the year nearest to today that ends in them (fewer than 50 years ahead)."""
    now = F.year(F.current_date())
    guess = (now / 100).cast("int") * 100 + year.cast("int")
    near = F.when(guess >= now + 50, guess - 100).when(guess < now - 50, guess + 100).otherwise(guess)
    return F.when(F.length(year) == 2, near.cast("string")).otherwise(year)


def _ymd(y: Column, m: Column, d: Column) -> Column:
    two = [F.lpad(x.cast("string"), 2, "0") for x in (m, d)]
    return F.concat(y, F.lit("-"), two[0], F.lit("-"), two[1]).try_cast("date")


def to_date(text: Column) -> Column:
    """Free-form date; month first when both readings are possible."""
    def numeric(g: Column) -> Column:
        first, second, year = F.get(g, 0).cast("int"), F.get(g, 1).cast("int"), _full_year(F.get(g, 2))
        return F.when(first <= 12, _ymd(year, first, second)).otherwise(_ymd(year, second, first))

    def groups(t: Column, pattern: str) -> Column:
        return F.array(*[F.regexp_extract(t, pattern, i) for i in (1, 2, 3)])

    def read(t: Column) -> Column:
        def ymd(g: Column) -> Column:
            return _ymd(F.get(g, 0), F.get(g, 1), F.get(g, 2))

        readers = (
            (_YEAR_FIRST, ymd),
            (_COMPACT, ymd),
            (_NUMERIC_DATE, numeric),
            (_DAY_MONTH, lambda g: _ymd(_full_year(F.get(g, 2)), _month(F.get(g, 1)), F.get(g, 0))),
            (_MONTH_DAY, lambda g: _ymd(_full_year(F.get(g, 2)), _month(F.get(g, 0)), F.get(g, 1))),
            (_YEAR_MONTH, lambda g: _ymd(F.get(g, 0), _month(F.get(g, 1)), F.get(g, 2))),
        )
        found = F.lit(None).cast("date")
        for pattern, reader in reversed(readers):
            found = F.when(t.rlike(pattern), let(groups(t, pattern), reader)).otherwise(found)
        return found

    return let(F.trim(text), read)


def coerce(value: Column, to: T.DataType) -> Column:
    """Text -> the type of a record field; null when it does not fit."""
    if isinstance(to, T.DateType):
        return to_date(value)
    if isinstance(to, T.DecimalType):
        return to_number(value, to)
    return value


def account_number(value: Column) -> Column:
    """'12345.0' -> '12345', and the same in scientific notation; anything else stays.

    JSON numbers with a point come back as doubles, from 10^7 on with an exponent.
    """
    def plain(v: Column) -> Column:
        number = F.when(v.rlike(_SCIENTIFIC), v.try_cast("decimal(38,8)"))
        whole = F.when(number == F.floor(number), F.floor(number).cast("string"))
        return F.coalesce(whole, F.regexp_replace(v, r"^(\d+)\.0$", "$1"))

    return let(value, plain)


def account_number_of(value: Column, dtype: T.DataType) -> Column:
    """The same for a column that may be numeric."""
    if isinstance(dtype, T.NumericType):
        return value.cast("bigint").cast("string")
    return account_number(value)


def merchant_name(external: Column, institution: Column, description: Column) -> Column:
    """Counterparty that only repeats the bank's name -> the merchant named in the description.

    Takes the description from its third word on, else its second word, else leaves it.
    """
    words = F.split(F.coalesce(description, F.lit("")), " ", 3)
    echoes = (institution != "") & F.startswith(external, institution)
    return F.when(F.coalesce(echoes, F.lit(False)), F.coalesce(F.get(words, F.lit(2)), F.get(words, F.lit(1)), external)).otherwise(external)


def digits_only(number: Column) -> Column:
    return F.regexp_replace(number, r"\D", "")
