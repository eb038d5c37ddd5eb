"""Find secrets in texts, with DataFrame functions only.

Three patterns name the usual forms: an assignment to a telling name, an access key, a run of
hexadecimal digits. Beyond them, every long enough run of a character class is a candidate: a
window slides over it, counts of its characters are carried from window to window (one comes, one
goes), and with them the sum of c log2 c that makes the Shannon entropy. Windows of high entropy
are spans of their own, unless the candidate is on the allow-list (plain words, numbers, UUIDs, ...).

The sum is kept in whole steps of 2^-20 bit, so the verdict does not depend on rounding order. Where
a match begins is the length of all that lies before, summed up in blocks, so time grows with the
text and not with the square of its matches.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 256
UNIT = 1 << 20
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16
SPANS = "array<struct<start: bigint, place: int, end: bigint, kind: string>>"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The forms looked for. Names of an assignment are found in either case of their ASCII letters.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(" + "|".join(map(_either_case, NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A key or run that is too short never matches, and a long one matches whole.
ACCESS = f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}"
HEX = f"[0-9a-f]{{{MIN_HEX},}}"
BASE = ("assign", "access", "hex")


class CharClass(NamedTuple):
    """Runs of ``chars`` (inside [] of a pattern, and spelled out in ``alphabet``), the window's length and
    the bits a character that its entropy must reach."""

    kind: str
    chars: str
    alphabet: str
    window: int
    bits: float

    @property
    def limit(self) -> int:
        """The largest sum of c log2 c, in UNITs, of a window that counts."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)

    @property
    def weights(self) -> list[int]:
        return [round(c * math.log2(c) * UNIT) if c else 0 for c in range(self.window + 1)]


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    CharClass("entropy_hex", "0-9A-Fa-f", _DIGITS + "ABCDEFabcdef", 20, 3.0),
    CharClass("entropy_base64", "A-Za-z0-9+/_=-", _UPPER + _LOWER + _DIGITS + "+/_=-", 20, 3.8),
)
# Candidates that are no secrets, as patterns of the whole run.
ALLOWED = (
    "[0-9]+",
    "[A-Z]?[a-z]+", "[A-Z]+",
    "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    "[=_-]*[A-Za-z]+([/_-]+[A-Za-z]+)*[=/_-]*",
    "(0123456789|[Aa][Bb][Cc][Dd][Ee][Ff]|[Gg][Hh][Ii][Jj][Kk][Ll][Mm][Nn][Oo][Pp][Qq][Rr][Ss][Tt][Uu][Vv][Ww][Xx][Yy][Zz])+[+/=]*",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums(steps: Column, start: Column) -> Column:
    """Running sums of a short array."""
    zero = F.struct(start.cast("bigint").alias("t"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(steps, zero, lambda s, x: F.struct(
        (s["t"] + x).alias("t"), F.concat(s["out"], F.array(s["t"] + x)).alias("out")))["out"]


def _running(steps: Column) -> Column:
    """Running sums of an array of any length, block by block."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def block(values: Column, b: Column) -> Column:
        return F.slice(values, b * BLOCK + 1, F.lit(BLOCK))

    def of(values: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        totals = F.transform(blocks, lambda b: total(block(values, b)))
        return _let(F.struct(totals.alias("t"), _sums(totals, F.lit(0)).alias("upto")), lambda k: F.flatten(F.transform(
            blocks, lambda b: _sums(block(values, b), F.get(k["upto"], b) - F.get(k["t"], b)))))

    return _let(steps, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(F.array().cast("array<bigint>")))


def _found(text: Column, pattern: str, group: int) -> Column:
    """(start, end, value) of a pattern's matches from the left; value is one of its groups."""
    regex = F.lit(pattern)
    whole = F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    values = F.regexp_extract_all(text, regex, F.lit(group))
    found = _let(F.struct(whole.alias("n"), gaps.alias("gap"), values.alias("value")), lambda m: _let(
        _running(F.zip_with(F.slice(m["gap"], F.lit(1), F.size(m["n"])), m["n"], lambda a, b: a + b)),
        lambda ends: F.transform(ends, lambda end, i: F.struct(
            (end - F.get(m["n"], i)).alias("start"), end.alias("end"), F.get(m["value"], i).alias("value")))))
    none = F.array().cast("array<struct<start: bigint, end: bigint, value: string>>")
    return F.when(F.contains(text, F.lit("AKIA")) if pattern == ACCESS else text.rlike(pattern), found).otherwise(none)


def _windows(part: Column, kind: CharClass, first: Column) -> Column:
    """(start, end) of the stretches of ``part`` whose windows count; ``first`` is its place."""
    weights, w = F.array(*[F.lit(x).cast("bigint") for x in kind.weights]), kind.window
    spans = "array<struct<start: bigint, end: bigint>>"

    def count(counts: Column, code: Column) -> Column:
        return F.get(counts, code)

    def weight(c: Column) -> Column:
        return F.get(weights, c)

    def step(codes: Column, s: Column, i: Column) -> Column:
        comes, goes = F.get(codes, i), F.when(i >= w, F.get(codes, i - w))
        here = F.when(comes == goes, s["sum"]).otherwise(
            s["sum"] + weight(count(s["counts"], comes) + 1) - weight(count(s["counts"], comes))
            + F.coalesce(weight(count(s["counts"], goes) - 1) - weight(count(s["counts"], goes)), F.lit(0)))
        counts = F.when(comes == goes, s["counts"]).otherwise(F.transform(
            s["counts"], lambda c, k: c + F.when(k == comes, 1).when(k == goes, -1).otherwise(0)))
        begin = first + i - (w - 1)
        last = F.try_element_at(s["out"], F.lit(-1))
        new = F.struct(begin.cast("bigint").alias("start"), (begin + w).cast("bigint").alias("end"))
        longer = F.struct(last["start"].alias("start"), (begin + w).cast("bigint").alias("end"))
        grown = F.when(last["end"] >= begin, F.concat(F.slice(s["out"], F.lit(1), F.size(s["out"]) - 1), F.array(longer))).otherwise(
            F.concat(s["out"], F.array(new)))
        return _let(here, lambda h: F.struct(counts.alias("counts"), h.alias("sum"), F.when(
            (i >= w - 1) & (h <= kind.limit), grown).otherwise(s["out"]).alias("out")))

    zero = F.struct(F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"), F.lit(0).cast("bigint").alias("sum"),
                    F.array().cast(spans).alias("out"))
    codes = F.transform(
        F.sequence(F.lit(1), F.length(part)), lambda i: F.instr(F.lit(kind.alphabet), F.substring(part, i, F.lit(1))) - 1)
    return _let(codes, lambda c: F.aggregate(F.sequence(F.lit(0), F.size(c) - 1), zero, lambda s, i: step(c, s, i))["out"])


def _entropic(text: Column, kind: CharClass, allowed: Sequence[str]) -> Column:
    """(start, end) of a class's spans."""
    w = kind.window

    def scan(run: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.length(run["value"]) - w) / BLOCK).cast("int"))
        return F.flatten(F.transform(blocks, lambda b: _windows(
            F.substring(run["value"], b * BLOCK + 1, F.lit(BLOCK + w - 1)), kind, run["start"] + b * BLOCK)))

    # Only the start of a run is tried: inside one, the look-behind fails.
    runs = _found(text, f"(?<![{kind.chars}])[{kind.chars}]{{{w},}}", 0)
    if allowed:
        plain = "^(?:" + "|".join(allowed) + ")$"
        runs = F.filter(runs, lambda r: ~r["value"].rlike(plain))
    # Spans of neighbouring blocks may overlap; they are in order of both ends.
    return _let(F.flatten(F.transform(runs, scan)), lambda s: F.zip_with(
        F.filter(s, lambda x, i: (i == 0) | (x["start"] > F.coalesce(F.get(s, i - 1)["end"], F.lit(-1)))),
        F.filter(s, lambda x, i: (i == F.size(s) - 1) | (F.coalesce(F.get(s, i + 1)["start"], F.lit(0)) > x["end"])),
        lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end"))))


def secret_spans(text: Column, classes: Sequence[CharClass] = CLASSES, allowed: Sequence[str] = ALLOWED) -> Column:
    """The spans of a text that is not null, by start, then kind: (start, place, end, kind)."""
    assign = F.filter(_found(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= MIN_VALUE)
    kinds = [("assign", assign), ("access", _found(text, ACCESS, 0)), ("hex", _found(text, f"(?<![0-9a-f]){HEX}", 0)),
             *((c.kind, _entropic(text, c, allowed)) for c in classes)]

    def named(k: int, name: str, found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(k).alias("place"), m["end"].alias("end"), F.lit(name).alias("kind")))

    return F.array_sort(F.concat(*(named(k, *pair) for k, pair in enumerate(kinds)))).cast(SPANS)


def scan(docs: DataFrame, classes: Sequence[CharClass] = CLASSES, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """doc_id and ``secrets`` for every row of ``docs``: an array of (start, place, end, kind) by start, then
    kind in the order assign, access, hex, then ``classes``; places count characters, the end
    is exclusive.

    assign is a telling name with a value of 12 characters or more, access a key of 18 or more, hex a run of
    16 or more; the kinds of ``classes`` are stretches of high entropy, and ``allowed`` holds back
    those alone. Kinds may overlap. Null and empty texts have no spans. Texts are whole, however
    long; a row stays in its task. Rows that share a doc_id or a null one are texts of their own.
    Needs doc_id and text, ignores other columns; an empty table gives no rows.
    """
    spans = secret_spans(F.coalesce("text", F.lit("")), classes, allowed)
    return docs.select("doc_id", F.explode(F.array(spans)).alias("secrets"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (``kind:start:end``, comma-joined) of ``scan``."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["place"] < len(BASE))
    return found.select("doc_id", *map(of, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
