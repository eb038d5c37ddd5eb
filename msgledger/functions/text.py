"""Message text: headers, ids, dates, MIME body, HTML."""
from __future__ import annotations

import html
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# One MIME part; its children stay JSON text so any depth can be walked.
PART = (
    "struct<mimeType:string,filename:string,"
    "body:struct<data:string,attachmentId:string>,parts:array<string>>"
)
HEADERS = "struct<headers:array<struct<name:string,value:string>>>"

# Zone names of RFC 2822.
ZONE_OFFSETS = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it as often as ``body`` likes."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Strip Unicode white space on both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def collapse(text: Column) -> Column:
    """Every run of Unicode white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


# --- headers -----------------------------------------------------------------

def headers_of(payload: Column) -> Column:
    """The header list of a JSON payload."""
    return F.from_json(payload, HEADERS)["headers"]


def header(headers: Column, name: str) -> Column:
    """Value of one header; the last one of that name wins."""
    same = F.filter(headers, lambda h: h["name"] == name)
    return F.get(same, F.size(same) - 1)["value"]


def header_map(headers: Column) -> Column:
    """name -> value; of equal names the last one wins."""
    indexed = F.transform(
        headers,
        lambda h, i: F.struct(h["name"].alias("name"), h["value"].alias("value"), i.alias("at")),
    )

    def latest(entries: Column) -> Column:
        return F.filter(
            entries,
            lambda e: ~F.exists(entries, lambda o: (o["name"] == e["name"]) & (o["at"] > e["at"])),
        )

    return F.map_from_entries(
        F.transform(let(indexed, latest), lambda e: F.struct(e["name"], e["value"]))
    )


def canonical_id(headers: Column, source_id: Column) -> Column:
    """Message-ID (or Message-Id) without angle brackets, else the source's id."""
    named = F.coalesce(
        F.nullif(header(headers, "Message-ID"), F.lit("")),
        F.nullif(header(headers, "Message-Id"), F.lit("")),
    )
    return F.coalesce(F.btrim(named, F.lit("<>")), source_id)


_DATE_PARTS = (
    r"^\s*(?:[A-Za-z]+,?\s+)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4}|\d{2})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+([+-]\d{4}|[A-Za-z]+))?"
)


def mail_timestamp(value: Column) -> Column:
    """An RFC 2822 date header as a timestamp; null when it cannot be read.

    Years of two digits are those of the obsolete form: 50 to 99 are in the last century.
    """
    zone_names = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])

    def build(groups: Column) -> Column:
        zone = F.upper(F.get(groups, 6))
        offset = F.when(zone.rlike(r"^[+-]"), zone).otherwise(
            F.coalesce(F.element_at(zone_names, zone), F.lit("+0000"))
        )
        year = F.get(groups, 2)
        century = F.when(F.length(year) == 4, "").when(year < "50", "20").otherwise("19")
        stamp = F.concat_ws(
            " ",
            F.get(groups, 0),
            F.initcap(F.get(groups, 1)),
            F.concat(century, year),
            F.concat_ws(
                ":",
                F.lpad(F.get(groups, 3), 2, "0"),
                F.get(groups, 4),
                F.coalesce(F.nullif(F.get(groups, 5), F.lit("")), F.lit("00")),
            ),
            offset,
        )
        return F.try_to_timestamp(stamp, F.lit("d MMM yyyy HH:mm:ss Z"))

    # All groups by one match: none of them can hold a comma.
    groups = F.split(F.regexp_replace(value, _DATE_PARTS + "(?s:.*)", ",".join(f"${i}" for i in range(1, 8))), ",")
    return F.when(value.rlike(_DATE_PARTS), let(groups, build))


def sent_date(headers: Column, internal_date: Column) -> Column:
    """Day a message was sent, in the session time zone.

    First readable Date header (name in any case), else the source's epoch milliseconds.
    """
    # Only names of that size are lower-cased, which costs much.
    dated = F.filter(headers, lambda h: (F.octet_length(h["name"]) == len("date")) & (F.lower(h["name"]) == "date"))
    stamps = F.array_compact(F.transform(dated, lambda h: mail_timestamp(h["value"])))
    fallback = F.timestamp_millis(internal_date.try_cast("bigint"))
    return F.coalesce(F.get(stamps, F.lit(0)), fallback).cast("date")


# --- MIME tree ---------------------------------------------------------------

def _pop(todo: Column) -> Column:
    return F.slice(todo, F.lit(2), F.greatest(F.size(todo) - 1, F.lit(0)))


def _node_bound(payload: Column) -> Column:
    """Every part is a JSON object, so there are no more parts than opening braces."""
    braces = F.length(payload) - F.length(F.replace(payload, F.lit("{"), F.lit("")))
    return F.sequence(F.lit(1), F.greatest(braces, F.lit(1)))


def first_text_part(payload: Column) -> Column:
    """struct<kind, data> of the first text/plain or text/html part with data, in tree order.

    Walks the tree with a to-do list of JSON texts inside one row: no shuffle and no
    limit on depth. The children of a text part are not visited. Once found (or when
    nothing is left), further steps do nothing.
    """
    state = F.struct(
        F.array(payload).alias("todo"),
        F.lit(None).cast("string").alias("kind"),
        F.lit(None).cast("string").alias("data"),
    )

    def visit(todo: Column, part: Column) -> Column:
        is_text = F.coalesce(part["mimeType"].isin("text/plain", "text/html"), F.lit(False))
        data = F.nullif(part["body"]["data"], F.lit(""))
        hit = is_text & data.isNotNull()
        children = F.when(~is_text, part["parts"])
        return F.struct(
            F.when(children.isNull(), _pop(todo)).otherwise(F.concat(children, _pop(todo))).alias("todo"),
            F.when(hit, part["mimeType"]).alias("kind"),
            F.when(hit, data).alias("data"),
        )

    def step(s: Column, _: Column) -> Column:
        done = s["data"].isNotNull() | (F.size(s["todo"]) == 0)
        return F.when(done, s).otherwise(
            let(F.from_json(F.get(s["todo"], F.lit(0)), PART), lambda part: visit(s["todo"], part))
        )

    return F.aggregate(
        _node_bound(payload), state, step, lambda s: F.struct(s["kind"].alias("kind"), s["data"].alias("data"))
    )


def all_parts(payload: Column) -> Column:
    """Every MIME part in tree order: array<struct<depth, mimeType, filename, attachmentId>>."""
    state = F.struct(
        F.array(F.struct(F.lit(0).alias("depth"), payload.alias("json"))).alias("todo"),
        F.array().cast(
            "array<struct<depth:int,mimeType:string,filename:string,attachmentId:string>>"
        ).alias("parts"),
    )

    def visit(s: Column, part: Column) -> Column:
        depth = F.get(s["todo"], F.lit(0))["depth"]
        children = F.transform(
            F.coalesce(part["parts"], F.array().cast("array<string>")),
            lambda child: F.struct((depth + 1).alias("depth"), child.alias("json")),
        )
        row = F.struct(
            depth.alias("depth"),
            part["mimeType"].alias("mimeType"),
            part["filename"].alias("filename"),
            part["body"]["attachmentId"].alias("attachmentId"),
        )
        return F.struct(
            F.concat(children, _pop(s["todo"])).alias("todo"),
            F.concat(s["parts"], F.array(row)).alias("parts"),
        )

    def step(s: Column, _: Column) -> Column:
        return F.when(F.size(s["todo"]) == 0, s).otherwise(
            let(F.from_json(F.get(s["todo"], F.lit(0))["json"], PART), lambda part: visit(s, part))
        )

    return F.aggregate(_node_bound(payload), state, step, lambda s: s["parts"])


def decode_base64url(data: Column) -> Column:
    """base64url -> text; bytes that are not UTF-8 are left out, what is no base64 gives null.

    Padding may be missing, and blanks are ignored.
    """
    def clean(text: Column) -> Column:
        return F.when(F.is_valid_utf8(text), text).otherwise(
            F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit(""))
        )

    def decode(packed: Column) -> Column:
        bare = F.rtrim(packed, F.lit("="))
        padded = F.concat(bare, F.repeat(F.lit("="), F.pmod(-F.length(bare), F.lit(4))))
        valid = bare.rlike(r"^[A-Za-z0-9+/]*$") & (F.length(bare) % 4 != 1)
        return let(F.when(valid, F.try_to_binary(padded, F.lit("base64"))).cast("string"), clean)

    # Blanks are dropped, the two letters of the URL alphabet replaced. Few texts hold blanks, and
    # looking at every character for them costs more than the decoding.
    plain = F.replace(F.replace(data, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
    return let(let(plain, lambda p: F.when(p.rlike(r"[ \t\r\n]"), F.translate(p, " \t\r\n", "")).otherwise(p)), decode)


# --- HTML --------------------------------------------------------------------

# Elements whose text is not content, comments, then any other markup. A quoted
# attribute value may hold '>'.
_HIDDEN = r"(?is)<(script|style|template|rt|rp)\b[^>]*>.*?(?:</\1\s*>|\z)"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_TAG = r"""(?s)<[a-zA-Z/!?](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""

def unescape(text: Column, times: int | Column = 1) -> Column:
    """Decode HTML entities, ``times`` over.

    Every text goes through Python once, in Arrow batches; those without '&' come back as they are.
    An expression that told the others apart would make the text again each time it reads it.
    """
    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, counts in batches:
            yield pd.Series([
                text if text is None or "&" not in text else reduce(lambda t, _: html.unescape(t), range(n), text)
                for text, n in zip(texts, counts)
            ], dtype=object)

    return decode(text, times if isinstance(times, Column) else F.lit(times))


def strip_markup(source: Column) -> Column:
    """HTML source -> its text with the markup blanked out, entities still encoded."""
    visible = F.regexp_replace(F.regexp_replace(source, _HIDDEN, " "), _COMMENT, " ")

    def blank_tags(text: Column) -> Column:
        # No tag ends behind the last '>'; not looking there keeps open tags linear.
        tail = F.substring_index(text, ">", -1)
        head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
        return F.concat(F.regexp_replace(head, _TAG, " "), tail)

    return let(visible, blank_tags)


def html_text(source: Column) -> Column:
    """Visible text of an HTML source, decoded twice as the mail path does."""
    return collapse(unescape(strip_markup(source), 2))


def body_text(kind: Column, data: Column, snippet: Column) -> Column:
    """Readable body from a chosen part, else the snippet, else an empty text.

    A part that cannot be decoded counts as none.
    """
    decoded = decode_base64url(data)
    is_html = F.coalesce(kind == "text/html", F.lit(False))
    visible = F.when(is_html, strip_markup(decoded)).otherwise(decoded)
    text = collapse(unescape(visible, F.when(is_html, 2).otherwise(1)))
    return F.coalesce(text, snippet, F.lit(""))
