"""Landed messages, sender lists and attachments."""
from __future__ import annotations

import logging
import operator
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from msgledger.functions import text as tx
from msgledger.operators.joins import lookup
from msgledger.options import LIMITS, Limits

log = logging.getLogger(__name__)

# ``payload`` stays JSON text: it nests to any depth, a column type cannot.
MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("internalDate", T.StringType()),
    T.StructField("snippet", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("ord", T.LongType()),
])


def scan_messages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Raw messages from JSON lines or Parquet; a nested payload is kept as JSON text.

    Works on a mailbox's own fields: ``labelIds`` stands in for ``labels``, and without ``ord``
    the order is that of arrival (20 low bits of a hash of the id settle equal times). A line
    that is no JSON is kept in ``corrupt``, under an id made of it, so that it can be flagged.
    """
    schema = T.StructType([
        *MESSAGE.fields, T.StructField("labelIds", T.ArrayType(T.StringType())), T.StructField("corrupt", T.StringType())])
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "corrupt").format(fmt).load(path)
    arrival = F.shiftleft(F.coalesce(F.col("internalDate").try_cast("bigint"), F.lit(0)).cast("bigint"), 20)
    return raw.withColumns({
        "id": F.coalesce("id", F.concat(F.lit("corrupt-"), F.sha2("corrupt", 256))),
        "labels": F.coalesce("labels", "labelIds"),
        "ord": F.coalesce("ord", arrival + F.pmod(F.xxhash64("id"), F.lit(1 << 20))),
    }).drop("labelIds")


def canonical_query(query: str | Mapping[str, object] | None) -> str:
    """A query mapping as sorted ``key:value`` words; text stays as it is."""
    if isinstance(query, Mapping):
        return " ".join(f"{k}:{query[k]}" for k in sorted(query))
    return query or ""


def message_filter(
    *, label: str | None = None, senders: Sequence[str] = (), subject: str | None = None,
    since: str | None = None,
) -> Column:
    """All given conditions at once; several senders are alternatives.

    Columns used: labels, sender, subject, sent_date. Plain comparisons, so Parquet scans
    can push what they support.
    """
    cond = F.lit(True)
    if label:
        cond = cond & F.array_contains("labels", label)
    if senders:
        anyone = F.lit(False)
        for s in senders:
            anyone = anyone | F.contains(F.lower("sender"), F.lit(s.strip().lower()))
        cond = cond & anyone
    if subject:
        cond = cond & F.contains(F.lower("subject"), F.lit(subject.lower()))
    if since:
        cond = cond & (F.col("sent_date") >= F.lit(since.replace("/", "-")).cast("date"))
    return cond


_TOKEN = re.compile(r'\s*(\(|\)|(?:(\w+):)?(?:"([^"]*)"|([^\s()"]+)))')


def query_filter(query: str | Mapping[str, object] | None, senders: Sequence[str] = (),
                 label: str | None = None, since: str | None = None, words_in: Sequence[str] = ("subject",)) -> Column:
    """The same from a query text: ``label:``, ``from:``, ``subject:`` and ``after:`` terms, free words
    (looked for in ``words_in``), quotes, ``OR`` between terms and brackets around them.

    Anything else is an error; a term that is silently dropped would let everything pass.
    """
    given = message_filter(label=label, senders=senders, since=since)
    if isinstance(query, Mapping):
        terms = [_term(str(k), str(query[k]), words_in) for k in sorted(query)]
        return reduce(operator.and_, terms, given)
    text = (query or "").strip()
    if not text:
        return given
    tokens, at = [], 0
    while at < len(text):
        found = _TOKEN.match(text, at)
        if not found:
            raise ValueError(f"query {text!r}: cannot be read from {text[at:]!r} on")
        tokens.append(found)
        at = found.end()
        at += len(text[at:]) - len(text[at:].lstrip())
    cond, rest = _all_of(tokens, words_in)
    if rest:
        raise ValueError(f"query {text!r}: closing bracket without an opening one")
    return given & cond


def _all_of(tokens: list[re.Match], words_in: Sequence[str]) -> tuple[Column, list[re.Match]]:
    """Terms up to a closing bracket, joined by AND; OR binds its two neighbours."""
    groups: list[Column] = []
    either = False
    while tokens and tokens[0][1] != ")":
        token, tokens = tokens[0], tokens[1:]
        if token[1] == "OR":
            if not groups or either:
                raise ValueError("OR without a term before it")
            either = True
            continue
        if token[1] == "(":
            term, tokens = _all_of(tokens, words_in)
            if not tokens:
                raise ValueError("opening bracket without a closing one")
            tokens = tokens[1:]
        else:
            term = _term(token[2] or "", token[4] if token[3] is None else token[3], words_in)
        groups = [*groups[:-1], groups[-1] | term] if either else [*groups, term]
        either = False
    if either or not groups:
        raise ValueError("a term is missing")
    return reduce(operator.and_, groups), tokens


def _term(key: str, value: str, words_in: Sequence[str]) -> Column:
    if key == "label":
        return message_filter(label=value)
    if key == "from":
        return message_filter(senders=[value])
    if key == "subject":
        return message_filter(subject=value)
    if key == "after":
        return message_filter(since=value)
    if key or value[:1] == "-":
        raise ValueError(f"query term {key + ':' if key else ''}{value} is not supported")
    return reduce(operator.or_, [F.contains(F.lower(c), F.lit(value.lower())) for c in words_in])


def first_messages(messages: DataFrame, max_results: int, order: Sequence[str] = ("ord",)) -> DataFrame:
    """At most ``max_results`` messages, earliest first: a top-n per task, then of those."""
    return messages.orderBy(*order).limit(max_results)


def scan_senders(spark: SparkSession, path: str) -> DataFrame | None:
    """Allow-list: first CSV column, blanks dropped. No file means no filter."""
    try:
        raw = spark.read.csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("sender list %s not found, no sender filter", path)
        return None
    if not raw.columns:
        return None
    return sender_list(raw, raw.columns[0])


def sender_list(raw: DataFrame, column: str) -> DataFrame:
    sender = F.lower(F.trim(F.col(column)))
    return raw.select(sender.alias("sender_key")).where(F.col("sender_key") != "").distinct()


def from_senders(messages: DataFrame, allowed: DataFrame | None, limits: Limits = LIMITS) -> DataFrame:
    """Messages whose sender address, or its domain, is on the list."""
    if allowed is None:
        return messages
    address = F.lower(F.regexp_extract("sender", r"([^\s<>@]+@[^\s<>]+)", 1))
    keyed = messages.withColumn("_address", address).withColumn("_domain", F.substring_index("_address", "@", -1))
    for key in ("_address", "_domain"):
        listed = allowed.select(F.col("sender_key").alias(key), F.lit(True).alias(f"{key}_ok"))
        keyed = lookup(keyed, listed, [key], "left", limits)
    return keyed.where(F.col("_address_ok") | F.col("_domain_ok")).select(*messages.columns)


def pdf_attachments(messages: DataFrame, top_level_only: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row per PDF attachment that can be fetched: message_id, part, filename, attachment_id.

    Parts are walked inside the row, to any depth unless only the top level is asked for.
    ``keep`` carries message columns along, so that no join back is needed. A payload that names
    no PDF and has no escapes, behind which a name could hide, is not walked.
    """
    payload = F.col("payload")
    walked = F.when(payload.rlike(r"(?i)\.pdf|\\"), tx.all_parts(payload))
    parts = messages.select(F.col("id").alias("message_id"), *keep, F.posexplode(walked).alias("part", "p"))
    wanted = F.endswith(F.lower("p.filename"), F.lit(".pdf")) & (F.coalesce("p.attachmentId", F.lit("")) != "")
    if top_level_only:
        wanted = wanted & (F.col("p.depth") == 1)
    return parts.where(wanted).select(
        "message_id", *keep, "part",
        F.col("p.filename").alias("filename"), F.col("p.attachmentId").alias("attachment_id"),
    )
