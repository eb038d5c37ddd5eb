"""From raw messages to parsed records."""
from __future__ import annotations

import hashlib
import operator
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from msgledger.functions import extract, text as tx
from msgledger.functions.clean import account_number
from msgledger.operators.accounts import Sizes, resolve_accounts
from msgledger.operators.joins import keep_found, lookup
from msgledger.operators.validate import STAMPED, record_errors, typed_record
from msgledger.options import FIELD_RENAMES, LIMITS, Limits, Options
from msgledger.schema import RECORD, TRANSACTIONS
from msgledger.session import stage_table

SUBJECT_CHARS = 120


def read_messages(raw: DataFrame) -> DataFrame:
    """Headers, ids, sent date and body of raw messages; one narrow pass, no shuffle."""
    parsed = raw.withColumns({
        "_headers": tx.headers_of(F.col("payload")),
        "_part": tx.first_text_part(F.col("payload")),
    })
    return parsed.withColumns({
        "message_id": F.col("id"),
        "canonical_id": tx.canonical_id(F.col("_headers"), F.col("id")),
        "sender": F.coalesce(tx.header(F.col("_headers"), "From"), F.lit("")),
        "subject": F.coalesce(tx.header(F.col("_headers"), "Subject"), F.lit("")),
        "sent_date": tx.sent_date(F.col("_headers"), F.col("internalDate")),
        "body": tx.body_text(F.col("_part.kind"), F.col("_part.data"), F.col("snippet")),
    }).drop("_headers", "_part")


def joined_texts(texts: Column) -> Column:
    """Page texts in order, with a blank line between; null when there are none."""
    kept = F.filter(texts, lambda t: t != "")
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n\n"))


def append_attachment_text(messages: DataFrame, attachments: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Body plus attachment text after a blank line. Both sides have one row per message.

    ``attachments``: message_id, texts (array, one row per message).
    """
    added = attachments.select("message_id", joined_texts(F.col("texts")).alias("_pdf"))
    return lookup(messages, added, ["message_id"], "left", limits, unique=True).withColumn(
        "body", F.when(F.col("_pdf").isNotNull(), F.concat_ws("\n\n", "body", "_pdf")).otherwise(F.col("body"))
    ).drop("_pdf")


# Fixed text: the heading and the lines of the account list.
ACCOUNT_HEADING = "Your internal accounts:"
ACCOUNT_LINE = "- %s (%s) (last4=%s)"


def account_reference(accounts: DataFrame) -> Column:
    """The account list as shown in a prompt: one line per last-four, the last account wins.

    ``accounts``: internal_account_number, internal_entity, position. One row is made of the
    table, at most 10,000 lines since there are no more endings, and read as a scalar subquery.
    """
    digits = F.regexp_replace("internal_account_number", r"\D", "")
    four = accounts.withColumn("last4", F.right(digits, F.lit(4))).where(F.length("last4") == 4)
    line = F.format_string(ACCOUNT_LINE, F.trim("internal_entity"), F.trim("internal_account_number"), F.col("last4"))
    last = four.groupBy("last4").agg(F.min("position").alias("at"), F.max_by(line, F.col("position")).alias("line"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"])
    return last.agg(F.array_join(F.concat(F.array(F.lit(ACCOUNT_HEADING)), listed), "\n")).scalar()


def schema_text(spec: Mapping[str, Mapping] = TRANSACTIONS) -> str:
    return ", ".join(f"{n}: {c['type']}{'' if c['required'] else ' (optional)'}" for n, c in spec.items())


def prompt(accounts: DataFrame | None, sender: Column, subject: Column, body: Column,
           spec: Mapping[str, Mapping] = TRANSACTIONS) -> Column:
    """Prompt text: accounts, schema, sender, subject (120 characters at most) and body."""
    return F.concat(_prompt_head(accounts, spec), _prompt_tail(sender, subject, body))


def _prompt_head(accounts: DataFrame | None, spec: Mapping[str, Mapping]) -> Column:
    """What all prompts begin with."""
    listed = F.lit(ACCOUNT_HEADING) if accounts is None else account_reference(accounts)
    return F.concat(listed, F.lit(
        "\n\nAnswer with one JSON object that fits this schema, and nothing else.\n"
        f"<JSON_SCHEMA>\n{schema_text(spec)}\n</JSON_SCHEMA>\n\nFrom: "
    ))


def _prompt_tail(sender: Column, subject: Column, body: Column) -> Column:
    """What a message adds to its prompt."""
    return F.concat(
        F.coalesce(sender, F.lit("")),
        F.lit("\nSubject: "), F.substring(F.coalesce(subject, F.lit("")), 1, SUBJECT_CHARS),
        F.lit('\n\nBody:\n"""'), F.coalesce(body, F.lit("")), F.lit('"""\n\nJSON:\n'),
    )


def prompt_digests(messages: DataFrame, accounts: DataFrame | None, sender: Column, subject: Column, body: Column,
                   spec: Mapping[str, Mapping] = TRANSACTIONS) -> DataFrame:
    """``messages`` with ``chars`` and ``prompt_sha256`` of each :func:`prompt`.

    The account list grows to 10,000 lines and each prompt begins with it, so it is hashed once
    per task and each message goes on from there: the work grows with the messages' own texts.
    """
    head = _prompt_head(accounts, spec)
    shared = messages.sparkSession.range(1).select(head.cast("binary").alias("bytes"), F.length(head).alias("chars")).first()
    begin = bytes(shared["bytes"])

    @F.pandas_udf("string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        begun = hashlib.sha256(begin)

        def whole(tail: bytes) -> str:
            one = begun.copy()
            one.update(tail)
            return one.hexdigest()

        for tails in batches:
            yield tails.map(whole)

    tail = _prompt_tail(sender, subject, body)
    return messages.withColumns({
        "chars": (F.length(tail) + F.lit(shared["chars"])).cast("bigint"), "prompt_sha256": digest(tail.cast("binary"))})


def generated_record(generated: Column, synonyms: Mapping[str, Sequence[str]], all_keys: bool = True) -> Column:
    """struct<keys, rec>: keys present and raw record of the first JSON object, null if none is valid.

    Without ``all_keys``, keys are read only where a required field has no value, which is
    where it matters whether its key was there.
    """
    required = [f.name for f in RECORD.fields if f.metadata["required"] and f.metadata["nullable"] and f.name not in STAMPED]
    fields = [f.name for f in RECORD.fields]
    aliases = extract.record_aliases(fields, synonyms, FIELD_RENAMES)
    wanted = list(dict.fromkeys(n for names in aliases.values() for n in names))

    def read(json: Column) -> Column:
        def with_keys(rec: Column) -> Column:
            keys = F.json_object_keys(json)
            if not all_keys:
                keys = F.when(reduce(operator.or_, [rec[f].isNull() for f in required]), keys)
            return F.struct(keys.alias("keys"), rec.alias("rec"))

        return tx.let(
            extract.decode_object(json, wanted),
            lambda d: F.when(d.isNotNull(), tx.let(extract.canonical_fields(d, aliases), with_keys)),
        )

    return tx.let(extract.first_json_object(generated), read)


def present_fields(keys: Column, synonyms: Mapping[str, Sequence[str]]) -> Column:
    """Record fields for which a key (own or alias) is there, null value or not."""
    fields = [f.name for f in RECORD.fields]
    aliases = extract.record_aliases(fields, synonyms, FIELD_RENAMES)
    return F.array_compact(F.array(*[
        F.when(F.arrays_overlap(keys, F.array(*[F.lit(n) for n in names])), F.lit(f))
        for f, names in aliases.items()
    ]))


def parse_messages(messages: DataFrame, accounts: DataFrame, run_id: str, options: Options = Options(),
                   sizes: Sizes | None = None) -> DataFrame:
    """Hybrid parse: the generated JSON if it is valid, else what the text patterns read.

    ``messages``: message_id, ord, body, generated_text; sender and subject are carried along
    where they are there. Returns the record columns plus ord,
    parse_path ('json', 'regex' or 'failed') and errors (why the JSON was not used).
    Every step is narrow except the look-ups in the account table. Rows of path 'failed'
    carry no fields; they are there to be flagged. ``sizes``: of the account table, if counted
    already.
    """
    syn, fields = options.synonyms, [f.name for f in RECORD.fields]
    decoded = messages.withColumn("_json", generated_record(F.col("generated_text"), syn, all_keys=False))
    # The message's own id and the run id always replace what was generated.
    raw = {f: F.col(f"_json.rec.{f}") for f in fields}
    raw["message_id"], raw["run_id"] = F.col("message_id"), F.lit(run_id)
    raw["internal_account_number"] = account_number(raw["internal_account_number"])
    shown = [c for c in ("sender", "subject") if c in messages.columns]
    flat = decoded.select(
        "ord", "body", *shown,
        F.col("_json").isNotNull().alias("_found"),
        present_fields(F.col("_json.keys"), syn).alias("_keys"),
        *[raw[f].alias(f) for f in fields],
    )
    resolved = resolve_accounts(flat, accounts, options.mask, options.limits, check_allowed=True, sizes=sizes)
    typed = resolved.withColumn("_rec", typed_record()).select(
        "ord", "body", *shown, "message_id", "_rec",
        F.when(F.col("_found"), record_errors(F.col("_keys"), F.col("_rec")))
        .otherwise(F.array(F.lit("no JSON object"))).alias("errors"),
    )
    from_text = F.when(F.size("errors") > 0, extract.text_record(F.col("body"), syn))
    both = typed.withColumn("_text", from_text)
    text_found = F.col("_text").isNotNull() & extract.text_record_found(F.col("_text"))
    path = F.when(F.size("errors") == 0, "json").when(text_found, "regex").otherwise("failed")
    text_fields = set(extract.REGEX_RECORD.fieldNames())

    def pick(f) -> Column:
        if f.name == "message_id":
            return F.col("message_id")
        if f.name == "run_id":
            return F.lit(run_id)
        other = F.col(f"_text.{f.name}") if f.name in text_fields else F.lit(None)
        return F.when(F.col("parse_path") == "json", F.col(f"_rec.{f.name}")).when(
            F.col("parse_path") == "regex", other.cast(f.dataType)
        )

    return both.withColumn("parse_path", path).select(
        *[pick(f).alias(f.name) for f in RECORD.fields], "ord", *shown, "parse_path", "errors"
    )


def unparsed_flags(parsed: DataFrame) -> DataFrame:
    """Flag rows for messages no parser could read.

    Picked by a generator, not by a filter: see :func:`keep_found`.
    """
    sender = F.col("sender") if "sender" in parsed.columns else F.lit("")
    subject = F.col("subject") if "subject" in parsed.columns else F.lit("")
    flag = F.struct(
        "run_id", "message_id", F.coalesce(sender, F.lit("")).alias("sender"), F.coalesce(subject, F.lit("")).alias("subject"),
        F.lit("All parsers failed").alias("reason"),
    )
    flags = parsed.select(F.when(F.col("parse_path") == "failed", flag).alias("flag"))
    return keep_found(flags, "flag").select("flag.*")


Parser = Callable[[DataFrame], DataFrame]


def first_parsed(messages: DataFrame, parsers: Sequence[tuple[str, Parser]], key: str = "message_id",
                 limits: Limits = LIMITS) -> DataFrame:
    """Registered parsers in order; each message keeps the first result.

    A parser takes the messages and returns ``key`` and a ``record`` struct, null or absent
    when it could not read the message. Each parser only sees what the ones before it left.
    Returns key, record, parser.
    """
    rest, results = messages, []
    for i, (name, parse) in enumerate(parsers):
        got = keep_found(parse(rest).select(key, "record"), "record").withColumn("parser", F.lit(name))
        if i + 1 < len(parsers):
            # Used twice, and a parser may be costly: run it once.
            got = stage_table(got, f"parsed-{i}")
            rest = lookup(rest, got.select(key), [key], "left_anti", limits)
        results.append(got)
    return reduce(DataFrame.unionByName, results)


def generate(prompts: DataFrame, hook: Callable, prompt_column: str = "prompt", output: str = "generated_text") -> DataFrame:
    """Run a user's batch text generator over a prompt column.

    ``hook`` maps an iterator of string series to an iterator of string series, so a model
    is loaded once per task; the Arrow batch size sets the prompts per call.
    """
    return prompts.withColumn(output, F.pandas_udf(hook, "string")(F.col(prompt_column)))
