"""Bank-notification data derived from the order tables.

No given table holds bank mail, so notices, generated answers and raw mail are made from
orders, customers and nations: one per order, over the whole table. The expressions in
``NOTICE`` and ``ACCOUNT`` are plain SQL that other engines can run as well.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from msgledger.operators.joins import lookup
from msgledger.session import spread

NL = "chr(10)"

# Columns over orders joined with customer and nation.
NOTICE: dict[str, str] = {
    "message_id": "'m' || cast(o_orderkey as string)",
    "ord": "o_orderkey",
    "custkey": "o_custkey",
    "account": "lpad(cast(o_custkey as string), 10, '0')",
    "last4": "right(lpad(cast(o_custkey as string), 10, '0'), 4)",
    "entity": "c_name",
    "institution": "n_name",
    "segment": "c_mktsegment",
    "status": "o_orderstatus",
    "priority": "o_orderpriority",
    "day": "cast(o_orderdate as date)",
    "amount": "cast(o_totalprice as decimal(18,2))",
    "balance": "abs(cast(c_acctbal as decimal(18,2)))",
}

# Columns over the above: the notice text, in four shapes.
_AMT = "cast(amount as string)"
_BAL = "cast(balance as string)"
TEXT = f"""CASE ord % 4
  WHEN 0 THEN 'Payment notice' || {NL} || 'Paid to: ' || entity || {NL} || 'ZAR ' || {_AMT} || ' on ' || cast(day as string)
    || ' from ****' || last4 || {NL} || 'Available balance: ZAR ' || {_BAL}
  WHEN 1 THEN {_AMT} || ' USD charged' || {NL} || 'Merchant ' || entity || {NL} || 'card ****' || last4 || {NL}
    || 'recipient: A' || {NL} || 'Recipient: ' || entity || ' Ltd' || {NL} || 'New balance ' || {_BAL}
  WHEN 2 THEN 'Bank X' || {NL} || '€' || replace({_AMT}, '.', ',') || ' paid on ' || cast(day as string) || {NL}
    || 'Balance after this card transaction ' || replace({_BAL}, '.', ',') || {NL} || 'vendor: ' || {NL} || 'Shop ' || entity
  ELSE 'Statement ready' || {NL} || 'Dear ' || entity || ', your card ****' || last4 || ' is active.'
END"""

# Columns over customer joined with nation.
ACCOUNT: dict[str, str] = {
    "internal_account_number": "lpad(cast(c_custkey as string), 10, '0')",
    "internal_entity": "c_name",
    "institution": "n_name",
    "currency": "'ZAR'",
    "owner_type": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'personal' ELSE 'business' END",
    "position": "c_custkey",
}

# Columns over orders: a ledger with a known balance on every fourth order.
LEDGER: dict[str, str] = {
    "message_id": "'m' || cast(o_orderkey as string)",
    "ord": "o_orderkey",
    "internal_account_number": "lpad(cast(o_custkey as string), 10, '0')",
    "date": "cast(o_orderdate as date)",
    "amount": "CASE WHEN o_orderstatus = 'F' THEN -cast(o_totalprice as decimal(18,2)) ELSE cast(o_totalprice as decimal(18,2)) END",
    "available_balance": "CASE WHEN o_orderkey % 4 = 0 THEN cast(o_totalprice as decimal(18,2)) END",
    "run_id": "'run-' || cast(o_orderkey % 5 as string)",
}


def exprs(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    # Lower-cased here, once per nation: doing it for each notice costs much.
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", F.lower("n_name").alias("n_domain"))
    return lookup(table(spark, sf, "customer"), nation, ["c_nationkey"], "inner")


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).selectExpr(*exprs(ACCOUNT))


def notices(spark: SparkSession, sf: str) -> DataFrame:
    """One notice per order, with its text."""
    orders = spread(table(spark, sf, "orders"), "o_orderkey").withColumn("c_custkey", F.col("o_custkey"))
    owners = customers(spark, sf).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "n_name", "n_domain")
    joined = lookup(orders, owners, ["c_custkey"], "inner")
    return joined.selectExpr(*exprs(NOTICE), "n_domain AS domain").withColumn("text", F.expr(TEXT))


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*exprs(LEDGER))


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})


def answer_json(number: Column, external: Column, aliases: bool = False, currency: bool = True,
                entity: Column | None = None) -> Column:
    """A generated record for a notice."""
    names = {
        "date": "trans_date", "internal_account_number": "account_no", "institution": "bank",
        "external_entity": "payee", "amount": "amt", "description": "narrative", "currency": "curr",
        "available_balance": "balance",
    } if aliases else {}
    amount = F.format_number(F.col("amount"), 2) if aliases else F.col("amount").cast("string")
    fields = {
        "date": F.col("day").cast("string"),
        "internal_account_number": number,
        "internal_entity": entity if entity is not None else F.lit("?"),
        "institution": F.lit("?"),
        "external_entity": external,
        "amount": amount,
        "available_balance": F.when(F.col("ord") % 16 < 8, F.col("balance").cast("string")),
        "currency": F.lit("ZAR"),
        "description": F.concat(F.lit("card purchase at "), F.col("entity")),
        "transaction_type": F.lit("card"),
        "source_email": F.concat(F.lit("alerts@"), F.col("domain"), F.lit(".example")),
    }
    if not currency:
        del fields["currency"]
    return _json(**{names.get(k, k): v for k, v in fields.items()})


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Notices with generated text of eight kinds, from clean JSON to none at all."""
    rows = notices(spark, sf)
    shop, echo = F.lit("Shop 7"), F.concat("institution", F.lit(" ATM"))
    kind = F.col("ord") % 8
    generated = (
        F.when(kind == 0, answer_json(F.col("account"), echo))
        .when(kind == 1, F.concat(F.lit("Sure, here it is: "), answer_json(F.col("last4"), shop), F.lit(' -- done {"a": 1}')))
        .when(kind == 2, answer_json(F.concat(F.col("custkey").cast("string"), F.lit(".0")), shop))
        .when(kind == 3, answer_json(F.col("account"), shop, currency=False))
        .when(kind == 4, answer_json(F.lit(""), shop, entity=F.lit("Nobody")))
        .when(kind == 5, F.concat(F.lit('{"date": "'), F.col("day").cast("string"), F.lit('", }')))
        .when(kind == 6, F.lit("no idea"))
        .otherwise(answer_json(F.col("account"), shop, aliases=True))
    )
    body = F.when(F.col("ord") % 16 == 6, F.lit("")).otherwise(F.col("text"))
    return rows.withColumns({"generated_text": generated, "body": body})


def _b64(data: Column) -> Column:
    packed = F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))
    return F.replace(F.replace(packed, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_"))


def _part(mime: str, data: Column | None = None, parts: list[Column] | None = None,
          filename: Column | None = None, attachment: Column | None = None,
          headers: Column | None = None) -> Column:
    """JSON text of a MIME part; children are JSON texts themselves."""
    pieces = [F.lit(f'{{"mimeType":"{mime}"')]
    if headers is not None:
        pieces += [F.lit(',"headers":'), headers]
    if filename is not None:
        pieces += [F.lit(',"filename":"'), filename, F.lit('"')]
    if data is not None:
        pieces += [F.lit(',"body":{"data":"'), data, F.lit('"}')]
    if attachment is not None:
        pieces += [F.lit(',"body":{"attachmentId":"'), attachment, F.lit('"}')]
    if parts is not None:
        pieces += [F.lit(',"parts":['), F.concat_ws(",", *parts), F.lit("]")]
    return F.concat(*pieces, F.lit("}"))


def mail(spark: SparkSession, sf: str) -> DataFrame:
    """Raw mail, one per order, in six MIME shapes, with PDF attachments on some."""
    rows = notices(spark, sf)
    text = F.encode("text", "UTF-8")
    plain = _part("text/plain", _b64(text))
    html = _part("text/html", _b64(F.encode(F.concat(
        F.lit("<html><head><style>p{margin:0}</style></head><body><p>"),
        F.replace(F.col("text"), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>Terms &amp;amp; more&nbsp;&#8364;</body></html>"),
    ), "UTF-8")))
    empty = _part("text/plain", F.lit(""))
    bad = _part("text/plain", _b64(F.concat(text, F.unhex(F.lit("FF")), F.encode(F.lit(" end"), "UTF-8"))))
    pdf = _part("application/pdf", filename=F.concat(F.lit("inv_"), F.col("ord").cast("string"), F.lit(".PDF")),
                attachment=F.concat(F.lit("att"), F.col("ord").cast("string")))
    lost = _part("application/pdf", filename=F.lit("lost.pdf"))
    image = _part("image/png", filename=F.lit("logo.png"), attachment=F.lit("img"))
    key = F.col("ord").cast("string")
    date_header = F.concat(F.date_format("day", "EEE, d MMM yyyy"), F.lit(" 23:30:00 -0100"))
    headers = F.to_json(F.array(
        F.struct(F.lit("From").alias("name"), F.lit("old@x.example").alias("value")),
        F.struct(F.lit("Subject").alias("name"), F.concat(F.lit("transaction "), F.col("status")).alias("value")),
        F.struct(
            F.when(F.col("ord") % 3 == 0, F.lit("Message-ID")).when(F.col("ord") % 3 == 1, F.lit("Message-Id")).otherwise(F.lit("X-Id")).alias("name"),
            F.concat(F.lit("<"), key, F.lit("@bank.example>")).alias("value"),
        ),
        F.struct(F.when(F.col("ord") % 2 == 0, F.lit("Date")).otherwise(F.lit("X-Date")).alias("name"), date_header.alias("value")),
        F.struct(F.lit("From").alias("name"), F.concat(F.lit("Bank <alerts@"), F.col("domain"), F.lit(".example>")).alias("value")),
    ))

    def root(mime: str, **kw) -> Column:
        return _part(mime, headers=headers, **kw)

    deep = plain
    for _ in range(6):
        deep = _part("multipart/mixed", parts=[image, deep])
    shape = F.col("ord") % 6
    payload = (
        F.when(shape == 0, root("multipart/alternative", parts=[html, plain]))
        .when(shape == 1, root("multipart/mixed", parts=[_part("multipart/alternative", parts=[empty, plain]), pdf, lost]))
        .when(shape == 2, root("text/plain", data=_b64(text)))
        .when(shape == 3, root("multipart/mixed", parts=[image, _part("multipart/mixed", parts=[pdf])]))
        .when(shape == 4, root("multipart/mixed", parts=[deep]))
        .otherwise(root("multipart/mixed", parts=[bad]))
    )
    return rows.select(
        F.col("message_id").alias("id"),
        F.concat(F.unix_seconds(F.col("day").cast("timestamp")).cast("string"), F.lit("000")).alias("internalDate"),
        F.concat(F.lit("snippet "), key).alias("snippet"),
        payload.alias("payload"),
        F.array(F.lit("INBOX"), F.col("priority")).alias("labels"),
        "ord", "status", "day", "institution", "segment", "account", "entity",
    )


def day_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as run results: one run per day, an 'error' is a failure."""
    return table(spark, sf, "events").select(
        F.col("ts").cast("date").cast("string").alias("run_id"), (F.col("event_type") != "error").alias("ok")
    )


def replicates(spark: SparkSession, sf: str, runs: int = 5) -> DataFrame:
    """Each order parsed ``runs`` times, with a changed value or a dropped key here and there."""
    base = spread(ledger(spark, sf), "ord").withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(runs))))
    changed = (F.col("run") > 1) & ((F.col("ord") * F.col("run")) % 97 == 0)
    dropped = (F.col("run") > 1) & ((F.col("ord") * F.col("run")) % 211 == 0)
    entries = F.array_compact(F.array(
        F.struct(F.lit("message_id").alias("k"), F.col("message_id").alias("v")),
        F.struct(F.lit("date").alias("k"), F.col("date").cast("string").alias("v")),
        F.when(~dropped, F.struct(F.lit("account").alias("k"), F.col("internal_account_number").alias("v"))),
        F.struct(F.lit("amount").alias("k"), F.concat(F.col("amount").cast("string"), F.when(changed, "1").otherwise("")).alias("v")),
        F.struct(F.lit("run_id").alias("k"), F.concat(F.lit("r"), F.col("run").cast("string")).alias("v")),
    ))
    return base.select("run", "message_id", F.map_from_entries(entries).alias("record"), (100 + F.col("run") * 3).cast("bigint").alias("latency_ms"))
