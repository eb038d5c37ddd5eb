import base64
import datetime
import html
import json

from pyspark.sql import functions as F

from msgledger.functions import text as tx
from msgledger.operators.messages import read_messages


def b64(s):
    return base64.urlsafe_b64encode(s if isinstance(s, bytes) else s.encode()).decode()


def leaf(mime, data, **kw):
    return {"mimeType": mime, "body": {"data": b64(data) if data else ""}, **kw}


def multi(*parts):
    return {"mimeType": "multipart/mixed", "parts": list(parts)}


def read(spark, payloads, snippet="snip"):
    rows = [(str(i), "0", snippet, json.dumps(p), [], i) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "id string, internalDate string, snippet string, payload string, labels array<string>, ord bigint")
    return read_messages(df).orderBy("ord").collect()


def test_body_selection(spark):
    deep = leaf("text/plain", "deep down")
    for _ in range(60):
        deep = multi(leaf("image/png", ""), deep)
    got = [r["body"] for r in read(spark, [
        leaf("text/plain", "a\n\n b &amp; c"),
        leaf("text/html", "<p>x</p>y"),
        multi(leaf("text/html", "<b>html first</b>"), leaf("text/plain", "plain second")),
        multi(multi(leaf("text/plain", "")), leaf("text/plain", "filled")),
        multi(leaf("image/png", "zzz")),
        deep,
        multi({**leaf("text/plain", ""), "parts": [leaf("text/plain", "hidden child")]}, leaf("text/html", "next")),
        leaf("text/plain", b"ok\xff\xfe end"),
        leaf("text/plain", "a real � stays"),
        {},
    ])]
    assert got == [
        "a b & c", "x y", "html first", "filled", "snip", "deep down", "next", "ok end", "a real � stays", "snip",
    ]


def test_no_snippet_is_empty_text(spark):
    assert read(spark, [{}], snippet=None)[0]["body"] == ""


def test_body_with_braces_in_headers(spark):
    p = {**leaf("text/plain", "body"), "headers": [{"name": "Subject", "value": "{{ {"}]}
    assert read(spark, [p])[0]["body"] == "body"


def test_headers_and_ids(spark):
    def h(*pairs):
        return {"headers": [{"name": n, "value": v} for n, v in pairs]}

    rows = read(spark, [
        h(("From", "first"), ("From", "last"), ("Message-ID", "<a@b>"), ("Message-Id", "<other>")),
        h(("Message-Id", "<c@d>")),
        h(("Message-ID", ""), ("Message-Id", "<e@f>")),
        h(),
        {},
    ])
    assert [r["canonical_id"] for r in rows] == ["a@b", "c@d", "e@f", "3", "4"]
    assert rows[0]["sender"] == "last" and rows[3]["sender"] == ""


def test_header_map_last_wins(spark):
    df = spark.createDataFrame([([("A", "1"), ("B", "2"), ("A", "3")],)], "h array<struct<name:string,value:string>>")
    assert df.select(tx.header_map(F.col("h")).alias("m")).first()["m"] == {"A": "3", "B": "2"}


def test_sent_date(spark):
    day_ms = 86_400_000

    def msg(value, name="Date"):
        return {"headers": [{"name": name, "value": value}]}

    payloads = [
        msg("Tue, 3 Oct 2023 23:30:00 -0100"), msg("3 Oct 2023 01:00 +0200", "DATE"), msg("Tue, 03 Oct 2023 12:00:00 GMT (x)"),
        msg("Tue, 3 Oct 2023 22:00:00 EST"), msg("nonsense"), {},
        {"headers": [{"name": "date", "value": "bad"}, {"name": "Date", "value": "1 Jan 2020 00:00:00 +0000"}]},
    ]
    rows = [(str(i), str(day_ms * 3), "", json.dumps(p), [], i) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "id string, internalDate string, snippet string, payload string, labels array<string>, ord bigint")
    got = [r["sent_date"] for r in read_messages(df).orderBy("ord").collect()]
    d = datetime.date
    assert got == [d(2023, 10, 4), d(2023, 10, 2), d(2023, 10, 3), d(2023, 10, 4), d(1970, 1, 4), d(1970, 1, 4), d(2020, 1, 1)]


def test_all_parts(spark):
    tree = multi(leaf("text/plain", "x"), multi({"mimeType": "application/pdf", "filename": "A.PDF", "body": {"attachmentId": "1"}}))
    df = spark.createDataFrame([(json.dumps(tree),)], "p string")
    parts = df.select(tx.all_parts(F.col("p")).alias("a")).first()["a"]
    assert [(p["depth"], p["mimeType"]) for p in parts] == [
        (0, "multipart/mixed"), (1, "text/plain"), (1, "multipart/mixed"), (2, "application/pdf")]
    assert parts[3]["filename"] == "A.PDF" and parts[3]["attachmentId"] == "1"


def test_html(column):
    cases = {
        "<p>a</p><p>b</p>": "a b",
        "x<script>if (a<b) {}</script>y": "x y",
        "<STYLE type='a'>p{}</STYLE >z": "z",
        "a<!-- <p>no</p> -->b": "a b",
        '<a title="1>2" href=x>link</a>': "link",
        "<p title=it's>ok</p>": "ok",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "&amp;amp; &amp;lt;": "& <",
        "&euro;5 &#8364;6 &#x20AC;7 &eacute;&nbsp;&nbsp;z": "€5 €6 €7 é z",
        "fish&chips &copy 2020": "fish&chips © 2020",
        "<template><p>t</p></template>u": "u",
        "<br/>": "",
        "open <script>never closed": "open",
        "a <b>c</b> d <p class": "a c d <p class",
        "<p " * 20000 + "x": ("<p " * 20000 + "x"),
    }
    assert column(tx.html_text, list(cases)) == list(cases.values())


def test_unescape_equals_python(column):
    probes = ["&lt;&gt;", "&amp;lt;", "&quot;&apos;&#39;", "&nbsp;", "a & b", "&copy;&copy", "&#0;", "&#128;", "&notit;", "&AMP;", "&amp", ""]
    assert column(tx.unescape, probes) == [html.unescape(p) for p in probes]


def test_collapse(column):
    assert column(tx.collapse, ["  a   b\t\n\x1cc ", "", None]) == ["a b c", "", None]


def test_a_body_is_decoded_once(spark):
    rows = spark.createDataFrame([("text/html", b64("a &amp;amp; b&#8364;")), ("text/plain", b64("a &amp;amp; b")), (None, None)], "k string, d string")
    body = rows.repartition(2, "d").select(tx.body_text(F.col("k"), F.col("d"), F.lit("s")).alias("body"))
    assert body._jdf.queryExecution().executedPlan().toString().count("script|style") == 1
    assert sorted(r["body"] for r in body.collect()) == ["a & b€", "a &amp; b", "s"]


def test_a_mail_date_is_matched_once(column):
    values = ["Mon, 1 Jan 2024 23:30:00 -0100", "1 Jan 99 01:02", "Tue, 2 Feb 2021 03:04:05 EST (tail, 1 Jan)\nmore", "no date", "", None]
    got = [str(t) if t else None for t in column(lambda v: tx.mail_timestamp(v).cast("string"), values)]
    assert got == ["2024-01-02 00:30:00", "1999-01-01 01:02:00", "2021-02-02 08:04:05", None, None, None]
    assert "regexp_extract" not in str(tx.mail_timestamp(F.col("v")))


def test_date_headers_of_any_case(spark):
    rows = [(i, [(n, "1 Jan 2024 01:02:03 +0000")]) for i, n in enumerate(["dAtE", "DATE", "Dates", "X-Date", None])]
    df = spark.createDataFrame(rows, "i int, h array<struct<name:string,value:string>>")
    got = [r[0] for r in df.orderBy("i").select(tx.sent_date(F.col("h"), F.lit("0")).cast("string")).collect()]
    assert got == ["2024-01-01"] * 2 + ["1970-01-01"] * 3
    assert "octet_length" in str(tx.sent_date(F.col("h"), F.lit("0")))
