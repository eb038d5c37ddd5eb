import json
import random
from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from msgledger.functions import clean, extract
from msgledger.operators.messages import generated_record, present_fields
from msgledger.options import SYNONYMS, normalise_synonyms


def test_first_amount(column):
    cases = {
        "paid ZAR 1 234.56 to shop": ("1234.56", "ZAR"),
        "1,234.56 USD out": ("1234.56", "USD"),
        "€9,99 fee": ("9.99", "€"),
        "R 10.00 spent": ("10.00", "SPE"),
        "for 12.50 at": ("12.50", "FOR"),
        "12.345 abc": (None, None),
        "ZAR 55.10": ("55.10", "ZAR"),
        "1 234,50 EUR on 2024-01-05": ("1234.50", "EUR"),
        "zar 5.00 then usd 6.00": ("5.00", "ZAR"),
        "1,234,56 EUR": (None, "EUR"),
        "": (None, None),
    }
    got = column(extract.first_amount, list(cases))
    assert [(str(g["amount"]) if g["amount"] is not None else None, g["currency"]) for g in got] == list(cases.values())


def test_balance(column):
    cases = {
        "Available balance: ZAR 55.10": "55.10",
        "New balance 7.00": "7.00",
        "Balance after this transaction 3,50": "3.50",
        "available\nBALANCE is 1 000.25 now": "1000.25",
        "balance 5.00": None,
    }
    assert [str(g["balance"]) if g["balance"] is not None else None for g in column(extract.balance, list(cases))] == list(cases.values())
    plain, lazy = (column(lambda c: extract.balance(c, w), ["Available balance: ZAR 55.10"])[0]["currency"] for w in (False, True))
    assert (plain, lazy) == (None, "ZAR")


def test_simple_balance(column):
    texts = ["Available balance R1,234.50", "available balance is 5", "Available balance ZAR 1.2.3", "none", "Available balance . 7.00"]
    assert column(extract.simple_balance, texts) == [D("1234.50"), D("5.00"), None, None, None]


def test_labels(column):
    def ext(c):
        return extract.labelled_value(c, SYNONYMS["external_entity"])

    texts = ["Paid to: Shop A\nx\npaid TO : Shop B  \nend", "vendor:\n next line", "no label", "payee:   ", "merchant: a\r\nb"]
    assert column(ext, texts) == ["Shop B", "next line", None, "", "a"]
    assert column(lambda c: extract.labelled_value(c, ["a.b"]), ["aXb: 1", "a.b: 2"]) == [None, "2"]
    assert column(lambda c: extract.labelled_value(c, []), ["a: 1"]) == [None]


def test_dates_masks_lines(column):
    assert column(extract.first_date, ["on 2024-01-05 and 2024-02-06", "x2024-01-05", "2024-13-45", "no"]) == [date(2024, 1, 5), None, None, None]
    assert column(extract.masked_last4, ["card ****1234", "*1234", "**99999"]) == ["1234", None, "9999"]
    lines = ["\n  \n2024-01-05\nZAR 5.00\n  Shop Z \nmore", "2024-01-05\nZAR 5.00", "", "x" * 80, "a b"]
    assert column(extract.counterparty_line, lines) == ["Shop Z", None, None, "x" * 50, "a"]


def test_text_record(column):
    r = column(lambda c: extract.text_record(c, SYNONYMS), ["Paid from: Me\nZAR 5.00 on 2024-01-05 ****1234 New balance 9.00", "", None])
    assert (r[0]["internal_entity"], r[0]["amount"], r[0]["internal_account_number"], r[0]["available_balance"]) == ("Me", D("5.00"), "1234", D("9.00"))
    found = column(lambda c: extract.text_record_found(extract.text_record(c, SYNONYMS)), ["hello", "", None])
    assert found == [True, False, False]


def scan_object(text):
    """First balanced object by trying each opening brace in turn."""
    for i, ch in enumerate(text):
        if ch != "{":
            continue
        depth = 0
        for j in range(i, len(text)):
            depth += {"{": 1, "}": -1}.get(text[j], 0)
            if depth == 0:
                return text[i:j + 1]
    return None


def test_first_json_object(column):
    rng = random.Random(7)
    texts = ["".join(rng.choice("{}{}abé\n") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += ["{" * 300 + "}" * 299, "a{b{c{d{e{f{g}}}}}}}h", '{"a":"}"}', "{}", "}{"]
    assert column(extract.first_json_object, texts) == [scan_object(t) for t in texts]


def test_decode(column):
    probes = ['{"a": 1.50, "b": "x", "c": {"z": [1]}}', '{"a":1,}', "{'a':1}", '{"a": null}', "{}", '{"a":1} {"a":2}', None]
    got = column(lambda c: extract.decode_object(extract.first_json_object(c), ["a", "b", "c"]), probes)
    assert [None if g is None else tuple(g) for g in got] == [
        ("1.5", "x", '{"z":[1]}'), None, None, (None, None, None), (None, None, None), ("1", None, None), None]


def test_aliases(column):
    texts = [json.dumps(t) for t in (
        {"payee": "P", "external_entity": "E", "acct_number": "12", "amt": 5, "for the amount of": 6},
        {"merchant": "M", "account_name": "N", "balance": None},
    )]
    got = column(lambda c: generated_record(c, SYNONYMS), texts)
    assert got[0]["rec"]["external_entity"] == "E" and got[0]["rec"]["internal_account_number"] == "12" and got[0]["rec"]["amount"] == "5"
    assert got[1]["rec"]["external_entity"] == "M" and got[1]["rec"]["internal_entity"] == "N"
    present = column(lambda c: present_fields(generated_record(c, SYNONYMS)["keys"], SYNONYMS), texts)
    assert present[1] == ["internal_entity", "external_entity", "available_balance"]
    assert normalise_synonyms({"a": "x", "b": None, "c": [1, "y"]}) == {"a": ("x",), "b": (), "c": ("1", "y")}


def test_coercion(column):
    assert column(clean.to_number, ["1,234.50", " 5 ", "1 000", "x", "", None]) == [D("1234.50"), D("5.00"), D("1000.00"), None, None, None]
    dates = {
        "2024-01-05": (2024, 1, 5), "01/02/2024": (2024, 1, 2), "13/02/2024": (2024, 2, 13), "5 Jan 2024": (2024, 1, 5),
        "January 5, 2024": (2024, 1, 5), "Fri, 5 Jan 2024 10:00": (2024, 1, 5), "2024/01/05": (2024, 1, 5),
        "2024-01-05T10:00:00Z": (2024, 1, 5), "5th March 2023": (2023, 3, 5), "02-30-2024": None, "soon": None, "1 Foo 2024": None,
        "20240105": (2024, 1, 5), "01/02/24": (2024, 1, 2), "5 Jan 99": (1999, 1, 5), "2024010": None, "01/02/202": None,
    }
    assert column(clean.to_date, list(dates)) == [date(*d) if d else None for d in dates.values()]
    assert column(clean.account_number, ["12345.0", "12.5", "x.0", "007.0", None]) == ["12345", "12.5", "x.0", "007", None]


def test_merchant(spark):
    rows = [
        ("Bank X POS", "Bank X", "Card purchase Shop A here", "Shop A here"),
        ("Bank X", "Bank X", "Card Shop", "Shop"),
        ("Bank X", "Bank X", "Card", "Bank X"),
        ("Bank X", "Bank X", None, "Bank X"),
        ("Shop", "Bank X", "a b c", "Shop"),
        ("Shop", "", "a b c", "Shop"),
        (None, "Bank X", "a b c", None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, e string, n string, d string, want string")
    got = df.select("i", clean.merchant_name(F.col("e"), F.col("n"), F.col("d")).alias("y")).orderBy("i").collect()
    assert [g["y"] for g in got] == [r[3] for r in rows]


def test_a_flat_object_is_matched_once(column):
    values = ['{"a": 1}', 'x {"a": 1} {"b": 2}', "{}", '{ open {"a": {"b": 1}}', "no", "", None, "}{"]
    assert column(extract.first_json_object, values) == ['{"a": 1}', '{"a": 1}', "{}", '{"a": {"b": 1}}', None, None, None, None]
    assert "RLIKE" not in str(extract.first_json_object(F.col("t"))).upper()
