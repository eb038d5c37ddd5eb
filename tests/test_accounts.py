import random

import pytest
from pyspark.sql import functions as F

from msgledger.operators import accounts as acc
from msgledger.operators.joins import collect_small, first_per_key, lookup
from msgledger.options import Limits, MaskOptions
from msgledger.sources.tables import accounts_from, with_last4

# The second set makes every look-up take the shuffled path with hot keys.
PLANS = [Limits(), Limits(broadcast_rows=40, hot_key_rows=5)]


@pytest.fixture(params=PLANS, ids=["broadcast", "hot keys"])
def limits(request):
    return request.param


@pytest.fixture(scope="module")
def listed():
    rng = random.Random(3)
    rows = [
        {"internal_account_number": "1000200030", "internal_entity": "Entity A", "institution": "Bank X"},
        {"internal_account_number": "5000600070", "internal_entity": "Entity B", "institution": "Bank Y"},
        {"internal_account_number": "99930030", "internal_entity": "Entity C", "institution": "Bank Z"},
        {"internal_account_number": "0030", "internal_entity": "Entity D", "institution": "Bank X"},
    ]
    return rows + [
        {"internal_account_number": str(rng.randint(10**9, 10**10)), "internal_entity": f"E{i}", "institution": f"B{i % 5}"}
        for i in range(60)
    ]


def resolve(row, accounts, k=4):
    """One row resolved by plain loops."""
    by_suffix = {a["internal_account_number"][-k:]: a for a in accounts}
    row = dict(row)
    if (row["transaction_type"] or "").lower() == "transfer":
        import re

        masks = re.findall(r"\*+(\d{4})", row["description"] or "")
        if len(masks) >= 2:
            ours = (row["internal_account_number"] or "")[-k:]
            other = masks[1] if masks[0] == ours else masks[0]
            a, b = by_suffix.get(ours), by_suffix.get(other)
            if a and b:
                row.update(internal_account_number=a["internal_account_number"], internal_entity=a["internal_entity"],
                           institution=a["institution"], external_account_number=b["internal_account_number"],
                           external_entity=b["internal_entity"])
        return row
    number = row["internal_account_number"]
    if number:
        for a in accounts:
            if a["internal_account_number"].endswith(number):
                row.update(internal_entity=a["internal_entity"], institution=a["institution"])
                break
    return row


def test_resolution_equals_loops(spark, listed, limits):
    rng = random.Random(5)
    numbers = ["0030", "0070", "30", "1000200030", "x", "", None] + [a["internal_account_number"][-rng.randint(1, 8):] for a in listed]
    rows = []
    for i in range(300):
        number = "0030" if i % 3 == 0 else rng.choice(numbers)
        masks = [rng.choice(["0030", "0070", "1234", (number or "")[-4:] or "0000"]) for _ in range(rng.randint(0, 3))]
        rows.append({
            "ord": i, "transaction_type": rng.choice(["Transfer", "card", None, "TRANSFER"]),
            "description": " to ".join(f"****{m}" for m in masks) or None, "internal_account_number": number,
            "internal_entity": "?", "institution": "?", "external_entity": "Shop", "external_account_number": None,
        })
    schema = "ord int, transaction_type string, description string, internal_account_number string, internal_entity string, institution string, external_entity string, external_account_number string"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    accounts = accounts_from(spark, listed)
    out = acc.resolve_accounts(df, accounts, limits=limits, check_allowed=True)
    got = {r["ord"]: r.asDict() for r in out.collect()}
    entities = {a["internal_entity"] for a in listed}
    assert len(got) == len(rows)
    for r in rows:
        want = resolve(r, listed)
        have = got[r["ord"]]
        assert have.pop("entity_allowed") == (want["internal_entity"] in entities)
        have.pop("institution_allowed")
        assert have == want


def test_suffix_last_account_wins(spark, listed):
    rows = spark.createDataFrame([("x0030",), ("0070",), ("none",), (None,)], "n string")
    got = {r["n"]: r["account"] for r in acc.suffix_lookup(rows, accounts_from(spark, listed), "n").collect()}
    assert got["x0030"]["internal_entity"] == "Entity D" and got["0070"]["internal_entity"] == "Entity B"
    assert got["none"] is None and got[None] is None


def test_owner_classes(spark, limits):
    owners = spark.createDataFrame([
        ("11112222", "Bank X", "personal", 0), ("33332222", "Bank Y", "joint", 1), ("4444", "Bank Z", "personal", 2),
    ], "internal_account_number string, institution string, owner_type string, position int")
    rows = spark.createDataFrame([("2222",), ("11112222",), ("44-44",), ("9",), (None,)], "internal_account_number string")
    got = {r["internal_account_number"]: (r["full_number"], r["owner_institution"], r["owner_class"])
           for r in acc.classify_owners(rows, owners, limits).collect()}
    assert got["2222"] == ("33332222", "Bank Y", "business")
    assert got["11112222"] == ("11112222", "Bank X", "personal")
    assert got["44-44"] == ("4444", "Bank Z", "personal")
    assert got["9"] == ("9", "", "unclassified") and got[None][2] == "unclassified"


def test_duplicate_suffixes(spark):
    df = spark.createDataFrame([("1 2340030",), ("9990030",), ("777",), ("1230099",), ("1230099",)], "internal_account_number string")
    assert {tuple(r) for r in acc.duplicate_suffixes(df).collect()} == {("0030", "1 2340030"), ("0030", "9990030")}


def test_account_scan(spark, listed):
    df = spark.createDataFrame([("12-34 56",), ("1-2",)], "internal_account_number string")
    assert [(r["digits"], r["last4"]) for r in with_last4(df).collect()] == [("123456", "3456")]


def test_mask_options(spark, listed):
    df = spark.createDataFrame([("transfer", "x###030 to x###070", "030", "?", "?", "?")],
                               "transaction_type string, description string, internal_account_number string, internal_entity string, institution string, external_entity string")
    mask = MaskOptions(pattern=r"#+(\d{3})", suffix_length=3)
    out = acc.resolve_transfers(df, accounts_from(spark, listed[:2]), mask).first()
    assert out["internal_account_number"] == "1000200030" and out["external_entity"] == "Entity B"


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_paths_agree(spark, how):
    facts = spark.createDataFrame([(i, "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 50}")) for i in range(600)], "i int, k string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)], "k string, v int")
    plain = facts.join(dim, ["k"], how)
    for limits in PLANS + [Limits(broadcast_rows=30, hot_key_rows=100)]:
        got = lookup(facts, dim, ["k"], how, limits)
        assert sorted(map(str, got.select(*sorted(plain.columns)).collect())) == sorted(map(str, plain.select(*sorted(plain.columns)).collect()))


def test_hot_keys_do_not_shuffle(spark):
    facts = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    dim = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = lookup(facts, dim, ["k"], "inner", Limits(broadcast_rows=10, hot_key_rows=100))
    assert got.count() == 1000


def test_collect_small_refuses(spark):
    with pytest.raises(ValueError):
        collect_small(spark.range(11), 10, "rows")
    assert len(collect_small(spark.range(10), 10, "rows")) == 10


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, None), ("b", 2, "z")], "k string, ord int, v string")
    got = sorted(tuple(r) for r in first_per_key(df, ["k"], ["ord"], "n").collect())
    assert got == [("a", 1, None, 2), ("b", 2, "z", 1)]


def test_endings_are_dealt_out(spark):
    """A table that one task reads: no task makes endings of more than ``exploded_rows`` accounts, about, and the result stays."""
    rows = spark.range(900).selectExpr("lpad(id, 10, '0') internal_account_number", "'E' || id internal_entity", "'I' institution", "id position").coalesce(1)
    asked = spark.range(1200).selectExpr("cast(id AS string) number")
    few, many = (acc.ends_with_lookup(asked, rows, "number", Limits(exploded_rows=n)).select("number", "owner.internal_entity") for n in (100, 100_000))
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    plan = acc.ending_dimension(rows, Limits(exploded_rows=100))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_transfers_in_any_case(spark):
    kinds = ["transfer", "Transfer", "TRANSFER", "transfers", "card", "", "\uff34ransfer", None]
    df = spark.createDataFrame(list(enumerate(kinds)), "i int, transaction_type string").orderBy("i")
    assert [r[0] for r in df.select(acc.is_transfer()).collect()] == [True] * 3 + [False] * 5
    assert "octet_length" in str(acc.is_transfer())  # only texts of that size are lower-cased
