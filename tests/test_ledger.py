import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from msgledger.operators import ledger as led
from msgledger.operators.ordered import global_rank
from msgledger.options import Limits

SCHEMA = "message_id string, ord bigint, internal_account_number string, date date, amount decimal(18,2), available_balance decimal(18,2)"
# Normal plan; every account split; only the big accounts split.
PLANS = [Limits(), Limits(hot_key_rows=0, chunk_rows=7), Limits(hot_key_rows=12, chunk_rows=5)]


@pytest.fixture(params=PLANS, ids=["window", "all split", "hot split"])
def limits(request):
    return request.param


def make_rows(seed, n=150, known=0.3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = "hot" if rng.random() < 0.35 else rng.choice(["a", "b", "c", "d", None])
        balance = D(rng.randint(-9999, 9999)) / 100 if rng.random() < known and account != "d" else None
        rows.append((f"m{i}", i, account, date(2024, 1, 1) + timedelta(days=rng.randint(0, 12)), D(rng.randint(-500, 500)) / 100, balance))
    rng.shuffle(rows)
    return rows


def loop_fill(rows, mode):
    """Balance filling row by row, per account in date and input order."""
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: r[1]):
        groups[r[2]].append(r)
    out = {}
    for group in groups.values():
        group.sort(key=lambda r: r[3])
        bal, last = [r[5] for r in group], None
        for i, r in enumerate(group):
            if bal[i] is None and last is not None:
                bal[i] = last + r[4]
            last = bal[i] if bal[i] is not None else last
        if mode != "forward":
            following = None
            for i in range(len(group) - 1, -1, -1):
                if bal[i] is None and following is not None:
                    bal[i] = following - (group[i][4] if mode == "own" else group[i + 1][4])
                following = bal[i] if bal[i] is not None else following
        out.update({r[0]: b for r, b in zip(group, bal)})
    return out


@pytest.mark.parametrize("mode", ["own", "ledger", "forward"])
@pytest.mark.parametrize("seed,known", [(1, 0.3), (2, 0.04), (3, 0.9)])
def test_fill_equals_loop(spark, limits, mode, seed, known):
    rows = make_rows(seed, known=known)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    filled = led.fill_balances(df, mode="own" if mode == "forward" else mode, forward_only=mode == "forward", limits=limits)
    got = {r["message_id"]: r["available_balance"] for r in filled.collect()}
    assert got == loop_fill(rows, mode)


def test_fill_edge_cases(spark, limits):
    d = date(2024, 1, 1)
    rows = [("a", 1, "x", d, D(5), None), ("b", 2, "y", d, D(5), D(7)), ("c", 3, "z", d, D(-5), None), ("e", 4, "z", d, D(2), D(10))]
    got = {r["message_id"]: r["available_balance"] for r in led.fill_balances(spark.createDataFrame(rows, SCHEMA), limits=limits).collect()}
    assert got == {"a": None, "b": D(7), "c": D(15), "e": D(10)}
    with pytest.raises(ValueError):
        led.fill_balances(spark.createDataFrame(rows, SCHEMA), mode="x", limits=limits)


def test_record_ids_equal_loop(spark, limits):
    rows = make_rows(4)
    first = {}
    for r in sorted(rows, key=lambda r: r[1]):
        first.setdefault(r[2], r[1])
    order = sorted(rows, key=lambda r: (r[3], first[r[2]], r[1]))
    want = {r[0]: 100 + i for i, r in enumerate(order, 1)}
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = {r["message_id"]: r["record_id"] for r in led.assign_record_ids(df, 100, limits=limits).collect()}
        assert got == want
    assert [r["message_id"] for r in led.order_batch(spark.createDataFrame(rows, SCHEMA), limits).collect()] == [r[0] for r in order]


def test_global_rank_on_one_hot_date(spark):
    df = spark.range(1000).select(F.lit(date(2024, 1, 1)).alias("date"), (999 - F.col("id")).alias("ord"))
    ranked = global_rank(df.repartition(6), ["date", "ord"], "n", chunks=9)
    assert ranked.where("n <> ord + 1").count() == 0 and ranked.count() == 1000


def test_dedupe_and_new(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 3, "b")], "message_id string, ord int, v string")
    got = {r["message_id"]: (r["v"], r["n"]) for r in led.dedupe_batch(df, count_as="n").collect()}
    assert got == {"a": ("early", 2), "b": ("b", 1)}
    master = spark.createDataFrame([("a",), ("",), (None,), ("z",)], "message_id string")
    for limits in (Limits(), Limits(broadcast_rows=0, hot_key_rows=1), Limits(broadcast_rows=1, hot_key_rows=1)):
        assert [r["v"] for r in led.new_records(df, led.processed_ids(master), limits=limits).collect()] == ["b"]
    assert sorted(r[0] for r in led.union_ids(led.processed_ids(master), df).collect()) == ["a", "b", "z"]


def test_master_state(spark):
    master = spark.createDataFrame([("7",), ("x",), (None,), ("12",)], "record_id string")
    assert led.max_record_id(master) == 12
    assert led.max_record_id(master.limit(0)) == 0
    dates = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 2, 1),), (None,)], "date date")
    assert led.last_date(dates).first()["last_date"] == date(2024, 2, 1)


def test_merged_order(spark):
    old = spark.createDataFrame([("o1", 1, "2024-01-02"), ("o2", 2, "bad")], "message_id string, ord int, date string")
    new = spark.createDataFrame([("n1", 1, "2024-01-01", 5), ("n2", 2, "2024-01-02", 6)], "message_id string, ord int, date string, extra int")
    rows = led.merged(old, new).collect()
    assert [r["message_id"] for r in rows] == ["o2", "n1", "o1", "n2"]
    assert [r["extra"] for r in rows] == [None, 5, None, 6]
