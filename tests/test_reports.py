import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from msgledger.functions import stats
from msgledger.operators import fingerprint as fp, messages as msg, monitor as mon, replicates as rep, validate as val
from msgledger.operators.joins import keep_found
from msgledger.options import SYNONYMS, Limits
from msgledger.schema import RECORD, TRANSACTIONS, build_schema, project_to, raw_schema
from msgledger.sinks import tables as sinks


def tail(first, last, n, p):
    return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(first, last + 1))


@pytest.mark.parametrize("s,n", [(8, 10), (1, 2), (3, 50), (49, 50), (200, 300), (9, 1000)])
@pytest.mark.parametrize("alpha", [0.05, 0.01])
def test_interval_inverts_the_binomial_tails(s, n, alpha):
    low, high = stats.interval(s, n, alpha)
    assert tail(s, n, n, low) == pytest.approx(alpha / 2, rel=1e-8)
    assert tail(0, s, n, high) == pytest.approx(alpha / 2, rel=1e-8)


def test_interval_ends():
    assert stats.interval(0, 10, 0.05) == (0.0, pytest.approx(1 - 0.025 ** 0.1))
    assert stats.interval(10, 10, 0.05) == (pytest.approx(0.025 ** 0.1), 1.0)
    assert stats.interval(0, 0, 0.05) == (0.0, None)
    assert stats.interval(8, 10, 0.05) == (pytest.approx(0.44390, abs=1e-5), pytest.approx(0.97479, abs=1e-5))
    # A perfect run passes 0.99 from 368 messages on.
    assert stats.interval(367, 367, 0.05)[0] < 0.99 <= stats.interval(368, 368, 0.05)[0]


def test_interval_for_huge_counts():
    low, high = stats.interval(3 * 10**11, 10**12, 0.05)
    half = 1.96 * math.sqrt(0.3 * 0.7 / 10**12)
    assert 0.3 - low == pytest.approx(half, rel=1e-2) and high - 0.3 == pytest.approx(half, rel=1e-2)


def test_interval_column(spark):
    df = spark.createDataFrame([(8, 10), (0, 5), (5, 5), (0, 0)], "s int, n int")
    got = [(r["pmin"], r["pmax"]) for r in rep.with_interval(df, "s", "n").collect()]
    assert got[0][0] == pytest.approx(0.44390, abs=1e-5) and got[1][0] == 0 and got[2][1] == 1 and got[3] == (0.0, None)


def replicate_rows(spark):
    rows = []
    for run in (1, 2, 3):
        for m in ("a", "b"):
            record = {"x": "1", "y": None, "run_id": f"r{run}"}
            if run == 2 and m == "a":
                record["x"] = "2"
            if run == 3 and m == "b":
                del record["y"]
            rows.append((run, m, record, 100 * run))
    return spark.createDataFrame(rows, "run int, message_id string, record map<string,string>, latency_ms bigint")


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=1, hot_key_rows=2)], ids=["broadcast", "hot"])
def test_replicates(spark, limits):
    got = {(r["run"], r["message_id"]): (r["struct_match"], r["id_match"]) for r in rep.replicate_matches(replicate_rows(spark), limits=limits).collect()}
    assert got == {(1, "a"): (True, True), (1, "b"): (True, True), (2, "a"): (True, False), (2, "b"): (True, True),
                   (3, "a"): (True, True), (3, "b"): (False, False)}


def test_replicate_summary(spark):
    rows = {r["run"]: r for r in rep.replicate_summary(rep.replicate_matches(replicate_rows(spark))).collect()}
    assert rows[1]["p_id"] == 1 and rows[2]["p_id"] == 0.5 and not rows[3]["struct_pass"] and rows[2]["struct_pass"]
    assert rows[1]["latency_cv"] == pytest.approx(0.5) and not rows[1]["latency_pass"] and not rows[1]["id_pass"]
    one = rep.replicate_summary(rep.replicate_matches(replicate_rows(spark).where("run = 1"))).first()
    assert one["latency_cv"] == 0 and one["latency_pass"]


def test_daily_and_zscores(spark):
    days = [(date(2024, 1, 1) + timedelta(days=i), n) for i, n in enumerate([10, 11, 9, 10, 12, 10, 9, 11, 10, 10, 95])]
    df = spark.createDataFrame([(d,) for d, n in days for _ in range(n)], "date date")
    daily = mon.daily_counts(df)
    assert {(r["date"], r["tx_count"]) for r in daily.collect()} == set(days)
    flagged = mon.outliers(mon.global_zscores(daily)).collect()
    assert [r["tx_count"] for r in flagged] == [95]
    counts = [n for _, n in days]
    mean = sum(counts) / len(counts)
    dev = math.sqrt(sum((c - mean) ** 2 for c in counts) / len(counts))
    assert flagged[0]["z"] == pytest.approx((95 - mean) / dev)
    assert [r["tx_count"] for r in mon.outliers(mon.trailing_zscores(daily)).collect()] == [95]
    flat = daily.withColumn("tx_count", F.lit(5))
    assert mon.outliers(mon.global_zscores(flat)).count() == 0
    assert mon.global_zscores(flat).where("z is not null").count() == 0


def chart(spark, rows, n=None):
    df = spark.createDataFrame([(f"r{i}", f"2024-01-{i + 1:02d}", s, f) for i, (s, f) in enumerate(rows)],
                               "run_id string, timestamp string, success bigint, failed bigint")
    return mon.p_chart(df, n).collect()


def test_p_chart(spark):
    steady = [(90, 10)] * 10
    assert chart(spark, steady)[0]["status"] == "OK"
    alert = chart(spark, steady + [(40, 60)])[0]
    assert alert["status"] == "ALERT" and alert["runs"] == 11 and alert["last_rate"] == 0.4
    assert chart(spark, [(1, 99)] * 5 + steady, 5)[0]["mean_rate"] == pytest.approx(0.9)
    assert chart(spark, []) == []
    assert chart(spark, [(0, 0)])[0]["status"] == "ALERT"
    sigma = chart(spark, [(90, 10), (80, 20)])[0]
    want = (math.sqrt(0.9 * 0.1 / 100) + math.sqrt(0.8 * 0.2 / 100)) / 2
    assert sigma["ucl"] - sigma["mean_rate"] == pytest.approx(3 * want)


def test_run_rates_and_summary(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "run_id string, ok boolean")
    assert {r["run_id"]: (r["success"], r["failed"], r["rate"]) for r in mon.run_rates(df, F.col("ok")).collect()} == {
        "a": (1, 1, 0.5), "b": (1, 0, 1.0)}
    batch = spark.createDataFrame([("x", date(2024, 1, 2), True, False), ("x", date(2024, 1, 9), True, True), ("y", None, False, False)],
                                  "message_id string, date date, parsed boolean, duplicate boolean")
    assert tuple(mon.run_summary(batch, "r").first()) == ("r", 3, 2, 1, 1, 1, date(2024, 1, 2))


def test_fingerprint(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["x", " y ", None, "é"]), rng.randint(0, 3)) for i in range(500)] + [(1, "dup", 0)] * 7
    df = spark.createDataFrame(rows, "b int, a string, c int")
    base = fp.fingerprint_of(df)
    rng.shuffle(rows)
    again = spark.createDataFrame(rows, "b int, a string, c int").repartition(7)
    assert fp.fingerprint_of(again.select("c", "a", "b")) == base
    assert fp.fingerprint_of(df.withColumn("a", F.trim("a"))) == base
    assert fp.fingerprint_of(spark.createDataFrame(rows[1:], df.schema)) != base
    assert fp.fingerprint_of(df.withColumn("a", F.concat("a", F.lit("!")))) != base
    # A cell may not be able to pass for two.
    assert fp.fingerprint_of(spark.createDataFrame([("1:a", "b")], "x string, y string")) != fp.fingerprint_of(
        spark.createDataFrame([("1", ":ab")], "x string, y string"))
    assert len(fp.fingerprint_of(df.limit(0))) == 64


def test_folder_fingerprint_depends_on_each_table(spark):
    a, b = spark.range(5).toDF("x"), spark.range(9).toDF("x")
    one = fp.folder_fingerprint({"a": a, "b": b}).first()
    assert one == fp.folder_fingerprint({"b": b, "a": a.repartition(3)}).first()
    assert one != fp.folder_fingerprint({"a": b, "b": a}).first() and one["n_rows"] == 14


def test_text_digests(spark):
    import hashlib

    from msgledger.functions.digest import blake2b_digest, text_digest

    df = spark.createDataFrame([("é x",), (None,)], "t string")
    got = df.select(text_digest(F.col("t")).alias("a"), blake2b_digest(F.col("t")).alias("b")).collect()
    assert got[0]["a"] == hashlib.sha256("é x".encode()).hexdigest()
    assert got[0]["b"] == hashlib.blake2b("é x".encode(), digest_size=32).hexdigest()
    assert got[1]["b"] is None


def test_canonical_order(spark):
    df = spark.createDataFrame([("b", "2024-01-02", 1), ("a", "2024-01-02", 2), ("z", "2024-01-01", 3)], "z string, date string, a int")
    out = fp.canonical_order(df)
    assert out.columns == ["a", "date", "z"] and [r["a"] for r in out.collect()] == [3, 1, 2]
    assert [r["z"] for r in fp.canonical_order(df.select("z")).collect()] == ["a", "b", "z"]


def test_run_log_update(spark):
    log = spark.createDataFrame([("a", 1), ("b", 2)], "run_id string, n int")
    prints = spark.createDataFrame([("b", "h")], "run_id string, run_hash string")
    assert sorted(tuple(r) for r in fp.update_run_log(log, prints).collect()) == [("a", 1, ""), ("b", 2, "h")]


def test_schema_spec(spark):
    s = build_schema({"a": {"type": "number", "required": True}, "b": {"type": "date"}})
    assert [f.dataType.simpleString() for f in s.fields] == ["decimal(18,2)", "date"]
    assert s["a"].metadata["required"] and not s["b"].metadata["required"]
    assert raw_schema().fieldNames() == list(TRANSACTIONS)
    out = project_to(spark.createDataFrame([("1.5", "x")], "amount string, junk string"))
    assert out.columns == RECORD.fieldNames() and str(out.first()["amount"]) == "1.50"


def test_validation(spark):
    fields = RECORD.fieldNames()
    good = dict(date="2024-01-05", internal_account_number="1", internal_entity="E", institution="B", external_entity=None,
                amount="1,5.00", available_balance=None, currency=None, description="d", transaction_type="t", source_email="s",
                message_id="m", run_id="r")
    cases = [
        ({}, set(), []),
        ({"date": "soon"}, set(), ["date: unreadable"]),
        ({}, {"currency"}, ["currency: missing"]),
        ({}, {"external_entity", "available_balance", "message_id", "run_id"}, []),
        ({"description": None, "amount": "x"}, set(), ["amount: unreadable", "description: null"]),
        ({"internal_entity": "Other"}, set(), ["internal_entity: not allowed"]),
    ]
    rows = []
    for i, (change, absent, _) in enumerate(cases):
        rec = {**good, **change}
        rows.append((i, [f for f in fields if f not in absent], *[rec[f] for f in fields]))
    df = spark.createDataFrame(rows, "i int, keys array<string>, " + ", ".join(f"{f} string" for f in fields))
    accounts = spark.createDataFrame([("E", "B")], "internal_entity string, institution string")
    out = val.with_allowed(df, accounts).withColumn("rec", val.typed_record())
    got = {r["i"]: r["errors"] for r in out.select("i", val.record_errors(F.col("keys"), F.col("rec")).alias("errors")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]


def test_flags_and_blanks(spark):
    df = project_to(spark.createDataFrame([("m", "", "r", 5.0), ("n", "ZAR", None, None)], "message_id string, currency string, run_id string, available_balance double"))
    flags = {r["message_id"]: r["reason"] for r in val.missing_flags(df).collect()}
    assert flags["m"].startswith("missing: internal_account_number") and "currency" in flags["m"] and "available_balance" not in flags["m"]
    assert flags["n"].endswith("run_id, available_balance")
    row = val.blank_nulls(df.withColumn("date", F.lit(date(2024, 1, 5)))).where("message_id = 'n'").first()
    assert row["run_id"] == "" and row["date"] == "2024-01-05" and row["available_balance"] is None


def test_replicates_are_written_without_a_sort(spark, tmp_path):
    matches = spark.range(200).selectExpr("cast(id % 4 AS int) run", "'m' || id message_id", "true struct_match", "id % 3 = 0 id_match", "id latency_ms")
    before = spark.conf.get(sinks.MAX_WRITERS)
    sinks.write_replicates(matches, matches.groupBy("run").count(), f"{tmp_path}/r")
    assert spark.conf.get(sinks.MAX_WRITERS) == before
    back = spark.read.csv(f"{tmp_path}/r/results", header=True, inferSchema=True)
    assert back.count() == 200 and {r["run"]: r["count"] for r in back.groupBy("run").count().collect()} == dict.fromkeys(range(4), 50)


# --- costly columns are worked out once -----------------------------------------

def _physical(df):
    """The plan before it has run; afterwards it would be shown twice."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def test_found_rows_do_not_repeat_their_expression(spark):
    rows = spark.createDataFrame([(1, '{"amount": "1.00"}'), (2, "no"), (3, None)], "id int, generated_text string")
    rows = rows.repartition(2, "id").withColumn("j", msg.generated_record(F.col("generated_text"), SYNONYMS))
    found = keep_found(rows, "j")
    assert [r["id"] for r in found.collect()] == [1] and found.columns == rows.columns
    assert found.schema["j"].dataType.simpleString() == rows.schema["j"].dataType.simpleString()
    assert _physical(found).count("from_json(") == 1


def test_failed_messages_read_their_text_once(spark):
    mails = spark.createDataFrame([("a", 1, "", "x"), ("b", 2, "ZAR 5.00", None), ("c", 3, None, '{"amount": 1}')],
                                  "message_id string, ord bigint, body string, generated_text string")
    accounts = spark.createDataFrame([("0000000001", "E", "I", 1)],
                                     "internal_account_number string, internal_entity string, institution string, position int")
    parsed = msg.parse_messages(mails.repartition(2, "ord"), accounts, "r")
    flags = msg.unparsed_flags(parsed)
    assert sorted(tuple(r) for r in flags.collect()) == [(("r"), m, "", "", "All parsers failed") for m in ("a", "c")]
    assert _physical(flags).count("Balance") == _physical(parsed).count("Balance")


def test_a_parser_reads_each_text_once(spark):
    rows = spark.createDataFrame([(1, "a 5.00"), (2, None)], "message_id int, body string").repartition(2, "message_id")

    def parse(frame):
        seen = F.regexp_extract(F.col("body"), "one pattern", 0)
        return frame.withColumn("t", seen).select("message_id", F.when(F.col("t").isNotNull(), F.struct("t")).alias("record"))

    got = msg.first_parsed(rows, [("p", parse)])
    assert [tuple(r) for r in got.select("message_id", "parser").collect()] == [(1, "p")]
    assert _physical(got).count("one pattern") == 1
