"""Runs that are repeated, streams that lose their checkpoint, and input that is not friendly."""
import base64
import os
import random
import time
from datetime import date, datetime

import pytest
from conftest import SF
from pyspark.sql import functions as F

from msgledger.functions import extract, text as tx
from msgledger.functions.clean import account_number, to_date
from msgledger.operators import fingerprint as fp
from msgledger.operators.ledger import fill_balances, known_ids, last_balances
from msgledger.options import Limits
from msgledger.plans import views
from msgledger.plans.runs import LEDGER, Paths, batch_run
from msgledger.session import scratch, shared_dir, spread, stage_table
from msgledger.sinks import state, tables as sinks
from msgledger.sources import plugin, tables as src
from msgledger.streaming import ingest

RECORD = "message_id string, ord long, amount int"


def deliver(spark, folder, ids):
    spark.createDataFrame([(i, n, n) for n, i in enumerate(ids)], RECORD).coalesce(1).write.mode("append").parquet(folder)


def in_ledger(spark, path):
    return sorted(r["message_id"] for r in sinks.read_ledger(spark, path, ledger_type(spark)).collect())


def ledger_type(spark):
    return spark.createDataFrame([], f"{RECORD}, run_id string").schema


def follow(spark, folder, ledger, checkpoint):
    stream = ingest.landed_stream(spark, folder, spark.createDataFrame([], RECORD).schema, max_files=1)
    ingest.run_incremental(stream, lambda b: b, ledger, checkpoint)


def test_two_streams_share_a_ledger(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    for name in ("a", "b"):
        deliver(spark, f"{tmp_path}/{name}", [f"{name}{i}" for i in range(5)])
        follow(spark, f"{tmp_path}/{name}", ledger, f"{tmp_path}/state-{name}")
    assert in_ledger(spark, ledger) == [f"{n}{i}" for n in "ab" for i in range(5)]


def test_a_lost_checkpoint_loses_no_rows(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    deliver(spark, f"{tmp_path}/old", ["a", "b"])
    follow(spark, f"{tmp_path}/old", ledger, f"{tmp_path}/state-1")
    deliver(spark, f"{tmp_path}/new", ["b", "c"])  # the old files are gone, and so is the checkpoint
    follow(spark, f"{tmp_path}/new", ledger, f"{tmp_path}/state-2")
    assert in_ledger(spark, ledger) == ["a", "b", "c"]


def test_a_partition_with_other_ids_is_not_replaced(spark):
    ledger = spark.createDataFrame([("a", "run-1"), ("b", "run-2")], "message_id string, run_id string")
    ingest.check_replaced(ledger, "run-1", spark.createDataFrame([("a",), ("x",)], "message_id string"))
    with pytest.raises(RuntimeError, match="run-1"):
        ingest.check_replaced(ledger, "run-1", spark.createDataFrame([("x",)], "message_id string"))


def test_stream_of_mail_takes_the_batch_path(spark, tmp_path):
    inbox = views.answers(spark, SF).where("ord < 60").select("message_id", "ord", "body", "generated_text")
    inbox = inbox.withColumn("sender", F.lit("a@b.example")).withColumn("subject", F.lit("s"))
    accounts = views.accounts(spark, SF)
    paths = Paths(f"{tmp_path}/ledger", f"{tmp_path}/flags", f"{tmp_path}/log")
    for part in ("ord < 40", "ord >= 30"):
        inbox.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ingest.landed_stream(spark, f"{tmp_path}/in", inbox.schema)
        ingest.ingest_messages(stream, lambda b: b, accounts, paths, f"{tmp_path}/state")
    rows = sinks.read_ledger(spark, paths.ledger, LEDGER).collect()
    assert len(rows) == len({r["message_id"] for r in rows}) == inbox.where("ord % 16 <> 6").count()
    assert sorted(r["record_id"] for r in rows) == list(range(1, len(rows) + 1))
    flags = spark.read.parquet(paths.flags)
    assert {(r["sender"], r["subject"]) for r in flags.collect()} == {("a@b.example", "s")}
    # A message no parser could read is not in the ledger, so it is tried again when it comes again.
    assert flags.where("reason = 'All parsers failed'").select("message_id").distinct().count() == inbox.where("ord % 16 = 6").count()


def test_a_repeat_without_rows_empties_its_run(spark, tmp_path):
    paths = Paths(f"{tmp_path}/ledger", f"{tmp_path}/flags", f"{tmp_path}/log")
    inbox = views.answers(spark, SF).where("ord < 20").select("message_id", "ord", "body", "generated_text")
    accounts = views.accounts(spark, SF)
    batch_run(inbox, accounts, "r 1/a", paths)
    assert sinks.read_ledger(spark, paths.ledger, LEDGER).count() > 0
    assert batch_run(inbox.where("false"), accounts, "r 1/a", paths).first()["written"] == 0
    assert sinks.read_ledger(spark, paths.ledger, LEDGER).count() == 0
    assert not [f for _, _, names in os.walk(paths.flags) for f in names if f.startswith("part-")]


def test_a_run_leaves_nothing_staged(spark, tmp_path):
    root = f"{shared_dir(spark)}/msgledger"
    before = set(os.listdir(root)) if os.path.exists(root) else set()
    inbox = views.answers(spark, SF).where("ord < 20").select("message_id", "ord", "body", "generated_text")
    batch_run(inbox, src.accounts_from(spark, []), "r1", Paths(*(f"{tmp_path}/{x}" for x in "abc")))
    assert set(os.listdir(root)) == before
    with pytest.raises(ValueError), scratch(spark):
        stage_table(spark.range(3), "lost")
        raise ValueError
    assert set(os.listdir(root)) == before


def test_filing_attachments_twice_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("m", 1, "business", "x"), ("m", 2, "person", "y")], "message_id string, part int, owner_class string, file string")
    rows = rows.withColumn("date", F.lit("2024-01-05").cast("date"))
    for _ in range(2):
        sinks.write_attachments(rows, f"{tmp_path}/files")
    sinks.write_attachments(rows.withColumn("part", F.col("part") + 1), f"{tmp_path}/files")
    assert spark.read.parquet(f"{tmp_path}/files").count() == 3


def test_base64_that_is_none(column):
    good = base64.urlsafe_b64encode("é text".encode()).decode()
    texts = [good, good.rstrip("="), "a", "abcde", "ab=c=", "", None, " aGk=\r\n", "%%%%"]
    assert column(tx.decode_base64url, texts) == ["é text", "é text", None, None, None, "", None, "hi", None]


def test_a_broken_part_falls_back_to_the_snippet(spark):
    rows = spark.createDataFrame([("text/plain", "abcde", "snip"), ("text/plain", "aGk", "snip"), (None, None, None)], "k string, d string, s string")
    got = [r[0] for r in rows.select(tx.body_text(F.col("k"), F.col("d"), F.col("s"))).collect()]
    assert got == ["snip", "hi", ""]


def test_account_numbers_from_doubles(column):
    texts = ["1.2345678901E10", "12345.0", "1.0E7", "1.5E0", "12e4x", "0012", None]
    assert column(account_number, texts) == ["12345678901", "12345", "10000000", "1.5E0", "12e4x", "0012", None]


def test_null_and_empty_are_one_account(spark):
    rows = [(None, 1, None, 10), ("", 2, 100, 5), (None, 3, None, 7), ("a", 1, None, 1)]
    df = spark.createDataFrame(rows, "internal_account_number string, ord long, available_balance int, amount int").select(
        "internal_account_number", "ord", F.col("available_balance").cast("decimal(28,2)"), F.col("amount").cast("decimal(18,2)"),
        F.lit("2024-01-01").cast("date").alias("date"))
    for limits in (Limits(), Limits(hot_key_rows=1, chunk_rows=1, broadcast_rows=10)):
        got = {(r["internal_account_number"], r["ord"]): r["available_balance"] for r in fill_balances(df, limits=limits).collect()}
        assert (got[(None, 1)], got[("", 2)], got[(None, 3)], got[("a", 1)]) == (90, 100, 107, None)


def test_fingerprint_knows_names(spark):
    rows = [("1", "2"), ("3", "4")]
    one, other = (spark.createDataFrame(rows, f"{x} string, {y} string") for x, y in ("ab", "cd"))
    assert fp.fingerprint_of(one) != fp.fingerprint_of(other)
    assert fp.fingerprint_of(one.limit(0)) != fp.fingerprint_of(other.limit(0))


def test_fingerprint_sums_are_wide(spark):
    plan = fp.table_fingerprint(spark.range(1))._jdf.queryExecution().analyzed().toString()
    assert "decimal(38,0)" in plan and "sum(w0" in plan
    top = spark.range(1000).select(F.lit("18446744073709551615").cast("decimal(38,0)").alias("w"))
    assert str(top.agg(F.sum("w")).schema[0].dataType) == "DecimalType(38,0)"


@pytest.mark.parametrize("text", ["{" * 400_000 + "}", "{a" * 200_000 + "}" * 100_000])
def test_first_object_is_linear(spark, text):
    took = [timed(spark, extract.first_json_object, part) for part in (text[:len(text) // 4] + "}", text)]
    assert took[1] < 8 * took[0] + 3


@pytest.mark.parametrize("label", ["Available balance ", "New balance x "])
def test_balance_is_linear(spark, label):
    text = label * 70_000
    for end in ("", "5", "5.00"):
        took = [timed(spark, lambda c: extract.balance(c)["balance"].cast("string"), part + end) for part in (text[:len(text) // 4], text)]
        assert took[1] < 8 * took[0] + 3


def timed(spark, fn, text):
    df = spark.createDataFrame([(text,)], "x string")
    start = time.perf_counter()
    df.select(fn(F.col("x"))).collect()
    return time.perf_counter() - start


def test_first_object_of_any_braces(column):
    rng = random.Random(3)
    texts = ["".join(rng.choice("{}ab") for _ in range(rng.randint(0, 14))) for _ in range(500)]

    def slow(text):
        opened, best = [], None
        for i, c in enumerate(text):
            if c == "{":
                opened.append(i)
            elif c == "}" and opened:
                pair = (opened.pop(), i)
                best = pair if best is None or pair < best else best
        return None if best is None else text[best[0]:best[1] + 1]

    assert column(extract.first_json_object, texts) == [slow(t) for t in texts]


def test_free_form_dates(column):
    texts = ["Fri Jan 5 10:00:00 2024", "Monday 5 January 2024", "05JAN2024", "Jan-05-2024", "2024 Jan 5", "2024-Jan-05",
             "10:00 5 January 2024", "5 Jan 2024", "January 5, 2024", "Jan 5th, 2024", "5-Jan-2024", "20240105"]
    assert column(to_date, texts) == [date(2024, 1, 5)] * len(texts)
    assert column(tx.mail_timestamp, ["Fri, 5 Jan 24 10:00:00 +0000", "5 Jan 99 10:00"]) == [
        datetime(2024, 1, 5, 10), datetime(1999, 1, 5, 10)]


# --- copies, arrivals, marks and balances -------------------------------------

def inbox_of(spark, n):
    return views.answers(spark, SF).where(f"ord < {n}").select("message_id", "ord", "body", "generated_text")


def test_copies_at_one_place_enter_once(spark, tmp_path):
    inbox, accounts = stage_table(inbox_of(spark, 40), "inbox"), views.accounts(spark, SF)
    paths = Paths(*(f"{tmp_path}/{x}" for x in ("ledger", "flags", "log")))
    other = inbox.where("ord % 4 = 0").withColumn("body", F.lit("another text under the same id"))
    copies = inbox.unionByName(inbox).unionByName(inbox).unionByName(other).unionByName(inbox.withColumn("ord", F.col("ord") + 1000))
    summary = batch_run(copies, accounts, "r1", paths).first()
    rows = sinks.read_ledger(spark, paths.ledger, LEDGER).collect()
    assert len(rows) == len({r["message_id"] for r in rows}) == summary["written"]
    assert sorted(r["record_id"] for r in rows) == list(range(1, len(rows) + 1))
    assert summary["fetched"] == copies.count() == summary["written"] + summary["failed"] + summary["duplicate"]
    assert batch_run(copies, accounts, "r2", paths).first()["written"] == 0
    # Mail without a place, as a source that gives none.
    bare = Paths(*(f"{tmp_path}/bare-{x}" for x in ("ledger", "flags", "log")))
    unplaced = inbox.withColumn("ord", F.lit(None).cast("bigint"))
    batch_run(unplaced.unionByName(unplaced), accounts, "r1", bare)
    assert sinks.read_ledger(spark, bare.ledger, LEDGER).count() == len(rows)


def arrive(spark, tmp_path, rows, paths, state="state"):
    rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ingest.landed_stream(spark, f"{tmp_path}/in", rows.schema, max_files=1)
    ingest.ingest_arrivals(stream, lambda b: b, views.accounts(spark, SF), paths, f"{tmp_path}/{state}")


def test_arrivals_do_not_read_the_ledger(spark, tmp_path):
    inbox = stage_table(inbox_of(spark, 80), "inbox")
    paths = Paths(*(f"{tmp_path}/{x}" for x in ("ledger", "flags", "log", "balances")))
    batch_run(inbox.where("ord < 30"), views.accounts(spark, SF), "before", paths)
    arrive(spark, tmp_path, inbox.where("ord < 50").unionByName(inbox.where("ord BETWEEN 30 AND 40")), paths)
    first = sinks.read_ledger(spark, paths.ledger, LEDGER).collect()
    assert {r["message_id"] for r in first} == {r[0] for r in inbox.where("ord < 50 AND ord % 16 <> 6").select("message_id").collect()}
    # From here on, whoever opens a file of the ledger fails.
    for folder, _, names in os.walk(paths.ledger):
        for name in names:
            if name.endswith(".parquet"):
                os.remove(f"{folder}/{name}")
                with open(f"{folder}/{name}", "wb") as f:
                    f.write(b"not parquet")
    arrive(spark, tmp_path, inbox.where("ord >= 40"), paths)
    arrive(spark, tmp_path, inbox.where("ord < 60"), paths)
    runs = [d for d in os.listdir(paths.ledger) if d.startswith("run_id=") and "before" not in d]
    fresh = []
    for run in sorted(runs):
        try:
            fresh += spark.read.parquet(f"{paths.ledger}/{run}").collect()
        except Exception:  # noqa: BLE001 - the first batch's own files are broken, too
            continue
    assert {r["message_id"] for r in fresh} == {r[0] for r in inbox.where("ord >= 50 AND ord % 16 <> 6").select("message_id").collect()}
    top = max(r["record_id"] for r in first)
    assert sorted(r["record_id"] for r in fresh) == list(range(top + 1, top + 1 + len(fresh)))


def test_arrivals_survive_a_lost_checkpoint(spark, tmp_path):
    inbox = stage_table(inbox_of(spark, 40), "inbox")
    paths = Paths(*(f"{tmp_path}/{x}" for x in ("ledger", "flags", "log")))
    arrive(spark, tmp_path, inbox.where("ord < 30"), paths)
    arrive(spark, tmp_path, inbox, paths, state="another")  # reads all that landed once more
    rows = sinks.read_ledger(spark, paths.ledger, LEDGER).collect()
    assert len(rows) == len({r["message_id"] for r in rows}) == inbox.where("ord % 16 <> 6").count()
    assert sorted(r["record_id"] for r in rows) == list(range(1, len(rows) + 1))


def test_first_arrivals_are_remembered_outside_python(spark, tmp_path):
    schema = "message_id string, ord long, body string"
    rows = [(k, n, f"{k}{n}") for n in range(20) for k in ("a", "b", None, "known")]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{tmp_path}/in")
    spark.createDataFrame([("known",)], "message_id string").write.parquet(f"{tmp_path}/known")
    stream = ingest.landed_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
    known = ingest.landed_stream(spark, f"{tmp_path}/known", spark.createDataFrame([], "message_id string").schema)
    for _ in range(2):  # the second time the same rows have landed once more
        with ingest.state_store(spark):
            query = ingest.first_arrivals(stream, known, 30).writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
                "checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
            query.awaitTermination()
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
    assert query.lastProgress["stateOperators"][0]["operatorName"] == "dedupeWithinWatermark"
    got = {tuple(r) for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()}
    assert got == {("a", 0, "a0"), ("b", 0, "b0"), (None, 0, "None0")}


def test_marks_number_repeated_runs(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    assert state.last_record_id(spark, ledger, "a") is None
    for run, last in (("a", 10), ("b/1", 25), ("c", 30)):
        state.mark_record_ids(spark, ledger, run, last)
    assert [state.last_record_id(spark, ledger, r) for r in ("a", "b/1", "c", "new")] == [30, 30, 25, 30]
    state.mark_record_ids(spark, ledger, "c", 28)
    assert [state.last_record_id(spark, ledger, r) for r in ("c", "new")] == [25, 28]
    assert len([n for n in os.listdir(f"{ledger}/_marks") if not n.startswith(".")]) == 2


BALANCE_ROWS = "internal_account_number string, date date, ord long, available_balance decimal(28,2), amount decimal(18,2)"


@pytest.mark.parametrize("limits", [Limits(), Limits(hot_key_rows=3, chunk_rows=2, broadcast_rows=10)])
def test_five_runs_fill_as_one(spark, tmp_path, limits):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "", None]), date(2024, 1, 1 + n // 12), n, rng.choice([None, None, None, rng.randint(0, 500)]), rng.choice([None, rng.randint(-9, 9)]))
            for n in range(120)]
    df = stage_table(spark.createDataFrame([(a, d, n, b, m) for a, d, n, b, m in rows], BALANCE_ROWS.replace("decimal(28,2)", "int").replace(
        "decimal(18,2)", "int")).selectExpr("internal_account_number", "date", "ord", "cast(available_balance AS decimal(28,2)) available_balance",
                                            "cast(amount AS decimal(18,2)) amount"), "rows")
    want = {r["ord"]: r["available_balance"] for r in fill_balances(df, forward_only=True, limits=limits).collect()}
    got = {}
    for run in range(5):
        part = df.where(f"ord >= {24 * run} AND ord < {24 * run + 24}")
        for attempt in range(2):  # a run that is repeated does not see its own balances
            filled = stage_table(fill_balances(part, forward_only=True, limits=limits, carried=state.carried_balances(
                spark, f"{tmp_path}/balances", f"run-{run}")), "filled")
            state.save_balances(last_balances(filled), f"{tmp_path}/balances", f"run-{run}", 24 * run + 24)
        got |= {r["ord"]: r["available_balance"] for r in filled.collect()}
    assert got == want
    before = {tuple(r) for r in state.carried_balances(spark, f"{tmp_path}/balances", "next").collect()}
    assert state.merge_balances(spark, f"{tmp_path}/balances", keep=2, above=3)
    assert not state.merge_balances(spark, f"{tmp_path}/balances", keep=2, above=3)
    assert {tuple(r) for r in state.carried_balances(spark, f"{tmp_path}/balances", "next").collect()} == before


def rows_scanned(df):
    """Rows that the scan of a collected frame has handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan
    while not plan.children().isEmpty():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_few_ids_skip_row_groups(spark, tmp_path):
    rng = random.Random(3)
    ids = [f"{rng.getrandbits(64):016x}" for _ in range(20_000)]
    rows = spark.createDataFrame([(i, "r1") for i in ids], "message_id string, run_id string").coalesce(1)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
    try:
        sinks.write_ledger(rows, f"{tmp_path}/ledger")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    ledger = sinks.read_ledger(spark, f"{tmp_path}/ledger", rows.schema)

    def known(wanted, **limits):
        frame = spark.createDataFrame([(i,) for i in wanted], "message_id string")
        return known_ids(ledger, frame, len(wanted), Limits(**limits))

    absent = [f"{rng.getrandbits(64):016x}" for _ in range(40)]
    few = known([ids[5], ids[6], *absent, None, ""])
    assert sorted(r[0] for r in few.collect()) == sorted(ids[5:7])
    assert rows_scanned(few) < 6000 and rows_scanned(known(absent)) < 3000
    assert rows_scanned(known([ids[5]] * 3, pushed_ids=2)) == 20_000
    assert known([]).count() == 0


def test_spread_knows_empty_splits(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "cast(id AS string) s").coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        one = spark.read.parquet(f"{tmp_path}/one")
        assert one.rdd.getNumPartitions() > 1
        assert "Exchange" in spread(one, "id")._jdf.queryExecution().executedPlan().toString()
        spark.range(50_000).repartition(3).write.parquet(f"{tmp_path}/three")
        assert "Exchange" not in spread(spark.read.parquet(f"{tmp_path}/three"), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_spread_fills_the_cores(spark, tmp_path):
    """Two row groups, or two files of one split each, would keep two of four cores busy."""
    rows = spark.range(60_000).selectExpr("id", "cast(id AS string) s")
    rows.coalesce(1).write.option("parquet.block.size", 200_000).option("parquet.page.size", 20_000).parquet(f"{tmp_path}/groups")
    rows.repartition(2).write.parquet(f"{tmp_path}/files")
    for folder in ("groups", "files"):
        scan = spark.read.parquet(f"{tmp_path}/{folder}")
        assert spread(scan, "id").rdd.getNumPartitions() == 4
        assert spread(scan, "id").agg(F.sum("id"), F.count("*")).first()[:] == (60_000 * 59_999 // 2, 60_000)


# --- manifests and polled sources ----------------------------------------------

def test_manifest_follows_the_ledger(spark, tmp_path):
    ledger, manifest = f"{tmp_path}/ledger", f"{tmp_path}/manifest"
    schema = "message_id string, amount int, run_id string"
    kind = spark.createDataFrame([], schema).schema

    def write(run, rows):
        sinks.write_ledger(spark.createDataFrame([(i, n, run) for i, n in rows], schema), ledger, run_id=run)
        state.save_digest(spark, ledger, manifest, run, kind)

    def check(n):
        got = state.ledger_fingerprint(spark, manifest, kind).first()
        assert tuple(got) == tuple(fp.table_fingerprint(sinks.read_ledger(spark, ledger, kind)).first()) and got["n_rows"] == n

    check(0)
    write("a/1", [("x", 1), ("x", 1), ("y", None)])
    write("b", [("z", 5)])
    check(4)
    write("a/1", [("x", 2)])
    check(2)
    state.forget_run(spark, ledger, manifest, "b")
    check(1)
    write("a/1", [])
    check(0)


def test_a_polled_source_resumes(spark, tmp_path):
    plugin.register(spark, plugin.OrderNotices)
    root = str(tmp_path)
    got = []

    def deliver_ids(lo, hi):
        spark.range(lo, hi).selectExpr("id AS o_orderkey", "id AS o_custkey", "'p' AS o_orderpriority").repartition(2).write.mode("append").parquet(f"{root}/orders")

    def poll(fail=False):
        def each(batch, n):
            rows = [r["id"] for r in batch.collect()]
            if fail:
                raise ValueError("lost")
            got.extend(rows)

        stream = spark.readStream.format("order_notices").option("path", f"{root}/orders").load()
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
        query.awaitTermination()

    deliver_ids(0, 50)
    poll()
    assert sorted(got) == list(range(50))
    poll()
    deliver_ids(50, 80)
    with pytest.raises(Exception, match="lost"):
        poll(fail=True)
    deliver_ids(80, 90)
    poll()  # the lost batch, with the rows it had
    assert sorted(got) == list(range(80))
    poll()
    assert sorted(got) == list(range(90))


def test_since_reaches_a_plug_in(spark, tmp_path):
    plugin.register(spark, plugin.OrderNotices)
    for lo in (0, 100, 200):
        spark.range(lo, lo + 100).selectExpr("id AS o_orderkey", "id AS o_custkey", "'p' AS o_orderpriority").coalesce(1).write.mode("append").parquet(f"{tmp_path}/o")
    source = spark.read.format("order_notices").option("path", f"{tmp_path}/o").load()
    late = source.where("id > 150 AND priority = 'p'")
    assert sorted(r["id"] for r in late.collect()) == list(range(151, 300))
    assert source.rdd.getNumPartitions() == 3 and late.rdd.getNumPartitions() == 2
    assert plugin.OrderNotices.between({"at": 99}, {"at": 199}, {"path": f"{tmp_path}/o"})[0][2:] == (99, 199)
    assert len(plugin.OrderNotices.between({"at": 99}, {"at": 199}, {"path": f"{tmp_path}/o"})) == 1
