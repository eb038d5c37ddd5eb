import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF
from msgledger.operators import messages as msg
from msgledger.operators.ledger import dedupe_batch
from msgledger.plans import views
from msgledger.plans.runs import LEDGER, Paths, batch_run, replicate_run, run_metadata
from msgledger.session import shared_dir, stage_table
from msgledger.sinks import tables as sinks
from msgledger.sources import landing, plugin, tables as src
from msgledger.streaming import ingest


def test_message_scan(spark, tmp_path):
    m = {"id": "1", "internalDate": "0", "snippet": "s", "labels": ["Banking"], "ord": 1,
         "payload": {"mimeType": "text/plain", "headers": [{"name": "From", "value": "a@b.example"}], "parts": [{"x": 1}]}}
    (tmp_path / "in.json").write_text(json.dumps(m) + "\n")
    row = landing.scan_messages(spark, str(tmp_path)).first()
    assert json.loads(row["payload"]) == m["payload"] and row["labels"] == ["Banking"]


def test_message_filter(spark):
    df = spark.createDataFrame([
        (1, ["Banking"], "A <x@bank.example>", "Transaction done", date(2024, 1, 5)),
        (2, ["Other"], "x@bank.example", "transaction", date(2024, 1, 5)),
        (3, ["Banking"], "x@shop.example", "transaction", date(2024, 1, 5)),
        (4, ["Banking"], "x@bank.example", "news", date(2024, 1, 5)),
        (5, ["Banking"], "x@bank.example", "transaction", date(2023, 1, 5)),
    ], "i int, labels array<string>, sender string, subject string, sent_date date")
    cond = landing.query_filter("subject:transaction", senders=["bank.example", "other.example"], label="Banking", since="2024/01/01")
    assert [r["i"] for r in df.where(cond).collect()] == [1]
    assert [r["i"] for r in df.where(landing.query_filter({"subject": "news", "label": "Banking"})).collect()] == [4]
    assert df.where(landing.message_filter()).count() == 5
    assert landing.canonical_query({"b": 1, "a": "x"}) == "a:x b:1" and landing.canonical_query(None) == ""
    assert [r["i"] for r in landing.first_messages(df, 2, ["i"]).collect()] == [1, 2]


def test_query_texts(spark):
    df = spark.createDataFrame([
        (1, ["Banking"], "a@one.example", "Bank alert today", "x invoice", date(2024, 1, 5)),
        (2, ["Other"], "b@two.example", "alert bank", "y", date(2024, 1, 6)),
        (3, ["Banking"], "c@three.example", "Bank Alert", "z Invoice", date(2023, 1, 5)),
    ], "i int, labels array<string>, sender string, subject string, body string, sent_date date")

    def found(query, **kw):
        return [r["i"] for r in df.where(landing.query_filter(query, **kw)).collect()]

    assert found("(from:one.example OR from:two.example)") == [1, 2]
    assert found("from:one.example OR from:two.example OR from:three.example") == [1, 2, 3]
    assert found("(from:one.example OR from:three.example) label:Banking after:2024/01/01") == [1]
    assert found('subject:"bank alert"') == [1, 3] and found('"alert bank"') == [2]
    assert found("invoice", words_in=("subject", "body")) == [1, 3] and found("invoice") == []
    assert found("alert (label:Other OR (from:three.example subject:bank))") == [2, 3]
    assert found("") == found(None) == found("   ") == [1, 2, 3]
    for bad in ("has:attachment", "-from:x", "(from:a", "from:a)", "OR from:a", "from:a OR", "()", '"open'):
        with pytest.raises(ValueError):
            landing.query_filter(bad)


def test_messages_of_a_mailbox_without_own_columns(spark, tmp_path):
    raw = [{"id": "b", "internalDate": "2000", "snippet": "s", "labelIds": ["Banking"], "payload": {}},
           {"id": "a", "internalDate": "1000", "snippet": "s", "labelIds": ["Other"], "payload": {}},
           {"id": "c", "internalDate": "1000", "snippet": "s", "payload": {}}]
    (tmp_path / "in.json").write_text("\n".join([*map(json.dumps, raw), "{broken", ""]))
    rows = landing.scan_messages(spark, str(tmp_path)).orderBy("ord").collect()
    assert {r["id"] for r in rows[1:3]} == {"a", "c"} and rows[3]["id"] == "b"
    assert len({r["ord"] for r in rows}) == 4 and rows[0]["corrupt"] == "{broken" and rows[0]["id"].startswith("corrupt-")
    df = landing.scan_messages(spark, str(tmp_path))
    assert [r["id"] for r in df.where(landing.query_filter("label:Banking")).collect()] == ["b"]
    assert msg.read_messages(df).where("corrupt IS NOT NULL").first()["body"] == ""


def test_senders(spark, tmp_path):
    (tmp_path / "s.csv").write_text(" Bank.Example ,x\n\n  \nme@shop.example\n")
    allowed = landing.scan_senders(spark, str(tmp_path / "s.csv"))
    df = spark.createDataFrame([(1, "A <a@bank.example>"), (2, "ME@shop.example"), (3, "you@shop.example"), (4, "none")], "i int, sender string")
    assert sorted(r["i"] for r in landing.from_senders(df, allowed).collect()) == [1, 2]
    assert landing.scan_senders(spark, str(tmp_path / "missing.csv")) is None
    assert landing.from_senders(df, None).count() == 4


def test_attachments(spark):
    tree = {"mimeType": "m", "parts": [
        {"filename": "A.PDF", "body": {"attachmentId": "1"}}, {"filename": "b.pdf", "body": {}}, {"filename": "c.png", "body": {"attachmentId": "2"}},
        {"mimeType": "m", "parts": [{"mimeType": "m", "parts": [{"filename": "deep.pdf", "body": {"attachmentId": "3"}}]}]}]}
    df = spark.createDataFrame([("x", json.dumps(tree))], "id string, payload string")
    assert sorted(r["filename"] for r in landing.pdf_attachments(df).collect()) == ["A.PDF", "deep.pdf"]
    assert [r["filename"] for r in landing.pdf_attachments(df, top_level_only=True).collect()] == ["A.PDF"]


def test_high_water_mark(spark):
    log = spark.createDataFrame([(datetime(2024, 1, 1, 10),), (datetime(2024, 1, 2, 10),)], "t timestamp")
    assert src.high_water_mark(log, "t", 2).first()["since"] == datetime(2024, 1, 2, 8)
    assert src.high_water_mark(log, "t", 2, start="2023-01-01").first()["since"] == datetime(2023, 1, 1)
    assert src.high_water_mark(log, "t", 2, force=True).first()["since"] is None
    assert src.high_water_mark(log.limit(0), "t").first()["since"] is None


def test_history_round_trip(spark, tmp_path):
    runs = spark.createDataFrame([("r1", "2024-01-01T00:00:00", 5)], "run_id string, run_timestamp string, fetched_messages bigint")
    sinks.append_run_log(runs, f"{tmp_path}/log")
    sinks.append_run_log(runs.withColumn("run_id", F.lit("r2")), f"{tmp_path}/log")
    assert sorted((r["run_id"], r["fetched_messages"], r["run_hash"]) for r in src.scan_run_log(spark, f"{tmp_path}/log").collect()) == [("r1", 5, None), ("r2", 5, None)]
    meta = run_metadata(spark.range(3).toDF("x"), spark.createDataFrame([("r1",), ("r9",)], "run_id string"), "r1", 1.23456)
    sinks.append_run_meta(meta, f"{tmp_path}/meta")
    row = src.scan_run_meta(spark, f"{tmp_path}/meta").first()
    assert (row["success"], row["failed"], row["latency_sec"], len(row["run_hash"])) == (1, 1, 1.235, 64)


def test_owner_scan(spark, tmp_path):
    (tmp_path / "o.csv").write_text("internal_account_number,institution,owner_type\n0012,B,personal\n")
    assert tuple(src.scan_owners(spark, str(tmp_path / "o.csv")).first())[:3] == ("0012", "B", "personal")


def test_ledger_partitions(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    schema = "message_id string, run_id string"
    assert sinks.read_ledger(spark, path).count() == 0
    sinks.write_ledger(spark.createDataFrame([("a", "1"), ("b", "2")], schema), path)
    sinks.write_ledger(spark.createDataFrame([("c", "2")], schema), path)
    fields = spark.createDataFrame([], schema).schema
    assert sorted(tuple(r) for r in sinks.read_ledger(spark, path, fields).collect()) == [("a", "1"), ("c", "2")]
    assert [r["message_id"] for r in sinks.read_run(spark, path, "2", fields).collect()] == ["c"]


def test_warehouse_load_is_best_effort(spark):
    assert sinks.load_warehouse(spark.range(1), "jdbc:nosuchdriver:x", "t") is False


def test_attachment_targets(spark, tmp_path):
    df = spark.createDataFrame([("business", date(2024, 3, 5), "a"), ("personal", date(2024, 11, 5), "b"), ("unclassified", date(2023, 1, 1), "c")],
                               "owner_class string, date date, filename string")
    sinks.write_attachments(df, f"{tmp_path}/files")
    got = {(r["filename"], r["bucket"], r["year"], r["month"]) for r in spark.read.schema(
        "filename string, bucket string, year string, month string").parquet(f"{tmp_path}/files").collect()}
    assert got == {("a", "Company", "2024", "03"), ("b", "Personal", "2024", "11"), ("c", "Personal", "2023", "01")}


def test_attachment_text(spark):
    m = spark.createDataFrame([("a", "body"), ("b", "body"), ("c", "body")], "message_id string, body string")
    t = spark.createDataFrame([("a", ["p1", None, "", "p2"]), ("b", [])], "message_id string, texts array<string>")
    assert {r["message_id"]: r["body"] for r in msg.append_attachment_text(m, t).collect()} == {"a": "body\n\np1\n\np2", "b": "body", "c": "body"}


def test_prompt(spark):
    accounts = spark.createDataFrame(
        [(" 12 3456", "Old ", 1), ("00 7777", "Next", 2), ("993456", "New", 3), ("123", "Short", 4)],
        "internal_account_number string, internal_entity string, position int")
    block = spark.range(1).select(msg.account_reference(accounts)).first()[0]
    assert block == "Your internal accounts:\n- New (993456) (last4=3456)\n- Next (00 7777) (last4=7777)"
    assert spark.range(1).select(msg.account_reference(accounts.limit(0))).first()[0] == "Your internal accounts:"
    df = spark.createDataFrame([("a@b", "s" * 200, "text")], "f string, s string, b string")
    text = df.select(msg.prompt(accounts, F.col("f"), F.col("s"), F.col("b")).alias("p")).first()["p"]
    assert f"Subject: {'s' * 120}\n" in text and '"""text"""' in text and "From: a@b" in text


def test_prompt_digests_are_of_whole_prompts(spark):
    accounts = spark.range(300).selectExpr("lpad(id, 10, '0') internal_account_number", "'Käufer' || id internal_entity", "id position")
    rows = [("a@b", "s" * 200, "text"), (None, None, None), ("é", "€ sübject", "body\n\U0001f600"), ("", "", "")]
    df = spark.createDataFrame(rows, "f string, s string, b string").repartition(2)
    for listed in (accounts, accounts.limit(0), None):
        asked = (listed, F.col("f"), F.col("s"), F.col("b"))
        got = msg.prompt_digests(df, *asked).withColumn("p", msg.prompt(*asked)).select("chars", "prompt_sha256", F.length("p"), F.sha2("p", 256))
        assert all(r[0] == r[2] and r[1] == r[3] for r in got.collect()) and got.count() == 4


def test_hybrid_paths(spark):
    accounts = src.accounts_from(spark, [{"internal_account_number": "1000200030", "internal_entity": "E", "institution": "B"}])
    good = {"date": "01/02/2024", "internal_account_number": 30.0, "internal_entity": "?", "institution": "?", "external_entity": "B pos",
            "amount": "1,234.50", "currency": "ZAR", "description": "Card purchase Shop A", "transaction_type": "card", "source_email": "x",
            "message_id": "made up", "extra": 1}
    rows = [
        ("ok", "no", json.dumps(good)),
        ("number", "no", json.dumps({**good, "internal_account_number": 200030})),
        ("entity", "ZAR 5.00 on 2024-01-05", json.dumps({**good, "internal_account_number": "77"})),
        ("missing", "Paid to: Shop", json.dumps({k: v for k, v in good.items() if k != "currency"})),
        ("null", "x", json.dumps({**good, "description": None})),
        ("none", "", "nothing"),
        ("null text", None, None),
    ]
    df = spark.createDataFrame([(r[0], i, r[1], r[2]) for i, r in enumerate(rows)], "message_id string, ord bigint, body string, generated_text string")
    got = {r["message_id"]: r for r in msg.parse_messages(df, accounts, "run").collect()}
    assert {k: v["parse_path"] for k, v in got.items()} == {
        "ok": "json", "number": "json", "entity": "regex", "missing": "regex", "null": "regex", "none": "failed", "null text": "failed"}
    ok = got["ok"]
    assert (ok["date"], ok["internal_account_number"], ok["internal_entity"], ok["external_entity"], str(ok["amount"]), ok["run_id"]) == (
        date(2024, 1, 2), "30", "E", "Shop A", "1234.50", "run")
    assert got["entity"]["amount"] is not None and got["missing"]["external_entity"] == "Shop"
    assert got["missing"]["errors"] == ["currency: missing"] and got["none"]["errors"] == ["no JSON object"]
    flags = msg.unparsed_flags(msg.parse_messages(df, accounts, "run")).collect()
    assert sorted(f["message_id"] for f in flags) == ["none", "null text"]


def test_plugin_order(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "")], "message_id string, t string")

    def number(frame):
        return frame.select("message_id", F.struct(F.col("t").try_cast("int").alias("v")).alias("r")).select(
            "message_id", F.when(F.col("r.v").isNotNull(), F.struct(F.col("r.v").cast("string").alias("v"))).alias("record"))

    def anything(frame):
        return frame.where("t <> ''").select("message_id", F.struct(F.col("t").alias("v")).alias("record"))

    got = {r["message_id"]: (r["parser"], r["record"]["v"]) for r in msg.first_parsed(df, [("n", number), ("any", anything)]).collect()}
    assert got == {"a": ("n", "1"), "b": ("any", "x")}


def test_source_plugin(spark):
    plugin.register(spark, plugin.OrderNotices)
    df = spark.read.format("order_notices").option("path", f"{SF}/orders.parquet").load()
    assert df.count() == views.table(spark, SF, "orders").count()


def landing_rows(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("message_id"), F.col("id").alias("ord"), F.lit("x").alias("v"))


def test_incremental_equals_batch(spark, tmp_path):
    """Two deliveries that overlap and hold copies, a restart, and a repeated call."""
    inbox, ledger, state = f"{tmp_path}/in", f"{tmp_path}/ledger", f"{tmp_path}/state"
    schema = landing_rows(spark, 0, 1).schema

    def run():
        stream = ingest.landed_stream(spark, inbox, schema, max_files=1)
        ingest.run_incremental(stream, lambda b: b, ledger, state)

    first = landing_rows(spark, 0, 50)
    first.unionByName(first.withColumn("ord", F.col("ord") + 1000)).coalesce(1).write.parquet(inbox)
    run()
    landing_rows(spark, 30, 80).coalesce(2).write.mode("append").parquet(inbox)
    run()
    run()
    back = sinks.read_ledger(spark, ledger, schema.add("run_id", "string"))
    batch = dedupe_batch(landing_rows(spark, 0, 80))
    assert sorted((r["message_id"], r["ord"]) for r in back.collect()) == sorted((r["message_id"], r["ord"]) for r in batch.collect())


def test_overlap_guard(spark, tmp_path):
    schema = "message_id string, ts timestamp"
    spark.range(100).select(F.concat(F.lit("m"), (F.col("id") % 60).cast("string")).alias("message_id"),
                            F.timestamp_seconds(1_700_000_000 + F.col("id") % 60).alias("ts")).repartition(4).write.parquet(f"{tmp_path}/in")
    stream = ingest.landed_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, max_files=1)
    ingest.drop_overlap(stream, "1 hour").writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(schema).parquet(f"{tmp_path}/out")
    assert out.count() == 60 and out.distinct().count() == 60


def test_overlap_guard_keeps_late_messages(spark, tmp_path):
    """A restart with old mail and copies: the old mail stays, the copies go."""
    schema = "message_id string, ts timestamp"

    def deliver(lo, hi, start):
        spark.range(lo, hi).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("message_id"),
                                   F.timestamp_seconds(F.lit(start) + F.col("id")).alias("ts")).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ingest.landed_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        ingest.drop_overlap(stream, "1 hour").writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
            "checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()

    deliver(0, 50, 1_700_000_000)
    deliver(40, 90, 1_000_000_000)
    assert sorted(r["message_id"] for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()) == sorted(f"m{i}" for i in range(90))


def test_batch_runs(spark, tmp_path):
    paths = Paths(f"{tmp_path}/ledger", f"{tmp_path}/flags", f"{tmp_path}/log")
    inbox = stage_table(views.answers(spark, SF).select("message_id", "ord", "body", "generated_text"), "test")
    accounts = views.accounts(spark, SF)
    half = inbox.where("ord < 700")
    first = batch_run(half, accounts, "r1", paths).first()
    second = batch_run(inbox, accounts, "r2", paths).first()
    again = batch_run(inbox, accounts, "r2", paths).first()
    assert first["written"] + second["written"] == inbox.where("ord % 16 <> 6").count()
    assert second.asDict() == again.asDict() and second["duplicate"] == first["written"]
    ledger = sinks.read_ledger(spark, paths.ledger, LEDGER)
    ids = sorted(r["record_id"] for r in ledger.select("record_id").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_empty_batch(spark, tmp_path):
    paths = Paths(f"{tmp_path}/ledger", f"{tmp_path}/flags", f"{tmp_path}/log")
    inbox = spark.createDataFrame([], "message_id string, ord bigint, body string, generated_text string")
    row = batch_run(inbox, src.accounts_from(spark, []), "r1", paths).first()
    assert (row["fetched"], row["written"], row["last_transaction"]) == (0, 0, None)
    assert sinks.read_ledger(spark, paths.ledger, LEDGER).count() == 0


def test_replicate_run(spark):
    messages = spark.createDataFrame([("a",), ("b",)], "message_id string")

    def parse(m, run):
        return m.select(F.lit(run).alias("run"), "message_id", F.create_map(F.lit("x"), F.lit("1"), F.lit("run_id"), F.lit(str(run))).alias("record"),
                        F.lit(10 + run).cast("bigint").alias("latency_ms"))

    matches, summary = replicate_run(messages, parse, 3)
    assert matches.where("not id_match").count() == 0 and summary.count() == 3


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_command_line(spark, tmp_path, capsys):
    """Two runs over JSON files, the second after a new delivery, then replicates and monitors."""
    from msgledger.__main__ import main

    mail = views.mail(spark, SF).select("id", "internalDate", "snippet", "payload", "labels", "ord")
    lines = mail.select(F.concat(
        F.expr("substring(to_json(struct(id, internalDate, snippet, labels, ord)), 1, length(to_json(struct(id, internalDate, snippet, labels, ord))) - 1)"),
        F.lit(',"payload":'), "payload", F.lit("}"),
    ).alias("value"), "ord")
    lines.where("ord < 100").select("value").write.text(f"{tmp_path}/in")
    answers = views.answers(spark, SF).select("message_id", "generated_text", "ord").where("ord < 200")
    answers.drop("ord").write.json(f"{tmp_path}/gen")
    views.accounts(spark, SF).select("internal_account_number", "internal_entity", "institution", "currency", "position").coalesce(1).write.csv(
        f"{tmp_path}/acc", header=True)
    common = ["--messages", f"{tmp_path}/in", "--generated", f"{tmp_path}/gen", "--accounts", f"{tmp_path}/acc", "--out", f"{tmp_path}/out"]
    main(["run", *common, "--run-id", "r1", "--query", "subject:transaction"])
    lines.where("ord BETWEEN 80 AND 150").select("value").write.mode("append").text(f"{tmp_path}/in")
    main(["run", *common, "--run-id", "r2", "--force"])
    ledger = sinks.read_ledger(spark, f"{tmp_path}/out/ledger", LEDGER)
    assert {r["run_id"]: r["count"] for r in ledger.groupBy("run_id").count().collect()} == {"r1": 100, "r2": 51}
    assert ledger.select("message_id").distinct().count() == 151
    log = {r["run_id"]: r for r in src.scan_run_log(spark, f"{tmp_path}/out/run_log").collect()}
    assert len(log) == 2 and all(len(r[c]) == 64 for r in log.values() for c in ("run_hash", "config_hash", "prompt_hash"))
    assert log["r1"]["config_hash"] == log["r2"]["config_hash"] and log["r1"]["run_hash"] != log["r2"]["run_hash"]
    answers = answers.select("message_id", "generated_text")
    both = answers.withColumn("run", F.lit(1)).unionByName(answers.where("generated_text IS NOT NULL").withColumn("run", F.lit(2)))
    both.write.json(f"{tmp_path}/runs")
    with pytest.raises(ValueError, match="once per run"):
        main(["replicates", *common, "--out", f"{tmp_path}/rep", "--runs", "2", "--force"])
    common[3] = f"{tmp_path}/runs"
    main(["replicates", *common, "--out", f"{tmp_path}/rep", "--runs", "2", "--force"])
    main(["quality", "--meta", f"{tmp_path}/out/run_meta"])
    main(["zscores", "--ledger", f"{tmp_path}/out/ledger"])
    assert "p_struct" in capsys.readouterr().out


def test_mail_without_a_pdf_is_not_walked(spark, monkeypatch):
    def part(name):
        return '{"mimeType":"m/m","parts":[{"mimeType":"a/b","filename":"%s","body":{"attachmentId":"1"}}]}' % name

    names = ["a.PDF", "b.png", "c\\u002epdf", "d\\u0050df", "e.pdf.txt", "f.\\u0050df"]
    mails = spark.createDataFrame([*((str(i), part(n)) for i, n in enumerate(names)), ("none", None), ("odd", "pdf")], "id string, payload string")
    walk = landing.tx.all_parts
    monkeypatch.setattr(landing.tx, "all_parts", lambda p: F.when(p.contains("png") | (p == "pdf"), F.raise_error(F.lit("walked"))).otherwise(walk(p)))
    got = landing.pdf_attachments(mails).collect()
    assert sorted((r["message_id"], r["filename"]) for r in got) == [("0", "a.PDF"), ("2", "c.pdf"), ("5", "f.Pdf")]
