"""Every registered query against its SQL, and the shape of the plans."""
import glob
import os
import sys

import duckdb
import pytest

from conftest import SF
from pyspark.sql import functions as F

from msgledger.operators.joins import _splits, hottest, lookup
from msgledger.operators.ledger import fill_balances
from msgledger.operators.messages import parse_messages
from msgledger.options import Limits
from msgledger.plans import views
from msgledger.plans.oracles import ORACLES
from msgledger.plans.queries import QUERIES
from msgledger.session import stage_table
from msgledger.sources.landing import message_filter

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracles import normal  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, res.fetchall())


def test_parsing_does_not_shuffle_the_messages(spark):
    """With the inbox as a table, the only exchanges are those of the account look-ups."""
    rows = views.answers(spark, SF).select("message_id", "ord", "body", "generated_text")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/plan-test-inbox"
    rows.write.mode("overwrite").parquet(path)
    plan = plan_of(parse_messages(spark.read.parquet(path), views.accounts(spark, SF), "r"))
    assert "SortMergeJoin" not in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "suffix" in line or "ending" in line or "internal_entity" in line or "institution" in line


def test_balances_take_one_shuffle_and_read_three_columns_of_the_table(spark):
    plan = plan_of(fill_balances(views.ledger(spark, SF)).select("message_id", "available_balance"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "o_orderpriority" not in plan


def test_copies_are_merged_before_the_shuffle(spark):
    plan = plan_of(QUERIES["batch_dedupe"](spark, SF))
    assert "partial_min_by" in plan and plan.index("partial_min_by") > plan.index("Exchange hashpartitioning")


def test_message_filter_reaches_the_scan(spark):
    rows = views.notices(spark, SF).selectExpr("ord", "day AS sent_date", "status AS subject", "text AS body")
    cond = message_filter(since="1997/01/01")
    plan = plan_of(stage_table(rows, "plan").where(cond).select("ord"))
    assert "GreaterThanOrEqual(sent_date,1997-01-01)" in plan and "ReadSchema: struct<ord:bigint,sent_date:date>" in plan


def test_big_dimension_is_one_shuffled_join(spark):
    """Hot and null keys cost no second pass over the facts, however many look-ups are chained."""
    facts = spark.range(900).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS k")
    dim = spark.range(500).selectExpr("id AS k", "id * 2 AS v")
    limits = Limits(broadcast_rows=10, hot_key_rows=50)
    once = lookup(facts, dim, ["k"], "left", limits)
    twice = lookup(once.withColumn("k2", F.col("k")), dim.selectExpr("k AS k2", "v AS v2"), ["k2"], "left", limits)
    assert twice.where("v <=> v2").count() == 900 and twice.where("v IS NULL").count() == 300 + 134
    assert plan_of(twice).count("Range (0, 900") == 1
    # 300 rows each of key 7 and of null, 50 rows per salt and one to spare.
    splits = _splits(facts, hottest(facts, ["k"], limits), ["k"], limits)
    assert {r["_hot_k"]: r["_splits"] for r in splits.collect()} == {7: 7, None: 7}
    assert "_salt" in plan_of(once)
