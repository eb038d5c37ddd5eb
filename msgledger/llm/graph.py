"""Connected components of a large edge list."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from msgledger.llm.common import stage_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (hi, lo; hi > lo) that is not the smallest of its component.

    Large-star and small-star steps in turn: every edge hops to the least neighbour of its lower
    end, then every node links all its lower neighbours to the least of them, until nothing
    changes. A step moves the edge list once per join. Each round's tables are written to the
    shared folder, so both sides of a join are plain scans and a hot node's edges can be split.
    """
    edges, last = stage_table(edges.distinct(), "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == last:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        last = mark
        least = _least(edges)
        hopped = edges.join(least, edges["lo"] == least["u"], "left").select("hi", F.coalesce("m", "lo").alias("lo"))
        hopped = stage_table(hopped.distinct(), "edges-hopped")
        least = _least(hopped)
        both = hopped.join(least, hopped["hi"] == least["u"]).select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        edges = stage_table(both.where("e.hi <> e.lo").select("e.hi", "e.lo").distinct(), "edges")


def _least(edges: DataFrame) -> DataFrame:
    return stage_table(edges.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m")), "edges-least")
