"""Physical-plan properties the design relies on (read from ``explain``)."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from tallgrass.operators.graph import iteration_edges
from tallgrass.operators.topk import top_k_distinct
from tallgrass.plans.registry import load_all
from tallgrass.session import cut_lineage_bucketed, release

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_filter_and_projection_reach_the_scan(spark):
    p = plan(load_all()["kv_lookup"].fn(spark, SF))
    assert "EqualTo(o_orderpriority,1-URGENT)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in p


def test_word_count_is_partial_aggregate_without_python(spark):
    p = plan(load_all()["wordcount_ws"].fn(spark, SF))
    assert "partial_count" in p
    assert "EvalPython" not in p and "ArrowEvalPython" not in p


def test_access_log_parse_stays_in_the_jvm_and_prunes(spark):
    p = plan(load_all()["clf_parse"].fn(spark, SF))
    assert "EvalPython" not in p
    assert "props" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_gold_access_broadcasts_only_the_top_ten(spark):
    p = plan(load_all()["gold_access"].fn(spark, SF))
    assert "TakeOrderedAndProject" in p and "BroadcastHashJoin" in p
    assert p.split("\n\n")[0].count("BroadcastExchange") == 1


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


def test_gold_access_scans_the_log_once(spark):
    p = final_plan(load_all()["gold_access"].fn(spark, SF))
    assert p.count("FileScan parquet") == 1 and "ReusedExchange" in p


def test_code_share_total_reuses_the_count_shuffle(spark):
    p = final_plan(load_all()["code_percentage"].fn(spark, SF))
    assert "ReusedExchange" in p


def test_code_share_uses_a_scalar_subquery_not_a_cross_join(spark):
    p = plan(load_all()["code_percentage"].fn(spark, SF))
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_superstep_moves_no_edges(spark):
    """The edge tables that the iterations use, joined to bucketed state: the
    only exchange is the message aggregation by destination."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = spark.read.parquet(f"{SF}/lineitem.parquet")
        edges = iteration_edges(li.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")), "plan-edges")
        state = cut_lineage_bucketed(li.select(F.col("l_partkey").alias("id")).distinct()
                                     .select("id", F.lit(1.0).alias("attr")), "id", "plan-state", edges.buckets)
        msgs = (edges.out_of(state.withColumnRenamed("id", "src"))
                .groupBy(F.col("dst").alias("id")).agg(F.sum("attr").alias("msg")))
        p = plan(state.join(msgs, "id", "left"))
        assert edges.n_hubs == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    edges.release()
    release(state)
    tree = p.split("\n\n")[0]
    assert len(re.findall(r"[-+] Exchange \(", tree)) == 1, tree


def test_distinct_top_ten_is_a_hash_aggregate(spark):
    p = plan(load_all()["top_distinct"].fn(spark, SF))
    assert "SortAggregate" not in p and "TakeOrderedAndProject" in p


def test_distinct_top_ten_reads_its_input_once(spark):
    """One scan, no join, and what is shuffled comes out of the prune in each task."""
    df = spark.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_nationkey").alias("key"), F.col("c_custkey").alias("Id"), F.col("c_name").alias("record"))
    p = plan(top_k_distinct(df, "key", 10))
    tree = p.split("\n\n")[0]
    assert len(re.findall(r"Scan parquet", tree)) == 1 and "Join" not in tree
    assert tree.index("Exchange") < tree.rindex("MapInArrow")  # printed from the result down to the scan


@pytest.mark.parametrize("name", ["cogroup", "kv_group_list"])
def test_paged_lists_write_the_sorted_pairs_only(spark, name):
    """The result reads one written table and is not written itself."""
    from tallgrass.operators import keyed as K
    pairs = spark.createDataFrame([(1, 2), (1, None), (2, 5), (None, 7)], "key bigint, value bigint")
    out = K.cogroup(pairs, pairs.select("key", F.col("value").cast("string").alias("value"))) if name == "cogroup" else K.group_values(pairs)
    assert len(out._scratch) == 1
    p = plan(out).split("\n\n")[0]
    assert "Scan parquet" in p and "Scan ExistingRDD" not in p and "LocalTableScan" not in p
    rows = {r.key: tuple(r)[2:] for r in out.collect()}
    assert rows[1][0] == [2, None] and rows[None][0] == [7] and (name != "cogroup" or rows[1][1] == ["2", None])
    release(out)


def test_iterations_read_the_table_once_before_the_first_step(spark):
    """Everything is made from one written copy of the edges."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    edges = iteration_edges(li, "once")
    for t in (edges.regular, edges.hubs, edges.hub_ids):
        assert "lineitem" not in plan(t)
    edges.release()
