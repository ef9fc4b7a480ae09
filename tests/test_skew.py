"""Hot keys: joins, ranks, star rounds and deltas keep every task small and lose no row."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import graph as G
from tallgrass.operators.pregel import pregel
from tallgrass.operators.skew import hot_keys, join_unique, ranked
from tallgrass.session import cut_lineage, release


def task_sizes(df):
    """Rows of each task that makes ``df``."""
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as between large tables; no coalescing that hides where rows went."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_unique_cuts_hot_keys(shuffled, how):
    spark = shuffled
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    rows = cut_lineage(spark.range(30_000).select(key.alias("k"), "id", F.lit(1).alias("_piece")), "rows")
    lookup = rows.where("k IS NOT NULL AND id < 20000").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = join_unique(rows, lookup, "k", how)
    assert out.columns == ["k", "id", "_piece", "n"]
    want = rows.join(lookup, "k", how).select(*out.columns)
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    assert task_sizes(out)[-1] < 7000
    if how == "inner":
        assert task_sizes(want)[-1] >= 10_000
    release(rows)


def test_hot_list_is_bounded(spark):
    counts = spark.range(5000).select(F.col("id").alias("k"), F.lit(100).cast("long").alias("n"))
    assert hot_keys(counts, "k", "n") == []
    counts = counts.union(spark.range(2).select((F.col("id") + 10_000).alias("k"), F.lit(400_000).cast("long").alias("n")))
    assert sorted(k for k, _ in hot_keys(counts, "k", "n")) == [10_000, 10_001]
    assert hot_keys(counts.limit(0), "k", "n") == []


def test_ranked(shuffled):
    spark = shuffled
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.choice([None, *range(50)]), rnd.randint(1, 4)) for _ in range(3000)]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "k string, v int, n long, part int")
    got = ranked(df, "k", [F.col("v").asc_nulls_first(), F.col("part")], "n", "rank", "size")
    assert got.columns == [*df.columns, "rank", "size"]
    want, total = {}, {}
    for k, v, n, at in sorted(((k, v, n, at) for at, (k, v, n) in enumerate(rows)),
                              key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[3])):
        want[at] = total.get(k, 0)
        total[k] = total.get(k, 0) + n
    assert {r.part: (r["rank"], r["size"]) for r in got.collect()} == {at: (want[at], total[k]) for at, (k, _, _) in enumerate(rows)}
    release(got)


def test_star_rounds_with_a_hub(shuffled):
    """One node has a third of all edges; no task of a half round gets them."""
    spark = shuffled
    rnd = random.Random(4)
    edges = [(5, 1000 + k) for k in range(6000)] + [(rnd.randrange(20_000, 32_000), rnd.randrange(20_000, 32_000)) for _ in range(12_000)]
    pairs = cut_lineage(spark.createDataFrame(edges, "u long, v long"), "pairs")
    out = G.with_minimum(pairs)
    assert out.count() == 18_000 and out.where("u = 5 AND m <> 1000").count() == 0
    assert task_sizes(pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u"))[-1] > 6000
    assert task_sizes(out)[-1] < 6000
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = G.star_components(pairs, "u", "v")
    assert {r.node: r.component for r in found.collect()} == {x: find(x) for x in {e for p in edges for e in p if p[0] != p[1]}}
    release(found, pairs)


def test_edge_weights_with_a_hub(shuffled):
    spark = shuffled
    edges = cut_lineage(spark.range(18_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("src"),
                                                   F.col("id").alias("dst"), F.lit("x").alias("n"), F.lit(0).alias("weight")), "edges")
    g = G.PropertyGraph(G.edge_vertices(edges), edges)
    out = G.edge_weights(g)
    assert out.columns == ["src", "dst", "n", "weight"]
    assert task_sizes(out)[-1] < 6000
    hub = out.where("src = 7").agg(F.count(F.lit(1)), F.min("weight"), F.max("weight")).first()
    assert hub[0] == 6001 and hub[1] == hub[2] == 1 / 6001 and out.count() == 18_000
    release(edges)


def test_triangles_with_a_hub(spark):
    rnd = random.Random(6)
    pairs = {(0, k) for k in range(1, 300)} | {tuple(sorted(rnd.sample(range(1, 300), 2))) for _ in range(900)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {v: sum(len(near[v] & near[w]) for w in near[v]) // 2 for v in near}
    rows = [*pairs, *[(b, a) for a, b in list(pairs)[:100]], (5, 5)]
    out = G.triangle_count(spark.createDataFrame(rows, "src long, dst long"))
    assert {r.id: r.triangles for r in out.collect()} == want
    release(out)


def test_pregel_writes_what_changed(spark):
    """A wave down a path: one vertex a step changes, so one row a step is written, but for whole tables now and then."""
    n = 30
    vertices = spark.range(n).select("id", F.when(F.col("id") == 0, 0).otherwise(10_000).cast("long").alias("attr"))
    edges = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    written = []
    out, steps = pregel(G.PropertyGraph(vertices, edges), F.lit(10_000).cast("long"), None,
                        vprog=lambda attr, msg: F.least(attr, msg),
                        send=lambda attr, edge: F.when(attr < 10_000, attr + 1), merge=F.min, written=written)
    assert {r.id: r.attr for r in out.collect()} == {k: k for k in range(n)}
    assert steps == n - 1 == len(written) and all(active == 1 for active, _ in written)
    small = [rows for _, rows in written if rows < n]
    assert set(small) == {1} and len(small) >= 24
    release(out)
