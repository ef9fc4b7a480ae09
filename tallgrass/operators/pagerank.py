"""The reference's three PageRank formulations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.operators.graph import PropertyGraph, iteration_edges
from tallgrass.operators.pregel import pregel
from tallgrass.session import cut_lineage_bucketed, holding, release, settled, shuffle_partitions


def parallel_edges(edges: DataFrame) -> DataFrame:
    """One row for all edges of a source and a destination, with their number as ``copies``."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))


def pagerank_pregel(g: PropertyGraph, num_iter: int = 20, reset: float = 0.15) -> DataFrame:
    """Edge weight 1/out-degree, initial message 0 (so every rank starts
    at ``reset``), ``num_iter`` Pregel supersteps, direction Out: a vertex that
    got no message keeps its rank and does not send in the next step.
    Returns (id, rank)."""
    plain = PropertyGraph(g.vertices.select("id", F.lit(1.0).alias("attr")), parallel_edges(g.edges))
    ranks, _ = pregel(plain, F.lit(0.0), num_iter,
                      vprog=lambda attr, msg: F.lit(reset) + F.lit(1.0 - reset) * msg,
                      send=lambda src_attr, edge: src_attr * (edge["copies"] / edge["n_out"]), copies="copies")
    return holding(ranks.select("id", F.col("attr").alias("rank")), ranks)


def pagerank_tolerance(g: PropertyGraph, tol: float = 1e-4, reset: float = 0.15) -> DataFrame:
    """G13 ``graph.pageRank(tol)``: delta propagation until no vertex changes
    by more than ``tol``; each vertex adds ``(1-reset) * incoming delta``. The
    deltas shrink by ``1-reset`` a step at least, so the loop ends by itself
    and has no cap. Ranks are then rescaled to sum to the vertex count (current
    GraphX does this so sinks do not leak rank). Returns (id, rank)."""
    if not (tol > 0 and 0 < reset <= 1):
        raise ValueError("needs tol > 0 and 0 < reset <= 1 to converge")
    plain = PropertyGraph(
        g.vertices.select("id", F.struct(F.lit(0.0).alias("pr"), F.lit(0.0).alias("delta")).alias("attr")),
        parallel_edges(g.edges))

    def vprog(attr, msg):
        gain = F.lit(1.0 - reset) * msg
        return F.struct((attr["pr"] + gain).alias("pr"), gain.alias("delta"))

    def send(src_attr, edge):
        return F.when(src_attr["delta"] > F.lit(tol), src_attr["delta"] * (edge["copies"] / edge["n_out"]))

    state, _ = pregel(plain, F.lit(reset / (1.0 - reset)), None, vprog, send, copies="copies")
    ranks = state.select("id", F.col("attr.pr").alias("pr"))
    whole = ranks.agg(F.sum("pr"), F.count(F.lit(1))).first()
    out = ranks.select("id", (F.col("pr") * whole[1] / F.lit(whole[0])).alias("rank"))
    return settled(out, state, name="ranks")  # one table instead of the last whole one and the changes since


def pagerank_rounds(edges: DataFrame, num_iter: int = 20, reset: float = 0.15,
                    materialize_every: int = 4, max_hubs: int | None = None) -> DataFrame:
    """G15 the plain-rounds loop: distinct edges, every source starts at 1.0,
    each round a vertex gets ``reset + (1-reset) * sum(rank/outdeg)`` over its
    in-links. Only vertices that received something survive a round and a
    vertex without out-edges forwards nothing, exactly like the RDD loop
    (join, flatMap, reduceByKey). Returns (id, rank).

    Each round reads the previous ranks once for the regular links and once
    for the few hubs, so a few rounds can share one job; the ranks are written
    to the checkpoint folder every ``materialize_every`` rounds (and after the
    last). The links are written once bucketed by source, hub links apart and
    not bucketed, and the ranks come out of the per-destination sum
    hash-partitioned the same way, so no round moves the links."""
    links = iteration_edges(edges.select("src", "dst").dropDuplicates(), "rounds-links", max_hubs)
    sources = links.regular.select("src").union(links.hub_ids).distinct()
    ranks = cut_lineage_bucketed(sources.select(F.col("src").alias("id"), F.lit(1.0).alias("rank")), "id",
                                 "rounds", links.buckets)
    stored = ranks
    with shuffle_partitions(edges.sparkSession, links.buckets):
        for i in range(1, num_iter + 1):
            contribs = (links.out_of(ranks.withColumnRenamed("id", "src"))
                        .select("dst", (F.col("rank") / F.col("n_out")).alias("share")))
            ranks = (contribs.groupBy(F.col("dst").alias("id"))
                     .agg((F.lit(reset) + F.lit(1.0 - reset) * F.sum("share")).alias("rank")))
            if i % materialize_every == 0 or i == num_iter:
                ranks = cut_lineage_bucketed(ranks, "id", "rounds", links.buckets, prepartitioned=True)
                release(stored)
                stored = ranks
    links.release()
    return ranks


def top_ranks(ranks: DataFrame, n: int = 10) -> DataFrame:
    """T5 ``sortBy(rank, false).take(n)`` (ties by id)."""
    return ranks.orderBy(F.col("rank").desc(), F.col("id").asc()).limit(n)
