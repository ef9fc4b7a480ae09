"""Pregel message passing on DataFrames.

PySpark has no GraphX API, so the superstep loop is written with joins and
aggregates. Layout for scale:

* Edges are written once as a table bucketed by ``src`` and the vertex state
  every superstep as a table bucketed by ``id`` with the same bucket count, so
  joining active sources to their out-edges moves no data; the only exchange
  of a superstep is the message aggregation by destination (with a map-side
  partial aggregate, so a destination receiving a third of all messages
  costs one row per task before the shuffle), and its output lines up with
  the state's buckets for the vertex-program join.
* A source with a huge out-degree would make its bucket a straggler, so the
  edges of such "hubs" (see ``iteration_edges``; their number is bounded) lie
  in a table of their own that is not bucketed. They get their state through a
  broadcast of at most one row per hub and are read where they lie, spread over
  all tasks.
* While a good part of the vertices get messages, each superstep writes the whole
  state. Once few do, a superstep writes only the vertices that changed; the
  state is the last whole table with those rows on top, and is written whole
  again when there are many such tables or rows.
* Each superstep's table is a reliable one in the shared checkpoint folder: the
  plan stays one step long and a lost executor costs one step.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallgrass.operators.graph import PropertyGraph, iteration_edges
from tallgrass.session import cut_lineage, cut_lineage_bucketed, holding, release, shuffle_partitions


#: The whole state is written while more than 1 / FEW of the vertices change, and after MOST_DELTAS steps at the latest.
FEW, MOST_DELTAS = 4, 8


def pregel(g: PropertyGraph, initial_msg: Column, max_iter: int | None,
           vprog: Callable[[Column, Column], Column],
           send: Callable[[Column, Column], Column],
           merge: Callable[[Column], Column] = F.sum,
           attr: str = "attr", max_hubs: int | None = None,
           hub_min_degree: int = 1, written: list[tuple[int, int]] | None = None,
           copies: str | None = None) -> tuple[DataFrame, int]:
    """GraphX ``pregel(initialMsg, maxIter, EdgeDirection.Out)(vprog, send, merge)``.

    * ``vprog(attr, msg)`` -> new attribute; run on every vertex with
      ``initial_msg`` first, then only on vertices that received a message.
    * ``send(src_attr, edge)`` -> message to the edge's destination, or NULL for
      none; ``edge`` is a struct of the edge's non-key columns and ``n_out``,
      the source's out-degree. Only vertices that received a message in the
      previous step send (direction Out).
    * ``merge`` is a built-in aggregate combining messages per destination.
    * ``max_iter`` steps at most; None runs until no vertex gets a message.
    * ``written`` gets, for each step, how many vertices got a message and how
      many rows were written.
    * ``copies`` names an edge column: how many parallel edges the row stands
      for. ``n_out`` counts them; ``send`` gives the message of them all.

    Returns the final vertices ``(id, attr)`` and the number of supersteps run.
    """
    carried = [c for c in g.edges.columns if c not in ("src", "dst")]
    edges = iteration_edges(g.edges, "pregel-edges", max_hubs, hub_min_degree, copies)
    with shuffle_partitions(g.edges.sparkSession, edges.buckets):  # exchanges line up with the buckets
        return _supersteps(g, edges, carried, initial_msg, max_iter, vprog, send, merge, attr, written)


def _supersteps(g, edges, carried, initial_msg, max_iter, vprog, send, merge, attr, written) -> tuple[DataFrame, int]:
    seen = Observation(f"pregel-{uuid.uuid4().hex[:8]}")
    first = g.vertices.select("id", vprog(F.col(attr), initial_msg).alias(attr), F.lit(True).alias("active"))
    base = cut_lineage_bucketed(first.observe(seen, F.count(F.lit(1)).alias("rows")), "id", "pregel", edges.buckets)
    total = active = seen.get["rows"]
    changed: list[DataFrame] = []  # rows that are newer than the base, oldest table first

    def messages() -> DataFrame:
        senders = changed[-1] if changed else base.where("active")
        out = edges.out_of(senders.select(F.col("id").alias("src"), F.col(attr).alias("src_attr"))).select(
            "dst", send(F.col("src_attr"), F.struct(*carried, "n_out")).alias("msg"))
        return out.where(F.col("msg").isNotNull()).groupBy(F.col("dst").alias("id")).agg(merge("msg").alias("msg"))

    # One job per superstep: the messages of a step are computed inside the
    # plan that writes its rows, and the number of vertices that got a message
    # is observed while they are written (no separate count).
    steps = 0
    while max_iter is None or steps < max_iter:
        got = F.col("msg").isNotNull()
        seen = Observation(f"pregel-{uuid.uuid4().hex[:8]}")
        whole = active * FEW > total or len(changed) == MOST_DELTAS
        state = on_top(base, changed, attr)
        if whole:
            step = (state.join(messages().hint("shuffle_hash"), "id", "left")
                    .select("id", F.when(got, vprog(F.col(attr), F.col("msg"))).otherwise(F.col(attr)).alias(attr),
                            got.alias("active")))
            step = step.observe(seen, F.sum(F.col("active").cast("long")).alias("active"))
            new = cut_lineage_bucketed(step, "id", "pregel", edges.buckets, prepartitioned=not changed)
        else:
            step = messages().join(state, "id").select("id", vprog(F.col(attr), F.col("msg")).alias(attr))
            new = cut_lineage(step.observe(seen, F.count(F.lit(1)).alias("active")), "pregel-changed")
        active = seen.get.get("active") or 0
        if not active:
            release(new)
            break  # no vertex received a message: the state did not change
        if whole:
            release(base, *changed)
            base, changed = new, []
        else:
            changed.append(new)
        if written is not None:
            written.append((active, total if whole else active))
        steps += 1
    edges.release()
    return holding(on_top(base, changed, attr), base, *changed), steps


def on_top(base: DataFrame, changed: list[DataFrame], attr: str) -> DataFrame:
    """``id`` and ``attr`` of all vertices: from the newest of the tables ``changed`` that has the vertex, else from ``base``."""
    if not changed:
        return base.select("id", attr)
    rows = reduce(DataFrame.unionByName, [c.select("id", F.struct(F.lit(k).alias("step"), F.col(attr).alias("value")).alias("new"))
                                          for k, c in enumerate(changed)])
    newest = rows.groupBy("id").agg(F.max_by("new", F.col("new.step")).alias("new")) if len(changed) > 1 else rows
    return base.select("id", attr).join(newest, "id", "left").select(
        "id", F.when(F.col("new").isNotNull(), F.col("new.value")).otherwise(F.col(attr)).alias(attr))
