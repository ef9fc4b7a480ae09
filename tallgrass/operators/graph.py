"""Property-graph operators on a pair of DataFrames.

A graph is ``vertices(id bigint, ...attributes)`` and ``edges(src bigint,
dst bigint, ...attributes)``: a directed multigraph, as in the reference.
Every operator is a join or an aggregate Catalyst plans; degree counts are
partial aggregates, so a hub vertex with a third of all edges costs one row
per task before the shuffle; joins of edges back to such an aggregate cut the
hubs up themselves (``skew.join_unique``, ``with_minimum``), the others are
plain joins that AQE splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallgrass.operators.skew import LEAST_PIECE, SHARES, fresh, join_unique
from tallgrass.session import cut_lineage, cut_lineage_bucketed, holding, num_buckets, release, settled


@dataclass(frozen=True)
class PropertyGraph:
    """G1 ``Graph(vertices, edges)``."""
    vertices: DataFrame
    edges: DataFrame

    def vertex_attrs(self) -> list[str]:
        return [c for c in self.vertices.columns if c != "id"]

    def edge_attrs(self) -> list[str]:
        return [c for c in self.edges.columns if c not in ("src", "dst")]


# --------------------------------------------------------------- sources
def parse_edge_list(lines: DataFrame, col: str = "value", skip_comments: bool = True) -> DataFrame:
    """S8 ``GraphLoader.edgeListFile``: ``src dst`` per line, ``#`` and blank
    lines skipped, ids as bigint. Vertices are the distinct endpoints (``edge_vertices``)."""
    src = lines.where(F.col(col).rlike(r"\S"))
    src = src.where(~F.col(col).startswith("#")) if skip_comments else src
    parts = F.split(F.trim(F.col(col)), r"\s+")
    return src.select(F.get(parts, 0).cast("bigint").alias("src"), F.get(parts, 1).cast("bigint").alias("dst"))


def parse_edge_pairs(lines: DataFrame, col: str = "value") -> DataFrame:
    """S9 ``split("\\s+") -> (p0, p1) -> distinct()``: string ids, no comment
    skipping (a comment line becomes an edge, as in the reference)."""
    parts = F.split(F.col(col), r"\s+")
    return lines.select(F.get(parts, 0).alias("src"), F.get(parts, 1).alias("dst")).dropDuplicates()


def edge_vertices(edges: DataFrame) -> DataFrame:
    """Distinct endpoints of an edge set as a vertex table."""
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


# -------------------------------------------------------------- views
def triplets(g: PropertyGraph) -> DataFrame:
    """J6/G2 ``graph.triplets``: every edge with its source and destination
    attributes (two joins; Catalyst decides broadcast vs. sort-merge from the
    vertex table's size estimate)."""
    s = g.vertices.select(F.col("id").alias("src"), *[F.col(c).alias(f"src_{c}") for c in g.vertex_attrs()])
    d = g.vertices.select(F.col("id").alias("dst"), *[F.col(c).alias(f"dst_{c}") for c in g.vertex_attrs()])
    return g.edges.join(s, "src").join(d, "dst")


def in_degrees(g: PropertyGraph) -> DataFrame:
    """G5 ``inDegrees``: (id, inDeg); vertices without in-edges are absent;
    parallel edges count."""
    return g.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).cast("int").alias("inDeg"))


def out_degrees(g: PropertyGraph) -> DataFrame:
    """G5 ``outDegrees``: (id, outDeg)."""
    return g.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).cast("int").alias("outDeg"))


def subgraph(g: PropertyGraph, vpred: Column, epred: Column | None = None) -> PropertyGraph:
    """G6 ``subgraph(vpred, epred)``: vertices passing ``vpred``; edges passing
    ``epred`` whose both ends survive (two semi-joins, no columns added)."""
    v = g.vertices.where(vpred)
    ids = v.select("id")
    e = g.edges if epred is None else g.edges.where(epred)
    e = (e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
          .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    return PropertyGraph(v, e.select(*g.edges.columns))


def outer_join_vertices(g: PropertyGraph, other: DataFrame, default=None) -> DataFrame:
    """J5 ``outerJoinVertices(other){ getOrElse(default) }``: every vertex keeps
    its row; ``other``'s columns are NULL (or ``default``) where it has no row."""
    joined = g.vertices.join(other, "id", "left")
    if default is None:
        return joined
    return joined.select(*g.vertices.columns,
                         *[F.coalesce(F.col(c), F.lit(default)).alias(c) for c in other.columns if c != "id"])


def join_vertices(g: PropertyGraph, other: DataFrame, attr: str, fn: Callable[[Column, Column], Column]) -> DataFrame:
    """G19 ``joinVertices``: where ``other`` has a value the attribute becomes
    ``fn(old, new)``, elsewhere the old attribute stays."""
    (new,) = fresh(g.vertices, "new")
    joined = g.vertices.join(other.select("id", F.col(attr).alias(new)), "id", "left")
    return joined.select(*[F.when(F.col(new).isNotNull(), fn(F.col(attr), F.col(new))).otherwise(F.col(attr))
                           .alias(attr) if c == attr else F.col(c) for c in g.vertices.columns])


def degrees(g: PropertyGraph) -> DataFrame:
    """(id, inDeg, outDeg) for every vertex with an edge, in one pass over the
    edges: each edge counts once for its source and once for its destination."""
    ends = F.array(F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                   F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    return (g.edges.select(F.explode(ends).alias("e"))
            .groupBy(F.col("e.id").alias("id"))
            .agg(F.sum("e.i").cast("int").alias("inDeg"), F.sum("e.o").cast("int").alias("outDeg")))


def with_degrees(g: PropertyGraph) -> DataFrame:
    """Vertices with in- and out-degree, 0 where absent (the reference's
    two ``outerJoinVertices``, as one degree pass and one left join)."""
    return outer_join_vertices(g, degrees(g), 0)


def edge_weights(g: PropertyGraph) -> DataFrame:
    """G11 ``mapTriplets(e => 1.0 / outDeg(src))``; an old ``weight`` is replaced.
    The degrees tell the hubs, whose edges are joined in pieces; ``edges``
    should be a scan or a written table."""
    (n,) = fresh(g.edges, "n")
    degree = out_degrees(g).withColumnRenamed("id", "src").withColumnRenamed("outDeg", n)
    return join_unique(g.edges, degree, "src").withColumn("weight", F.lit(1.0) / F.col(n)).drop(n)


def aggregate_messages(g: PropertyGraph, to_dst: Column | None, to_src: Column | None,
                       merge: Callable[[Column], Column] = F.sum, name: str = "msg") -> DataFrame:
    """G18 ``aggregateMessages``: each edge may send a message to its
    destination and/or its source (expressions over ``src_*``/``dst_*``/edge
    columns of the triplet); messages are merged per receiving vertex with a
    built-in aggregate (partial + final, so hubs stay cheap)."""
    t = triplets(g)
    parts = []
    if to_dst is not None:
        parts.append(t.select(F.col("dst").alias("id"), to_dst.alias(name)))
    if to_src is not None:
        parts.append(t.select(F.col("src").alias("id"), to_src.alias(name)))
    msgs = parts[0]
    for p in parts[1:]:
        msgs = msgs.unionByName(p)
    return msgs.groupBy("id").agg(merge(F.col(name)).alias(name))


def map_vertices(g: PropertyGraph, **attrs: Column) -> PropertyGraph:
    """G9 ``mapVertices``: every vertex keeps its id and gets the given
    attributes (expressions over ``id`` and the old ones) in place of its own."""
    return PropertyGraph(g.vertices.select("id", *[e.alias(n) for n, e in attrs.items()]), g.edges)


def map_edges(g: PropertyGraph, **attrs: Column) -> PropertyGraph:
    """G9 ``mapEdges``: the same for edges, over ``src``, ``dst`` and edge attributes."""
    return PropertyGraph(g.vertices, g.edges.select("src", "dst", *[e.alias(n) for n, e in attrs.items()]))


def map_triplets(g: PropertyGraph, **attrs: Column) -> PropertyGraph:
    """G9/G11 ``mapTriplets``: edge attributes from expressions that may also
    use the two ends' attributes (``src_*``, ``dst_*``)."""
    return PropertyGraph(g.vertices, triplets(g).select("src", "dst", *[e.alias(n) for n, e in attrs.items()]))


# ----------------------------------------------------------- hub splitting
#: Edges of a bucket, before there are more buckets than cores.
BUCKET_EDGES = 500_000


@dataclass(frozen=True)
class IterationEdges:
    """An iteration's static edge tables, out-degree column ``n_out`` included:
    ``regular`` bucketed by source, ``hubs`` as the edges lie (not bucketed, so
    no task has all edges of a hub), ``hub_ids`` a bounded list of sources."""
    regular: DataFrame
    hubs: DataFrame
    hub_ids: DataFrame
    n_hubs: int
    buckets: int

    def out_of(self, sources: DataFrame) -> DataFrame:
        """Edges joined to rows of ``sources`` (one per ``src``, bucketed the
        same way): regular edges do not move and are not sorted again, hub edges
        meet a broadcast of at most as many rows as there are hubs."""
        regular = self.regular.join(sources.hint("shuffle_hash"), "src")
        if not self.n_hubs:
            return regular
        few = F.broadcast(sources.join(F.broadcast(self.hub_ids), "src", "left_semi"))
        return regular.unionByName(self.hubs.join(few, "src"))

    def release(self) -> None:
        release(self.regular, self.hubs, self.hub_ids)


def iteration_edges(edges: DataFrame, name: str, max_hubs: int | None = None, hub_min_degree: int = 1,
                    copies: str | None = None) -> IterationEdges:
    """Prepare an iteration's edges from one evaluation of ``edges``. A row may
    stand for as many parallel edges as its column ``copies`` says, which
    ``n_out`` counts.

    The edges are written once as they come; out-degrees, the hub list and both
    edge tables are made from that copy. A hub has more than ``E / max_hubs``
    edges (and ``hub_min_degree``), so there are at most ``max_hubs`` of them:
    a proven bound for the broadcasts. The default of four times the bucket
    count makes every source a hub that would fill a quarter of a mean bucket.
    There are as many buckets as cores, more if one would get over BUCKET_EDGES
    edges, and the session's shuffle partitions at most: every step pays for
    every bucket, however few edges lie in it.
    """
    spark = edges.sparkSession
    flat = cut_lineage(edges, f"{name}-flat")
    n_out = F.count(F.lit(1)) if copies is None else F.sum(copies)
    degree = cut_lineage(flat.groupBy("src").agg(n_out.alias("n_out"), F.count(F.lit(1)).alias("n_rows")), f"{name}-degree")
    total = degree.select(F.sum("n_rows")).first()[0] or 0
    buckets = min(num_buckets(spark), max(spark.sparkContext.defaultParallelism, -(-total // BUCKET_EDGES)))
    threshold = max(hub_min_degree, -(-total // (max_hubs or 4 * buckets)))
    hub_degree = F.broadcast(degree.where(F.col("n_rows") > threshold).drop("n_rows"))
    hubs = cut_lineage(flat.join(hub_degree, "src"), f"{name}-hub-edges")
    hub_ids = cut_lineage(degree.where(F.col("n_rows") > threshold).select("src"), f"{name}-hubs")
    rest = flat.join(F.broadcast(hub_ids), "src", "left_anti").join(degree.drop("n_rows"), "src")
    regular = cut_lineage_bucketed(rest, "src", name, buckets)
    release(flat, degree)
    return IterationEdges(regular, hubs, hub_ids, hub_ids.count(), buckets)


# ----------------------------------------------------- connected components
def with_minimum(pairs: DataFrame, u: str = "u", v: str = "v", out: str = "m") -> DataFrame:
    """``pairs`` (a scan or written table) with the smallest ``v`` of each row's ``u``.

    The minima of hubs -- a ``u`` with more than ``1 / (SHARES * partitions)`` of
    all rows, so there are at most that many -- come to the driver and are
    broadcast: a hub's rows stay where they lie. The others are joined to the
    minima, where no ``u`` has a large share. The minima are a written table,
    made in one pass that counts the rows too; ``release`` deletes it."""
    spark = pairs.sparkSession
    seen = Observation(f"minima-{uuid.uuid4().hex[:8]}")
    counted = pairs.groupBy(u).agg(F.min(v).alias(out), F.count(F.lit(1)).alias("n"))
    table = cut_lineage(counted.observe(seen, F.sum("n").alias("total"), F.max("n").alias("most")), "minima")
    total, most = (seen.get.get(k) or 0 for k in ("total", "most"))
    limit = max(LEAST_PIECE, -(-total // (SHARES * num_buckets(spark))))
    low = table.select(u, out)
    hubs = table.where(F.col("n") > limit).select(u, out).collect() if most > limit else []
    if not hubs:
        return holding(pairs.join(low.hint("shuffle_hash"), u), table)
    few = F.broadcast(spark.createDataFrame(hubs, low.schema))
    rest = pairs.join(few, u, "left_anti").join(low.hint("shuffle_hash"), u)
    return holding(rest.unionByName(pairs.join(few, u)), table)


def star_components(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """``node`` and ``component`` (the smallest node that it reaches) for every
    node of an undirected edge set; loops, repeats and null ends do no harm.

    Alternating large-star and small-star rounds: every node's larger
    neighbours move to its smallest one, then its smaller neighbours join the
    smallest. The edges shrink to one star per component in O(log^2 n) rounds,
    which is the method's proven bound, so there is no cap. Each half round is
    one written table, and reaches its hubs by a bounded broadcast
    (``with_minimum``), so neither a hub nor a giant component fills a task. It
    ends when a round changes no edge, which is seen as the edges are written.
    """
    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        low = with_minimum(both.select("e.u", "e.v"))
        near = low.select("u", "v", F.least("m", "u").alias("m"))
        return holding(near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), low)

    def small(e: DataFrame) -> DataFrame:
        near = with_minimum(e)
        pair = F.when(F.col("v") > F.col("m"), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))).otherwise(F.struct("u", "v"))
        return holding(near.select(pair.alias("e")).select("e.u", "e.v"), near)

    def round_end(e: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
        seen = Observation(f"cc-{uuid.uuid4().hex[:8]}")
        out = cut_lineage(e.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")), "cc")
        return out, tuple(seen.get.get(k) or 0 for k in ("n", "sum"))

    current, now = round_end(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    before = None
    while now[0] and now != before:
        before, moved = now, large(current)
        half = cut_lineage(moved, "cc-half")
        release(current, moved)
        joined = small(half)
        current, now = round_end(joined)
        release(half, joined)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return holding(stars.union(current.select("v", "v").distinct()), current)


def connected_components(g: PropertyGraph) -> DataFrame:
    """G7 ``connectedComponents``: (id, component) with the lowest vertex id of
    the component, edge direction ignored; a vertex without edges is its own."""
    found = star_components(g.edges)
    out = (g.vertices.select("id").join(found.withColumnRenamed("node", "id"), "id", "left")
           .select("id", F.coalesce("component", "id").alias("component")))
    return holding(out, found)


# --------------------------------------------------------------- triangles
def triangle_count(edges: DataFrame) -> DataFrame:
    """G17 per-vertex triangle counts of the undirected simple graph.

    Edges are made canonical (no loops, no duplicates) and oriented from the
    lower-degree end to the higher-degree end (ties by id). A vertex has at most
    sqrt(2m) oriented out-edges, so its out-neighbours are one short array, hubs
    included. Each edge takes the neighbours of its lower end that come after
    its upper end, meets the neighbours of the upper end, and the intersection
    closes its triangles: every triangle is found once, and what is shuffled is
    one row an edge, not one a wedge. An upper end of very many edges is joined
    in pieces, and no join sends a table through the driver. Output: (id, triangles) for every vertex of the graph, 0 included.
    """
    und = cut_lineage(edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
                      .where(F.col("a") != F.col("b")).distinct(), "tri")
    deg = cut_lineage(und.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("deg")),
                      "tri-deg")
    ends = join_unique(join_unique(und, deg.toDF("a", "da"), "a", shuffled=True), deg.toDF("b", "db"), "b", shuffled=True)
    lo, hi = F.struct(F.col("da").alias("d"), F.col("a").alias("id")), F.struct(F.col("db").alias("d"), F.col("b").alias("id"))
    oriented = ends.select(F.least(lo, hi).alias("u"), F.greatest(lo, hi).alias("v"))
    after = F.transform(F.array_sort(F.collect_list("v")), lambda x: x["id"])
    out = cut_lineage(oriented.groupBy(F.col("u.id").alias("u")).agg(after.alias("near")), "tri-near")
    edge = (out.select("u", "near", F.posexplode("near").alias("at", "v"))
            .select("u", "v", F.slice("near", F.col("at") + 2, F.size("near")).alias("later")).where(F.size("later") > 0))
    closed = (join_unique(edge, out.select(F.col("u").alias("v"), "near"), "v", shuffled=True)
              .select("u", "v", F.array_intersect("later", "near").alias("w")).where(F.size("w") > 0))
    n = F.size("w").cast("long")
    found = F.concat(F.array(F.struct(F.col("u").alias("id"), n.alias("n")), F.struct(F.col("v").alias("id"), n.alias("n"))),
                     F.transform("w", lambda w: F.struct(w.alias("id"), F.lit(1).cast("long").alias("n"))))
    per_vertex = closed.select(F.inline(found)).groupBy("id").agg(F.sum("n").alias("triangles"))
    result = (deg.select("id").join(per_vertex.hint("merge"), "id", "left")
              .select("id", F.coalesce(F.col("triangles"), F.lit(0)).alias("triangles")))
    return settled(result, und, deg, out, name="triangles")
