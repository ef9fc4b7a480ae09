"""Graph queries (S8, S9, G1-G11, G17-G19, J4-J6) on the part/supplier graph
derived from ``lineitem`` (``tallgrass.sources.derived``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import graph as G
from tallgrass.plans.registry import query
from tallgrass.sources.derived import edge_list_lines, part_supplier_edges, part_supplier_vertices
from tallgrass.sources.tables import table

COMMENT_LINE = "# part -> supplier edges, supplier -> part for returned first lines"

GRAPH_SQL = """
WITH v AS (
  SELECT 2 * p_partkey AS id, p_name AS name, p_size AS age FROM part
  UNION ALL SELECT 2 * s_suppkey + 1, s_name, s_nationkey + 25 FROM supplier),
e AS (
  SELECT 2 * l_partkey AS src, 2 * l_suppkey + 1 AS dst, CAST(l_quantity AS INTEGER) AS weight FROM lineitem
  UNION ALL
  SELECT 2 * l_suppkey + 1, 2 * l_partkey, CAST(l_quantity AS INTEGER) FROM lineitem
  WHERE l_linenumber = 1 AND l_returnflag = 'R')
"""

SUB_SQL = GRAPH_SQL + """
, sv AS (SELECT * FROM v WHERE age > 45),
se AS (SELECT * FROM e WHERE src IN (SELECT id FROM sv) AND dst IN (SELECT id FROM sv))
"""


def graph(spark, sf_dir) -> G.PropertyGraph:
    return G.PropertyGraph(part_supplier_vertices(table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")),
                           part_supplier_edges(table(spark, sf_dir, "lineitem")))


def edge_file(spark, sf_dir):
    """The edge list as a text file would hold it: a comment, then src/dst lines."""
    header = spark.createDataFrame([(COMMENT_LINE,)], "value string")
    return header.unionByName(edge_list_lines(graph(spark, sf_dir).edges))


@query("edge_list", oracle=GRAPH_SQL + "SELECT src, dst FROM e")
def edge_list(spark, sf_dir):
    return G.parse_edge_list(edge_file(spark, sf_dir))


@query("edge_distinct", oracle=GRAPH_SQL + """
    SELECT DISTINCT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM e
    UNION SELECT '#', 'part'""")
def edge_distinct(spark, sf_dir):
    return G.parse_edge_pairs(edge_file(spark, sf_dir))


@query("triplets", oracle=GRAPH_SQL + """
    SELECT e.src, e.dst, s.name || ' sends ' || e.weight || ' units to ' || d.name AS line
    FROM e JOIN v s ON e.src = s.id JOIN v d ON e.dst = d.id""")
def triplets(spark, sf_dir):
    t = G.triplets(graph(spark, sf_dir))
    return t.select("src", "dst", F.concat_ws("", "src_name", F.lit(" sends "), F.col("weight").cast("string"),
                                             F.lit(" units to "), "dst_name").alias("line"))


@query("vertex_filter", oracle=GRAPH_SQL + "SELECT id, name, age FROM v WHERE age > 30")
def vertex_filter(spark, sf_dir):
    return graph(spark, sf_dir).vertices.where(F.col("age") > 30)


@query("edge_filter", oracle=GRAPH_SQL + "SELECT src, dst FROM e WHERE weight > 45")
def edge_filter(spark, sf_dir):
    return graph(spark, sf_dir).edges.where(F.col("weight") > 45).select("src", "dst")


@query("in_degrees", oracle=GRAPH_SQL + "SELECT dst AS id, CAST(count(*) AS INTEGER) AS inDeg FROM e GROUP BY dst")
def in_degrees(spark, sf_dir):
    return G.in_degrees(graph(spark, sf_dir))


@query("out_degrees", oracle=GRAPH_SQL + "SELECT src AS id, CAST(count(*) AS INTEGER) AS outDeg FROM e GROUP BY src")
def out_degrees(spark, sf_dir):
    return G.out_degrees(graph(spark, sf_dir))


@query("subgraph", oracle=SUB_SQL + "SELECT src, dst, weight FROM se")
def subgraph(spark, sf_dir):
    return G.subgraph(graph(spark, sf_dir), F.col("age") > 45).edges


@query("vertex_degrees", oracle=GRAPH_SQL + """
    SELECT v.id, v.name, v.age, CAST(coalesce(i.n, 0) AS INTEGER) AS inDeg, CAST(coalesce(o.n, 0) AS INTEGER) AS outDeg
    FROM v LEFT JOIN (SELECT dst AS id, count(*) AS n FROM e GROUP BY dst) i ON v.id = i.id
           LEFT JOIN (SELECT src AS id, count(*) AS n FROM e GROUP BY src) o ON v.id = o.id
    WHERE coalesce(i.n, 0) > 0""")
def vertex_degrees(spark, sf_dir):
    """G10 users with in/out degree, then ``filter(inDeg > 0)``."""
    return G.with_degrees(graph(spark, sf_dir)).where(F.col("inDeg") > 0)


@query("edge_weights", oracle=GRAPH_SQL + """
    SELECT e.src, e.dst, 1.0 / o.n AS weight
    FROM e JOIN (SELECT src, count(*) AS n FROM e GROUP BY src) o ON e.src = o.src""")
def edge_weights(spark, sf_dir):
    return G.edge_weights(graph(spark, sf_dir)).select("src", "dst", "weight")


@query("aggregate_messages", oracle=GRAPH_SQL + """
    SELECT e.dst AS id, max(s.age) AS msg FROM e JOIN v s ON e.src = s.id GROUP BY e.dst""")
def aggregate_messages(spark, sf_dir):
    """Every vertex learns the oldest age among its in-neighbours."""
    return G.aggregate_messages(graph(spark, sf_dir), F.col("src_age"), None, F.max, "msg")


@query("join_vertices", oracle=GRAPH_SQL + """
    SELECT v.id, v.name, CASE WHEN o.n IS NOT NULL THEN v.age + o.n ELSE v.age END AS age
    FROM v LEFT JOIN (SELECT src AS id, CAST(count(*) AS INTEGER) AS n FROM e GROUP BY src) o ON v.id = o.id""")
def join_vertices(spark, sf_dir):
    """G19 ``joinVertices(outDegrees)((id, age, deg) => age + deg)``."""
    g = graph(spark, sf_dir)
    return G.join_vertices(g, G.out_degrees(g).withColumnRenamed("outDeg", "age"), "age", lambda old, new: old + new)


CC_SQL = SUB_SQL + """
, und AS (SELECT src, dst FROM se WHERE src <> dst UNION SELECT dst, src FROM se WHERE src <> dst),
cc AS (SELECT id, min(label) AS component FROM (
  WITH RECURSIVE walk(id, label) AS (
    SELECT id, id FROM sv
    UNION
    SELECT und.dst, walk.label FROM walk JOIN und ON walk.id = und.src)
  SELECT * FROM walk) GROUP BY id)
"""


@query("connected_components", oracle=CC_SQL + "SELECT id, component FROM cc")
def connected_components(spark, sf_dir):
    """G6 + G7: components of the subgraph of vertices older than 45."""
    return G.connected_components(G.subgraph(graph(spark, sf_dir), F.col("age") > 45))


@query("component_names", oracle=CC_SQL + """
    SELECT sv.id, sv.name || ' is in component ' || cc.component AS line FROM sv LEFT JOIN cc ON sv.id = cc.id""")
def component_names(spark, sf_dir):
    """G8/J4 ``vertices.leftJoin(cc.vertices)`` as sentences."""
    sub = G.subgraph(graph(spark, sf_dir), F.col("age") > 45)
    cc = G.connected_components(sub)
    return (sub.vertices.join(cc, "id", "left")
            .select("id", F.concat(F.col("name"), F.lit(" is in component "),
                                   F.col("component").cast("string")).alias("line")))


@query("triangle_count", oracle="""
    WITH e AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b
               FROM lineitem WHERE l_partkey <> l_suppkey),
    t AS (SELECT e1.a AS x, e1.b AS y, e2.b AS z FROM e e1 JOIN e e2 ON e1.b = e2.a
          JOIN e e3 ON e3.a = e1.a AND e3.b = e2.b),
    vs AS (SELECT a AS id FROM e UNION SELECT b FROM e),
    c AS (SELECT id, count(*) AS n FROM (SELECT x AS id FROM t UNION ALL SELECT y FROM t UNION ALL SELECT z FROM t)
          GROUP BY id)
    SELECT vs.id, coalesce(c.n, 0) AS triangles FROM vs LEFT JOIN c ON vs.id = c.id""")
def triangle_count(spark, sf_dir):
    """G17 on the undirected graph of (part key, supplier key) pairs in one id space."""
    li = table(spark, sf_dir, "lineitem")
    return G.triangle_count(li.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")))


@query("map_vertices", oracle=GRAPH_SQL + "SELECT id, name || ' (' || age || ')' AS label FROM v")
def map_vertices(spark, sf_dir):
    """G9 ``mapVertices``: name and age become one label."""
    label = F.concat(F.col("name"), F.lit(" ("), F.col("age").cast("string"), F.lit(")"))
    return G.map_vertices(graph(spark, sf_dir), label=label).vertices


@query("map_triplets", oracle=GRAPH_SQL + """
    SELECT e.src, e.dst, e.weight * (s.age - d.age) AS gap FROM e JOIN v s ON e.src = s.id JOIN v d ON e.dst = d.id""")
def map_triplets(spark, sf_dir):
    """G11 ``mapTriplets`` with both ends' attributes."""
    return G.map_triplets(graph(spark, sf_dir), gap=F.col("weight") * (F.col("src_age") - F.col("dst_age"))).edges


@query("map_edges", oracle=GRAPH_SQL + "SELECT src, dst, weight * 2 AS doubled FROM e")
def map_edges(spark, sf_dir):
    """G9 ``mapEdges``."""
    return G.map_edges(graph(spark, sf_dir), doubled=F.col("weight") * 2).edges


@query("components_all", oracle=GRAPH_SQL.replace("WITH v AS", "WITH RECURSIVE v AS", 1) + """
, und AS MATERIALIZED (SELECT src, dst FROM e WHERE src <> dst UNION SELECT dst, src FROM e WHERE src <> dst),
cc(id, label) USING KEY (id) AS (
  SELECT id, id FROM v
  UNION
  SELECT und.dst, min(cc.label) FROM cc JOIN und ON cc.id = und.src JOIN recurring.cc AS old ON old.id = und.dst
  WHERE cc.label < old.label GROUP BY und.dst)
SELECT id, label AS component FROM cc""")
def components_all(spark, sf_dir):
    """G7 on the whole graph."""
    return G.connected_components(graph(spark, sf_dir))
