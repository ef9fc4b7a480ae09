"""PageRank queries (G12-G16, T5, J3) on the part/supplier graph.

Oracles unroll the supersteps as chained, materialized CTEs (a fixed number
of steps; extra steps after convergence change nothing). Ranks are rounded
(6 places for the fixed-round variants, 4 for the tolerance variant) so that
summation order does not decide the value hash.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import graph as G
from tallgrass.operators import pagerank as P
from tallgrass.plans.graph_queries import GRAPH_SQL, edge_file, graph
from tallgrass.plans.registry import query

RESET = 0.15
ITERS = 20
TOL = 1e-4
TOL_ORACLE_STEPS = 120


def _d(x: float) -> str:
    """A Python double as an exact DuckDB DOUBLE literal."""
    return f"CAST('{x!r}' AS DOUBLE)"


_R, _G = _d(RESET), _d(1.0 - RESET)

_WEIGHTS = """
, w AS MATERIALIZED (
  SELECT e.src, e.dst, 1.0 / o.n AS w FROM e JOIN (SELECT src, count(*) AS n FROM e GROUP BY src) o ON e.src = o.src)
"""


def _pregel_sql() -> str:
    parts = [GRAPH_SQL, _WEIGHTS, f", s0 AS MATERIALIZED (SELECT id, {_R} + {_G} * 0.0 AS rank, true AS active FROM v)"]
    for i in range(1, ITERS + 1):
        p = f"s{i - 1}"
        parts.append(f"""
, s{i} AS MATERIALIZED (
  SELECT s.id, CASE WHEN m.msg IS NOT NULL THEN {_R} + {_G} * m.msg ELSE s.rank END AS rank,
         m.msg IS NOT NULL AS active
  FROM {p} s LEFT JOIN (SELECT w.dst AS id, sum(q.rank * w.w) AS msg FROM w JOIN {p} q ON w.src = q.id
                         WHERE q.active GROUP BY w.dst) m ON s.id = m.id)""")
    parts.append(f"\nSELECT id, round(rank, 6) AS rank FROM s{ITERS}")
    return "".join(parts)


def _tol_sql() -> str:
    init = _d(RESET / (1.0 - RESET))
    parts = [GRAPH_SQL, _WEIGHTS,
             f", t0 AS MATERIALIZED (SELECT id, 0.0 + {_G} * {init} AS pr, {_G} * {init} AS delta, "
             f"true AS active FROM v)"]
    for i in range(1, TOL_ORACLE_STEPS + 1):
        p = f"t{i - 1}"
        parts.append(f"""
, t{i} AS MATERIALIZED (
  SELECT s.id, CASE WHEN m.msg IS NOT NULL THEN s.pr + {_G} * m.msg ELSE s.pr END AS pr,
         CASE WHEN m.msg IS NOT NULL THEN {_G} * m.msg ELSE s.delta END AS delta, m.msg IS NOT NULL AS active
  FROM {p} s LEFT JOIN (SELECT w.dst AS id, sum(q.delta * w.w) AS msg FROM w JOIN {p} q ON w.src = q.id
                         WHERE q.active AND q.delta > {_d(TOL)} GROUP BY w.dst) m ON s.id = m.id)""")
    last = f"t{TOL_ORACLE_STEPS}"
    parts.append(f"""
, ranks AS (SELECT id, pr * (SELECT count(*) FROM {last}) / (SELECT sum(pr) FROM {last}) AS rank FROM {last})
""")
    return "".join(parts)


def _rounds_sql() -> str:
    parts = [GRAPH_SQL, """
, es AS (SELECT DISTINCT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM e UNION SELECT '#', 'part'),
l AS MATERIALIZED (SELECT es.src, es.dst, o.n FROM es JOIN (SELECT src, count(*) AS n FROM es GROUP BY src) o
                   ON es.src = o.src),
r0 AS MATERIALIZED (SELECT DISTINCT src AS id, CAST(1.0 AS DOUBLE) AS rank FROM l)"""]
    for i in range(1, ITERS + 1):
        parts.append(f"""
, r{i} AS MATERIALIZED (
  SELECT l.dst AS id, {_R} + {_G} * sum(r.rank / l.n) AS rank FROM l JOIN r{i - 1} r ON l.src = r.id GROUP BY l.dst)""")
    return "".join(parts)


@query("pagerank_pregel", oracle=_pregel_sql())
def pagerank_pregel(spark, sf_dir):
    ranks = P.pagerank_pregel(graph(spark, sf_dir), ITERS, RESET)
    return ranks.select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_tol", oracle=_tol_sql() + "SELECT id, round(rank, 4) AS rank FROM ranks")
def pagerank_tol(spark, sf_dir):
    ranks = P.pagerank_tolerance(graph(spark, sf_dir), TOL, RESET)
    return ranks.select("id", F.round("rank", 4).alias("rank"))


@query("pagerank_named", oracle=_tol_sql() + """
    SELECT v.name, round(r.rank, 4) AS rank FROM v JOIN ranks r ON v.id = r.id""")
def pagerank_named(spark, sf_dir):
    """G16/J3 ``users.join(ranks)`` -> (name, rank)."""
    g = graph(spark, sf_dir)
    ranks = P.pagerank_tolerance(g, TOL, RESET)
    return g.vertices.join(ranks, "id").select("name", F.round("rank", 4).alias("rank"))


@query("pagerank_rounds", oracle=_rounds_sql() + f"\nSELECT id, round(rank, 6) AS rank FROM r{ITERS}")
def pagerank_rounds(spark, sf_dir):
    ranks = P.pagerank_rounds(G.parse_edge_pairs(edge_file(spark, sf_dir)), ITERS, RESET)
    return ranks.select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_top10", oracle=_rounds_sql() + f"""
    SELECT id, round(rank, 6) AS rank FROM r{ITERS} ORDER BY rank DESC, id ASC LIMIT 10""")
def pagerank_top10(spark, sf_dir):
    ranks = P.pagerank_rounds(G.parse_edge_pairs(edge_file(spark, sf_dir)), ITERS, RESET)
    return P.top_ranks(ranks, 10).select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_edge_list", oracle=_pregel_sql().replace("FROM v)", "FROM (SELECT src AS id FROM e UNION SELECT dst FROM e))"))
def pagerank_edge_list(spark, sf_dir):
    """G14 from an edge file alone: its vertices are the edges' ends."""
    edges = G.parse_edge_list(edge_file(spark, sf_dir))
    ranks = P.pagerank_pregel(G.PropertyGraph(G.edge_vertices(edges), edges), ITERS, RESET)
    return ranks.select("id", F.round("rank", 6).alias("rank"))
