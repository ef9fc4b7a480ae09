"""Readers of real files (S1, S2, S5, S6, S8): derived lines are written to the
shared folder as text files and read back from there."""

from __future__ import annotations

from tallgrass.operators import graph as G
from tallgrass.operators import text as T
from tallgrass.plans import graph_queries, table_queries, weblog_queries  # noqa: F401  (registers the in-column twins)
from tallgrass.plans.graph_queries import GRAPH_SQL, edge_file
from tallgrass.plans.registry import REGISTRY, query
from tallgrass.plans.table_queries import PEOPLE_SCHEMA, PEOPLE_SQL
from tallgrass.session import scratch_path
from tallgrass.sources.derived import clf_lines, people_json_lines, people_text_lines
from tallgrass.sources.records import read_delimited, read_json_lines
from tallgrass.sources.tables import document_lines, read_lines, table
from tallgrass.sources.weblog import read_access_log


def _file(lines, name):
    path = scratch_path(lines.sparkSession, name)
    lines.select("value").write.text(path)
    return path


@query("read_lines_file", oracle=REGISTRY["line_count"].oracle)
def read_lines_file(spark, sf_dir):
    """S1 ``textFile``: one file line per document line."""
    lines = document_lines(table(spark, sf_dir, "documents").select("text"))
    return T.line_count(read_lines(spark, _file(lines, "lines")))


@query("read_log_file", oracle=REGISTRY["clf_parse"].oracle)
def read_log_file(spark, sf_dir):
    """S1 + S6: an access log read from its file."""
    return read_access_log(spark, _file(clf_lines(table(spark, sf_dir, "events")), "log"))


@query("read_json_file", oracle=PEOPLE_SQL + "SELECT name, age FROM people")
def read_json_file(spark, sf_dir):
    """People.json with a given schema."""
    return read_json_lines(spark, _file(people_json_lines(table(spark, sf_dir, "customer")), "people-json"), PEOPLE_SCHEMA)


@query("read_delimited_file", oracle=REGISTRY["delimited_people"].oracle)
def read_delimited_file(spark, sf_dir):
    """People.txt."""
    path = _file(people_text_lines(table(spark, sf_dir, "customer")), "people-txt")
    return read_delimited(spark, path, ["name", "age"], ["string", "int"])


@query("read_edge_file", oracle=GRAPH_SQL + "SELECT src, dst FROM e")
def read_edge_file(spark, sf_dir):
    """An edge list file with its comment line."""
    return G.parse_edge_list(read_lines(spark, _file(edge_file(spark, sf_dir), "edges")))
