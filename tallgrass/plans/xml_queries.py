"""XML user dump and distinct top ten."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import topk
from tallgrass.plans.registry import query
from tallgrass.sources.derived import xml_user_lines
from tallgrass.sources.records import parse_row_xml
from tallgrass.sources.tables import table

ROWS_SQL = """
WITH xrows AS (
  SELECT c_custkey AS Id, CAST(floor(c_acctbal / 10) AS INTEGER) AS Reputation,
         '  <row Id="' || c_custkey || '" Reputation="' || CAST(floor(c_acctbal / 10) AS BIGINT)
         || '" DisplayName="' || c_name || '" AboutMe="&lt;p&gt;' || c_mktsegment || '&lt;/p&gt;" />' AS record
  FROM customer WHERE c_acctbal >= 0)
"""


def dump_lines(spark, sf_dir):
    """The dump: XML declaration, opening tag, one row per customer, closing tag."""
    rows = xml_user_lines(table(spark, sf_dir, "customer"))
    frame = spark.createDataFrame([('<?xml version="1.0" encoding="utf-8"?>',), ("<users>",), ("</users>",)],
                                  "value string")
    return frame.unionByName(rows)


@query("xml_rows", oracle=ROWS_SQL + "SELECT Id, Reputation, record FROM xrows")
def xml_rows(spark, sf_dir):
    return parse_row_xml(dump_lines(spark, sf_dir))


@query("top_distinct", oracle=ROWS_SQL + """
    SELECT Reputation, arg_max(record, Id) AS record, max(Id) AS Id FROM xrows
    GROUP BY Reputation ORDER BY Reputation DESC LIMIT 10""")
def top_distinct(spark, sf_dir):
    return topk.top_k_distinct(parse_row_xml(dump_lines(spark, sf_dir)), "Reputation", 10, "Id", "record")


@query("xml_attrs", oracle=ROWS_SQL + """
    SELECT CAST(Id AS VARCHAR) AS Id, CAST(Reputation AS VARCHAR) AS Reputation,
           regexp_extract(record, 'DisplayName="([^"]*)"', 1) AS DisplayName,
           regexp_extract(record, 'AboutMe="([^"]*)"', 1) AS AboutMe FROM xrows""")
def xml_attrs(spark, sf_dir):
    """The attribute map of every row, four attributes looked up in it."""
    names = ("Id", "Reputation", "DisplayName", "AboutMe")
    return parse_row_xml(dump_lines(spark, sf_dir), with_attrs=True).select(*[F.col("attrs")[n].alias(n) for n in names])
