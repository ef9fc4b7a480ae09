"""Table queries (S2, S4, S5, S12, P1, P2, A6, F2, F4, T7, T8) on ``customer``,
``orders`` and ``documents``-derived inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallgrass.operators import text as T
from tallgrass.operators import topk
from tallgrass.plans.registry import query
from tallgrass.plans.text_queries import _STRIP_COUNTS
from tallgrass.sources.derived import people_json_lines, people_text_lines
from tallgrass.sources.records import parse_delimited, parse_json_lines
from tallgrass.sources.tables import table

PEOPLE_SQL = """
WITH people AS (
  SELECT c_name AS name, CAST(CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS BIGINT) AS age FROM customer)
"""

PEOPLE_SCHEMA = "name string, age bigint"


def people(spark, sf_dir):
    """people.json: ``name``, ``age`` (missing for some, perhaps for all, so the schema is given)."""
    return parse_json_lines(people_json_lines(table(spark, sf_dir, "customer")), schema=PEOPLE_SCHEMA)


def people_txt(spark, sf_dir):
    """people.txt: ``name, age`` lines split and typed."""
    return parse_delimited(people_text_lines(table(spark, sf_dir, "customer")), ["name", "age"], ["string", "int"])


@query("json_props", oracle=PEOPLE_SQL + "SELECT name, age FROM people")
def json_props(spark, sf_dir):
    return people(spark, sf_dir)


@query("project_expr", oracle=PEOPLE_SQL + "SELECT name, age + 1 AS age_plus_one FROM people")
def project_expr(spark, sf_dir):
    """P1/P2 ``select(name, age + 1)``; a missing age stays NULL."""
    p = people(spark, sf_dir)
    return p.select(p["name"], (p["age"] + 1).alias("age_plus_one"))


@query("filter_gt", oracle=PEOPLE_SQL + "SELECT name, age FROM people WHERE age > 21")
def filter_gt(spark, sf_dir):
    """F2 ``filter(age > 21)``; NULL ages are rejected."""
    p = people(spark, sf_dir)
    return p.filter(p["age"] > 21)


@query("age_counts", oracle=PEOPLE_SQL + "SELECT age, count(*) AS count FROM people GROUP BY age")
def age_counts(spark, sf_dir):
    """A6 ``groupBy('age').count()``; NULL is a group of its own."""
    return people(spark, sf_dir).groupBy("age").agg(F.count(F.lit(1)).alias("count"))


@query("delimited_people", oracle="SELECT c_name AS name, c_nationkey AS age FROM customer")
def delimited_people(spark, sf_dir):
    return people_txt(spark, sf_dir)


@query("sql_range_filter", oracle="""
    SELECT 'Name: ' || c_name AS line FROM customer WHERE c_nationkey >= 13 AND c_nationkey <= 19""")
def sql_range_filter(spark, sf_dir):
    """S12 + F4: temp view, SQL text with a range predicate, then a map."""
    view = f"people_{uuid.uuid4().hex[:8]}"
    people_txt(spark, sf_dir).createOrReplaceTempView(view)
    teenagers = spark.sql(f"SELECT name FROM {view} WHERE age >= 13 AND age <= 19")
    spark.catalog.dropTempView(view)  # the query is resolved already
    return teenagers.select(F.concat(F.lit("Name: "), F.col("name")).alias("line"))


@query("sample_n", oracle=f"""
    SELECT word, count FROM ({_STRIP_COUNTS}) ORDER BY md5(word || ':42'), word LIMIT 10""")
def sample_n(spark, sf_dir):
    """T7 ``counts.takeSample(False, 10)`` over the word counts."""
    counts = T.word_count(table(spark, sf_dir, "documents").select("text"), "text", "strip")
    return topk.sample_n(counts, 10, ["word"], seed=42)


@query("first_n", oracle="SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 2")
def first_n(spark, sf_dir):
    """T8 ``take(2)`` in key order."""
    return topk.first_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 2, "o_orderkey")


@query("json_inferred", oracle="""
    SELECT c_custkey AS id, c_name AS name, c_acctbal >= 0 AS good, c_mktsegment AS segment FROM customer""")
def json_inferred(spark, sf_dir):
    """JSON lines whose schema is inferred over all rows, a nested field included."""
    row = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                   F.struct((F.col("c_acctbal") >= 0).alias("good"), F.col("c_mktsegment").alias("segment")).alias("account"))
    people = parse_json_lines(table(spark, sf_dir, "customer").select(F.to_json(row).alias("value")))
    return people.select("id", "name", "account.good", "account.segment")
