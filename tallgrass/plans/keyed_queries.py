"""Key/value queries over the driver tables.

Pairs: customer name -> nation key (users), order priority -> order key
(pets), customer key -> name / order key (visits and page names), part key ->
size (nums).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import keyed as K
from tallgrass.plans.registry import query
from tallgrass.sources.tables import table


def _users(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("key"),
                                                   F.col("c_nationkey").alias("value"))


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"),
                                                   F.col("c_name").alias("name"))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"),
                                                 F.col("o_orderkey").alias("orderkey"))


@query("kv_map", oracle="""
    SELECT c_name AS key, c_nationkey AS value, c_name || '_wiser' AS wiser_key,
           c_nationkey + 1 AS older_value, CAST(c_nationkey AS BIGINT) * c_nationkey AS squared_value
    FROM customer""")
def kv_map(spark, sf_dir):
    """P4 map over pairs, P5 mapValues, P6 keys/values. The maps are row-wise,
    so they run as one projection over one scan."""
    users = _users(spark, sf_dir)
    return users.select(
        "key", "value",
        F.concat(F.col("key"), F.lit("_wiser")).alias("wiser_key"),
        (F.col("value") + 1).alias("older_value"),
        (F.col("value").cast("bigint") * F.col("value")).alias("squared_value"))


@query("kv_map_pairs", oracle="SELECT c_name || '_wiser' AS key, c_nationkey + 1 AS value FROM customer")
def kv_map_pairs(spark, sf_dir):
    """P4 a map of key and value at once."""
    return K.map_pairs(_users(spark, sf_dir), lambda k: F.concat(k, F.lit("_wiser")), lambda v: v + 1)


@query("kv_map_values", oracle="SELECT c_name AS key, CAST(c_nationkey AS BIGINT) * c_nationkey AS value FROM customer")
def kv_map_values(spark, sf_dir):
    """P5 ``mapValues``, keys untouched."""
    return K.map_values(_users(spark, sf_dir), lambda v: v.cast("bigint") * v)


@query("kv_lookup", oracle="""
    SELECT o_orderkey AS value FROM orders WHERE o_orderpriority = '1-URGENT'""")
def kv_lookup(spark, sf_dir):
    pairs = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("key"),
                                                  F.col("o_orderkey").alias("value"))
    return K.lookup(pairs, "1-URGENT")


@query("kv_reduce_sum", oracle="""
    SELECT l_suppkey AS key, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value
    FROM lineitem GROUP BY l_suppkey""")
def kv_reduce_sum(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"),
                                                    F.col("l_quantity").cast("bigint").alias("value"))
    return K.reduce_by_key(pairs, F.sum)


@query("kv_reduce_fold", oracle="""
    SELECT l_partkey AS key, max(CAST(l_quantity AS BIGINT) * 1000 + l_linenumber) AS value
    FROM lineitem GROUP BY l_partkey""")
def kv_reduce_fold(spark, sf_dir):
    """U7 with a user binary function (here: keep the larger value)."""
    pairs = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("key"),
        (F.col("l_quantity").cast("bigint") * 1000 + F.col("l_linenumber")).alias("value"))
    return K.fold_by_key(pairs, lambda a, b: F.when(a >= b, a).otherwise(b))


@query("kv_group_list", oracle="""
    SELECT key, page, array_to_string(list_sort(list(v)), ',') AS "values"
    FROM (SELECT o_custkey AS key, o_orderkey AS v,
                 (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4096 AS page
          FROM orders)
    GROUP BY key, page""")
def kv_group_list(spark, sf_dir):
    """A5 orders per customer as paged sorted lists (one page unless a
    customer has more than 4,096 orders)."""
    pairs = _orders(spark, sf_dir).withColumnRenamed("orderkey", "value")
    return K.group_values(pairs).select("key", "page", F.array_join("values", ",").alias("values"))


@query("kv_join", oracle="""
    SELECT c_custkey AS key, c_name AS name, o_orderkey AS orderkey
    FROM customer JOIN orders ON c_custkey = o_custkey""")
def kv_join(spark, sf_dir):
    return K.join_pairs(_customers(spark, sf_dir), _orders(spark, sf_dir), "inner")


@query("join_left", oracle="""
    SELECT c_custkey AS key, c_name AS name, o_orderkey AS orderkey
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON c_custkey = o_custkey""")
def join_left(spark, sf_dir):
    finished = (table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
                .select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("orderkey")))
    return K.join_pairs(_customers(spark, sf_dir), finished, "left")


def _monthly(df, ts_col, name):
    return (df.groupBy(F.date_format(ts_col, "yyyy-MM").alias("key"))
            .agg(F.count(F.lit(1)).alias(name)))


@query("join_full", oracle="""
    SELECT coalesce(o.key, l.key) AS key, n_orders, n_shipments
    FROM (SELECT strftime(o_orderdate, '%Y-%m') AS key, count(*) AS n_orders FROM orders GROUP BY 1) o
    FULL OUTER JOIN (SELECT strftime(l_shipdate, '%Y-%m') AS key, count(*) AS n_shipments
                     FROM lineitem GROUP BY 1) l ON o.key = l.key""")
def join_full(spark, sf_dir):
    """Orders per order month against shipments per ship month; months with
    shipments but no new orders appear with a NULL order count."""
    return K.join_pairs(_monthly(table(spark, sf_dir, "orders"), "o_orderdate", "n_orders"),
                        _monthly(table(spark, sf_dir, "lineitem"), "l_shipdate", "n_shipments"),
                        "full_outer")


@query("join_semi", oracle="""
    SELECT c_custkey AS key, c_name AS name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def join_semi(spark, sf_dir):
    urgent = (table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_custkey").alias("key")))
    return K.join_pairs(_customers(spark, sf_dir), urgent, "left_semi")


@query("join_anti", oracle="""
    SELECT c_custkey AS key, c_name AS name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def join_anti(spark, sf_dir):
    urgent = (table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_custkey").alias("key")))
    return K.join_pairs(_customers(spark, sf_dir), urgent, "left_anti")


def _paged(pairs: str) -> str:
    return f"""
    SELECT key, page, array_to_string(list_sort(list(v)), ',') AS vals
    FROM (SELECT key, v, (row_number() OVER (PARTITION BY key ORDER BY v) - 1) // 4096 AS page FROM ({pairs}))
    GROUP BY key, page"""


@query("cogroup", oracle=f"""
    SELECT coalesce(a.key, b.key) AS key, coalesce(a.page, b.page) AS page,
           coalesce(a.vals, '') AS left_values, coalesce(b.vals, '') AS right_values
    FROM ({_paged("SELECT o_custkey AS key, o_orderkey AS v FROM orders")}) a
    FULL OUTER JOIN ({_paged("SELECT c_custkey AS key, c_nationkey AS v FROM customer")}) b
      ON a.key = b.key AND a.page = b.page""")
def cogroup(spark, sf_dir):
    """J9 the orders and the nation of each customer side by side."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("value"))
    nations = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("value"))
    return K.cogroup(orders, nations).select("key", "page", F.array_join("left_values", ",").alias("left_values"),
                                             F.array_join("right_values", ",").alias("right_values"))


@query("kv_keys", oracle="SELECT o_orderpriority AS key FROM orders")
def kv_keys(spark, sf_dir):
    """P6 ``keys()``, duplicates kept."""
    return K.keys(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("key"), F.col("o_orderkey").alias("value")))


@query("kv_values", oracle="SELECT o_orderkey AS value FROM orders")
def kv_values(spark, sf_dir):
    """P6 ``values()``."""
    return K.values(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("key"), F.col("o_orderkey").alias("value")))


@query("flatmap_range", oracle="""
    SELECT unnest(range(0, p_size)) AS v FROM part WHERE p_size > 0""")
def flatmap_range(spark, sf_dir):
    return K.flat_map_range(table(spark, sf_dir, "part").select(F.col("p_size").alias("x")), "x", "v")


@query("map_range_list", oracle="""
    SELECT p_partkey AS key, array_to_string(range(0, greatest(p_size, 0)), ',') AS "values" FROM part""")
def map_range_list(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("key"),
                       F.array_join(K.range_list(F.col("p_size")), ",").alias("values"))


@query("filter_even", oracle="""
    SELECT p_partkey AS key, p_size AS x, CAST(p_size AS BIGINT) * p_size AS squared
    FROM part WHERE p_size % 2 = 0""")
def filter_even(spark, sf_dir):
    """F1 filter plus the P4 squares map of the same cell."""
    nums = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("x"))
    return K.filter_even(nums, "x").withColumn("squared", F.col("x").cast("bigint") * F.col("x"))
