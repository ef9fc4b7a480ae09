"""Inputs the reference reads from files we do not have (access logs, an XML
user dump, people files, taxi rides, edge lists), derived from the driver
tables with plain column expressions. Every derived input grows with the
table it comes from; no row is dropped or sampled to make one.

The SQL oracles compute their answers from the *original* columns, not by
re-parsing these texts, so a parser bug shows up as a mismatch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# ---------------------------------------------------------------- access log
def clf_lines(events: DataFrame) -> DataFrame:
    """One Common-Log-Format line per event (``value``)::

        u{user_id}.example.net - - [dd/MMM/yyyy:HH:mm:ss -0400] "GET /{event_type} HTTP/1.0" code size

    code: error -> 403 when value < 25 else 500; signup -> 302; else 200.
    size: ``-`` when value < 2, else round(value * 100).
    Purchases with value >= 400 have an empty protocol; events with
    10 <= value < 10.5 become a line the pattern does not match.
    """
    v = F.col("value")
    code = (F.when((F.col("event_type") == "error") & (v < 25), F.lit(403))
            .when(F.col("event_type") == "error", F.lit(500))
            .when(F.col("event_type") == "signup", F.lit(302))
            .otherwise(F.lit(200)))
    size = F.when(v < 2, F.lit("-")).otherwise(F.round(v * 100).cast("bigint").cast("string"))
    proto = F.when((F.col("event_type") == "purchase") & (v >= 400), F.lit("")).otherwise(F.lit(" HTTP/1.0"))
    line = F.concat(
        F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.net - - ["),
        F.date_format(F.col("ts"), "dd/MMM/yyyy:HH:mm:ss"), F.lit(" -0400] \"GET /"),
        F.col("event_type"), proto, F.lit("\" "), code.cast("string"), F.lit(" "), size)
    garbled = F.concat(F.lit("#garbled event "), F.col("event_id").cast("string"))
    return events.select(F.when((v >= 10) & (v < 10.5), garbled).otherwise(line).alias("value"))


# ------------------------------------------------------------------- people
def people_json_lines(customer: DataFrame) -> DataFrame:
    """``{"name": c_name, "age": c_nationkey}`` per customer; ``age`` is
    absent (not null) when the account balance is negative."""
    age = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    return customer.select(F.to_json(F.struct(F.col("c_name").alias("name"), age.alias("age"))).alias("value"))


def people_text_lines(customer: DataFrame) -> DataFrame:
    """``name, age`` lines (comma and a blank), as in the people text file."""
    return customer.select(F.concat_ws(", ", F.col("c_name"), F.col("c_nationkey").cast("string")).alias("value"))


# ----------------------------------------------------------------- XML rows
def xml_user_lines(customer: DataFrame) -> DataFrame:
    """One ``<row .../>`` line per customer, indented by two blanks::

        <row Id="c_custkey" Reputation="floor(c_acctbal / 10)" DisplayName="c_name" AboutMe="&lt;p&gt;segment&lt;/p&gt;" />

    Customers with a negative balance have no Reputation attribute (the
    top-ten job skips such rows). Entities stay encoded, as in the dump.
    """
    rep = F.when(F.col("c_acctbal") >= 0,
                 F.concat(F.lit(' Reputation="'), F.floor(F.col("c_acctbal") / 10).cast("string"), F.lit('"')))
    line = F.concat(
        F.lit('  <row Id="'), F.col("c_custkey").cast("string"), F.lit('"'),
        F.coalesce(rep, F.lit("")),
        F.lit(' DisplayName="'), F.col("c_name"), F.lit('"'),
        F.lit(' AboutMe="&lt;p&gt;'), F.col("c_mktsegment"), F.lit('&lt;/p&gt;" />'))
    return customer.select(line.alias("value"))


# -------------------------------------------------------------------- rides
# Integer micro-degree coordinates, so grid floors agree exactly everywhere.
RIDE_WEST_U = -74_050_000
RIDE_SOUTH_U = 40_450_000
RIDE_LON_SPAN_U = 400_000
RIDE_LAT_SPAN_U = 600_000


def ride_events(events: DataFrame) -> DataFrame:
    """One taxi-ride event per driver event.

    ``isStart`` for views and clicks; both ends spread over a 0.4 x 0.6 degree
    area around the city by multiplicative hashing of ``event_id``; the event
    time is ``ts``. Coordinates are kept as integer micro-degrees (``*_u``)
    next to the double degrees the ride record has.
    """
    eid = F.col("event_id")

    def coord(base, prime, span):
        # (id mod span) * prime stays far from 64-bit overflow at any id.
        return (F.lit(base) + F.pmod(F.pmod(eid, F.lit(span)) * prime, F.lit(span))).cast("bigint")

    s_lon = coord(RIDE_WEST_U, 7919, RIDE_LON_SPAN_U)
    s_lat = coord(RIDE_SOUTH_U, 104729, RIDE_LAT_SPAN_U)
    e_lon = coord(RIDE_WEST_U, 6101, RIDE_LON_SPAN_U)
    e_lat = coord(RIDE_SOUTH_U, 15485863, RIDE_LAT_SPAN_U)
    return events.select(
        eid.alias("rideId"),
        F.col("event_type").isin("view", "click").alias("isStart"),
        s_lon.alias("startLon_u"), s_lat.alias("startLat_u"),
        e_lon.alias("endLon_u"), e_lat.alias("endLat_u"),
        (s_lon / 1e6).alias("startLon"), (s_lat / 1e6).alias("startLat"),
        (e_lon / 1e6).alias("endLon"), (e_lat / 1e6).alias("endLat"),
        F.col("ts").alias("eventTime"),
    )


# -------------------------------------------------------------------- graphs
def part_supplier_edges(lineitem: DataFrame, back_edges: str = "l_linenumber = 1 AND l_returnflag = 'R'") -> DataFrame:
    """Directed multigraph: part ``2*l_partkey`` -> supplier ``2*l_suppkey+1``
    for every line item, plus supplier -> part for the line items matching
    ``back_edges``; weight = quantity. Parts never named on such a line get
    no in-links. One scan: each line item emits one or two edges."""
    qty = F.col("l_quantity").cast("int")
    part, supp = F.col("l_partkey") * 2, F.col("l_suppkey") * 2 + 1
    fwd = F.struct(part.alias("src"), supp.alias("dst"), qty.alias("weight"))
    back = F.struct(supp.alias("src"), part.alias("dst"), qty.alias("weight"))
    both = F.when(F.expr(back_edges), F.array(fwd, back)).otherwise(F.array(fwd))
    return lineitem.select(F.explode(both).alias("e")).select("e.src", "e.dst", "e.weight")


def part_supplier_vertices(part: DataFrame, supplier: DataFrame) -> DataFrame:
    """Vertices (id, name, age): parts keep ``p_size`` as their age, suppliers
    ``s_nationkey + 25``."""
    return (part.select((F.col("p_partkey") * 2).alias("id"), F.col("p_name").alias("name"),
                        F.col("p_size").alias("age"))
            .unionByName(supplier.select((F.col("s_suppkey") * 2 + 1).alias("id"), F.col("s_name").alias("name"),
                                         (F.col("s_nationkey") + 25).alias("age"))))


def edge_list_lines(edges: DataFrame) -> DataFrame:
    """``src<TAB>dst`` text lines of an edge list, as an edge-list file holds them."""
    return edges.select(F.concat_ws("\t", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
