"""Record sources: JSON lines (S2), delimited text (S5), XML ``<row/>``
attribute lines (S7/X17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# -------------------------------------------------------------------- JSON
def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """S2 JSON-lines file; schema inferred when not given (missing keys -> NULL)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def infer_json_schema(lines: DataFrame, col: str = "value") -> str:
    """Schema of a JSON text column, inferred over *all* rows in one
    distributed aggregate (``schema_of_variant_agg`` merges per-task partial
    schemas), as the JSON file source does on its sampling pass."""
    ddl = lines.select(F.schema_of_variant_agg(F.parse_json(F.col(col)))).first()[0]
    # OBJECT<...> is the variant spelling of a struct.
    return ddl.replace("OBJECT<", "STRUCT<")


def parse_json_lines(lines: DataFrame, col: str = "value", schema: str | T.StructType | None = None) -> DataFrame:
    """S2 for JSON text already in a column: ``from_json`` with the given or
    inferred schema, fields as top-level columns."""
    if schema is None:
        schema = infer_json_schema(lines, col)
    parsed = lines.select(F.from_json(F.col(col), schema).alias("_j"))
    return parsed.select("_j.*")


# --------------------------------------------------------------- delimited
def parse_delimited(lines: DataFrame, names: list[str], types: list[str], sep: str = ",",
                    col: str = "value") -> DataFrame:
    """S5 ``line.split(sep)`` -> typed fields. Numeric fields are trimmed
    before the cast (``int(' 29')`` is 29); a field that does not parse is
    NULL; missing trailing fields are NULL."""
    parts = F.split(F.col(col), sep)
    out = []
    for i, (name, typ) in enumerate(zip(names, types)):
        field = F.get(parts, i)
        if typ != "string":
            field = F.trim(field).try_cast(typ)
        out.append(field.alias(name))
    return lines.select(*out)


def read_delimited(spark: SparkSession, path: str, names: list[str], types: list[str], sep: str = ",") -> DataFrame:
    return parse_delimited(spark.read.text(path), names, types, sep)


# --------------------------------------------------------------------- XML
# Attribute syntax of a <row .../> line: name="value" (entities left encoded).
_ATTR = r'([A-Za-z_][\w.:-]*)="([^"]*)"'


def row_attrs(line) -> F.Column:
    """X17 attribute text -> ``map<string,string>``. Keys and values come from
    one ``regexp_extract_all`` each; a repeated attribute keeps its last value
    (the reference's HashMap.put), via a dedup over the reversed pairs."""
    keys = F.regexp_extract_all(line, F.lit(_ATTR), 1)
    vals = F.regexp_extract_all(line, F.lit(_ATTR), 2)
    pairs = F.reverse(F.arrays_zip(keys.alias("k"), vals.alias("v")))
    firsts = F.aggregate(
        pairs, F.array().cast("array<struct<k:string,v:string>>"),
        lambda acc, p: F.when(F.array_contains(F.transform(acc, lambda a: a["k"]), p["k"]), acc)
        .otherwise(F.concat(acc, F.array(p))))
    return F.map_from_entries(firsts)


def _last(attrs, name: str) -> F.Column:
    """The value of an attribute's last occurrence in (k, v) pairs; NULL without one."""
    return F.try_element_at(F.filter(attrs, lambda p: p["k"] == name), F.lit(-1))["v"]


def parse_row_xml(lines: DataFrame, col: str = "value", with_attrs: bool = False) -> DataFrame:
    """Lines of an XML dump with one ``<row .../>`` per line.

    Returns ``Id bigint, Reputation int, record string`` (the untouched line)
    for rows that carry both attributes; header lines, rows without either
    attribute and lines too short to hold a row are skipped, as in the
    reference mapper. Attributes are matched as quoted pairs from the left, so
    text that looks like an attribute inside a value is no attribute. A
    reputation that is not an integer (the reference job aborts) drops the row;
    a non-numeric Id stays as a NULL ``Id``. ``with_attrs`` adds the full
    attribute map.
    """
    line = F.col(col)
    body = F.trim(line)
    rows = lines.where((F.length(body) >= 8) & body.startswith("<row "))
    pairs = F.arrays_zip(F.regexp_extract_all(line, F.lit(_ATTR), 1).alias("k"), F.regexp_extract_all(line, F.lit(_ATTR), 2).alias("v"))
    read = rows.select(line.alias("record"), pairs.alias("_a")).select("record", _last(F.col("_a"), "Id").alias("_id"),
                                                                      _last(F.col("_a"), "Reputation").alias("_rep"))
    out = read.where(F.col("_id").isNotNull()).select(
        F.col("_id").try_cast("bigint").alias("Id"), F.col("_rep").try_cast("int").alias("Reputation"), "record",
        *([row_attrs(F.col("record")).alias("attrs")] if with_attrs else []))
    return out.where(F.col("Reputation").isNotNull())
