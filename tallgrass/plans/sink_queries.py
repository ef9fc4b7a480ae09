"""Sink round trips (K1-K5, T10): write a query's result, read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass import sinks
from tallgrass.operators import text as T
from tallgrass.plans.text_queries import _WS
from tallgrass.plans.registry import query
from tallgrass.plans.xml_queries import ROWS_SQL, dump_lines
from tallgrass.session import scratch_path
from tallgrass.sources.records import parse_row_xml
from tallgrass.sources.tables import table


@query("sink_text_roundtrip", oracle=ROWS_SQL + "SELECT record AS value FROM xrows")
def sink_text_roundtrip(spark, sf_dir):
    """K3/K1: the parsed user rows written record-only as text."""
    path = scratch_path(spark, "sink-text")
    sinks.write_records(parse_row_xml(dump_lines(spark, sf_dir)), path, "record")
    return spark.read.text(path)


@query("sink_tsv_roundtrip", oracle=f"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest({_WS}) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def sink_tsv_roundtrip(spark, sf_dir):
    """The whitespace word count as key-ordered ``word<TAB>count`` lines."""
    path = scratch_path(spark, "sink-tsv")
    counts = T.word_count(table(spark, sf_dir, "documents").select("text"), "text", "ws")
    sinks.write_key_values(counts, path, "word", "count", sort=True)
    return sinks.read_key_values(spark, path, "string", "bigint", "word", "count")


@query("sink_file_count", oracle=ROWS_SQL + "SELECT 5 AS n_files, count(*) AS n_rows FROM xrows")
def sink_file_count(spark, sf_dir):
    """K5: the output in as many files as asked for, counted from the rows read back."""
    path = scratch_path(spark, "sink-files")
    sinks.write_records(parse_row_xml(dump_lines(spark, sf_dir)), path, "record", num_files=5)
    per_file = spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).cast("int").alias("n_files"), F.sum("n").alias("n_rows"))
