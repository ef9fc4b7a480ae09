"""Driver tables (one parquet file each) and text-line sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; filters and projections applied later are pushed into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``textFile`` -> one ``value`` string per line."""
    return spark.read.text(path)


def document_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Lines of every document, as a text file of the documents would give them
    (LF, CRLF or CR end a line; a final line break adds no empty line)."""
    body = F.regexp_replace(F.col(text_col), "(\r\n|\r|\n)$", "")
    return docs.select(F.explode(F.split(body, "\r\n|\r|\n")).alias("value"))
