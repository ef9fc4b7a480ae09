"""Exact de-duplication by content sort.

Rows are range-partitioned by splitters that Spark samples, sorted by their
normalised bytes inside each partition (Spark's external sort), and equal
neighbours form a group. The splitters cover a bounded prefix of the
normalised text and a 64-bit hash, so the sample the driver holds does not grow
with text length and texts sharing a long passage still spread.

A text that many rows share would fill one partition, so texts with more than
``rows / (8 * partitions)`` copies -- by that bound at most ``8 * partitions``
of them -- are cut into pieces by row number, whether their ids differ, repeat
or are null. Each piece is sorted and compared like any other group, and the
pieces' results (a bounded number) are then merged and joined back; the merge
also says which piece's first row stays.

Normal form: A-Z lower-cased, null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, borrowed, fresh, partitions, written

PREFIX = 32


def content_groups(df: DataFrame, text: str = "text", id_col: str = "doc_id", keep_columns: bool = True,
                   only_kept: bool = False) -> DataFrame:
    """One row per input row (the surviving ones, if ``only_kept``) with the
    columns of ``df`` (only the id, unless ``keep_columns``) and

    * ``keep_id``: the largest id among the rows of equal text (null if all are null),
    * ``group_size``: rows of equal text,
    * ``kept``: true for exactly one row of each group, one holding ``keep_id``
      (of repeated ids, any one row),
    * ``text_sha256``: lower-case hex SHA-256 of the normalised text.

    Columns of ``df`` with these names are replaced. Null ids come after all
    others, repeated rows are members like any other, empty and null texts are
    one group; an empty table gives an empty result. ``df`` should be a scan or
    a written table, so that a task that runs again numbers its rows the same
    way. ``release`` of the result deletes its table.
    """
    spark = df.sparkSession
    made = ["keep_id", "group_size", "kept", "text_sha256"]
    if {id_col.lower(), text.lower()} & set(made):
        raise ValueError("the id and text columns can't have the name of an added column")
    p, h, salt, norm, copies, rn, row = fresh(df, "p", "h", "salt", "norm", "copies", "rn", "row")
    passengers = [c for c in df.columns if c.lower() not in made] if keep_columns else [id_col]
    # Equal normal forms have equal `lower` forms, so this hash never parts copies.
    body = F.coalesce(F.col(text), F.lit(""))
    carried = list(dict.fromkeys([*passengers, text]))
    keyed = df.select(*carried, F.xxhash64(F.lower(body)).alias(h))
    part = max(1, df.count() // (8 * partitions(spark)))
    hot = (df.select(F.xxhash64(F.lower(body)).alias(h)).groupBy(h).agg(F.count("*").alias(copies))
           .filter(F.col(copies) > part))
    pieces = F.ceil(F.col(copies) / F.lit(part)).cast("long")
    keyed = keyed.withColumn(row, F.monotonically_increasing_id()).join(F.broadcast(hot), h, "left").select(
        *carried, h, F.coalesce(F.pmod(F.col(row), pieces), F.lit(-1)).alias(salt))
    ranged = keyed.withColumn(p, ascii_lower(F.substring(body, 1, PREFIX))).repartitionByRange(p, h, salt)
    ordered = (ranged.withColumn(norm, ascii_lower(body))
               .select(*passengers, p, h, salt, norm)
               .sortWithinPartitions(p, h, salt, norm, F.col(id_col).desc()))
    same = Window.partitionBy(p, h, salt, norm)
    first = same.orderBy(F.col(id_col).desc())
    piece = ordered.select(
        *passengers, salt, F.row_number().over(first).alias(rn),
        F.first(id_col).over(first).alias("keep_id"),
        F.count("*").over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("group_size"),
        F.sha2(norm, 256).alias("text_sha256"))
    if only_kept:
        piece = piece.filter(F.col(rn) == 1)
    piece = written(piece, "content-sort")
    # of a text in pieces: the largest id, all rows, and the first piece that holds that id
    best = F.max(F.struct(F.col("keep_id"), (-F.col(salt)).alias("from")))
    whole = (piece.filter((F.col(salt) >= 0) & (F.col(rn) == 1)).groupBy("text_sha256")
             .agg(best.alias(p), F.sum("group_size").alias(copies)))
    cut = F.col(salt) >= 0
    out = piece.join(F.broadcast(whole), "text_sha256", "left").select(
        *passengers,
        F.when(cut, F.col(p)["keep_id"]).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(cut, F.col(copies)).otherwise(F.col("group_size")).alias("group_size"),
        ((F.col(rn) == 1) & (~cut | (F.col(salt) == -F.col(p)["from"]))).alias("kept"),
        "text_sha256")
    return borrowed(out.filter("kept") if only_kept else out, piece)


def drop_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` with one row of each group of equal texts: the one with the largest
    id (of repeated ids any one row; null ids last). Null and empty texts are one
    group. All columns are handed through; an empty table gives an empty result."""
    kept = content_groups(df, text, id_col, only_kept=True)
    return borrowed(kept.select(*df.columns), kept)
