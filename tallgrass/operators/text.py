"""Word counting and word top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.tokenize import SPLITTERS


def tokens(df: DataFrame, text_col: str = "value", tokenizer: str = "ws", out_col: str = "word") -> DataFrame:
    """One row per token (flat map): split, explode, drop empty pieces, then
    the tokenizer's per-token map -- all inside whole-stage codegen."""
    split, post = SPLITTERS[tokenizer]
    raw = df.select(F.explode(split(F.col(text_col))).alias("_tok")).where(F.col("_tok") != "")
    return raw.select(post(F.col("_tok")).alias(out_col))


def word_count(df: DataFrame, text_col: str = "value", tokenizer: str = "ws") -> DataFrame:
    """(word, count). The group-by plans as partial + final HashAggregate, so a
    word holding a third of all tokens is pre-combined per task before the
    shuffle (the combiner of the MapReduce job, for free)."""
    return tokens(df, text_col, tokenizer).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def line_count(df: DataFrame) -> DataFrame:
    """Global count of rows as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_lines"))


def top_words(counts: DataFrame, n: int = 20) -> DataFrame:
    """``top(n, key=count)``; ties broken by word so the result is stable.
    orderBy + limit plans as TakeOrderedAndProject: a local top-n per task and
    one merge of at most n rows per task."""
    return counts.orderBy(F.col("count").desc(), F.col("word").asc()).limit(n)


def top_long_words(counts: DataFrame, n: int = 20, min_len: int = 5) -> DataFrame:
    """Words shorter than ``min_len`` rank as 0 -- they are demoted, not
    filtered, and come back when fewer than n long words exist."""
    rank_key = F.when(F.length("word") < min_len, F.lit(0)).otherwise(F.col("count"))
    return (counts.withColumn("rank_key", rank_key)
            .orderBy(F.col("rank_key").desc(), F.col("word").asc())
            .limit(n))
