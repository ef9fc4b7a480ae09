"""Text queries over ``documents.text``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallgrass.functions import udfs
from tallgrass.functions.udfs import register_nonword_tokens
from tallgrass.operators import text as T
from tallgrass.plans.registry import query
from tallgrass.sources.tables import document_lines, table

# DuckDB spellings of the three tokenizers (same regexes as tallgrass.functions.tokenize).
_WS = r"regexp_split_to_array(text, '[ \t\n\r\f]+')"
_NONWORD = r"regexp_split_to_array(lower(text), '\W+')"
_PYWS = (r"regexp_split_to_array(text, '[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}"
         r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+')")

_STRIP_COUNTS = f"""
    SELECT trim(tok, '.,;:?!-') AS word, count(*) AS count
    FROM (SELECT unnest({_PYWS}) AS tok FROM documents)
    WHERE tok <> '' GROUP BY 1"""


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("text")


@query("line_count", oracle=r"""
    SELECT count(*) AS n_lines
    FROM (SELECT unnest(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) AS l
          FROM documents)""")
def line_count(spark, sf_dir):
    return T.line_count(document_lines(_docs(spark, sf_dir)))


@query("wordcount_ws", oracle=f"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest({_WS}) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def wordcount_ws(spark, sf_dir):
    return T.word_count(_docs(spark, sf_dir), "text", "ws")


@query("wordcount_nonword", oracle=f"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest({_NONWORD}) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def wordcount_nonword(spark, sf_dir):
    return T.word_count(_docs(spark, sf_dir), "text", "nonword")


@query("wordcount_strip", oracle=_STRIP_COUNTS)
def wordcount_strip(spark, sf_dir):
    return T.word_count(_docs(spark, sf_dir), "text", "strip")


@query("top_words", oracle=f"""
    SELECT word, count FROM ({_STRIP_COUNTS}) ORDER BY count DESC, word ASC LIMIT 20""")
def top_words(spark, sf_dir):
    return T.top_words(T.word_count(_docs(spark, sf_dir), "text", "strip"), 20)


@query("top_long_words", oracle=f"""
    SELECT word, count, CASE WHEN length(word) < 5 THEN 0 ELSE count END AS rank_key
    FROM ({_STRIP_COUNTS}) ORDER BY rank_key DESC, word ASC LIMIT 20""")
def top_long_words(spark, sf_dir):
    return T.top_long_words(T.word_count(_docs(spark, sf_dir), "text", "strip"), 20, 5)


@query("tokenize_udtf", oracle=f"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest({_NONWORD}) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def tokenize_udtf(spark, sf_dir):
    """U4: the flat-map function in a lateral view, which makes each text's words
    in its own task; the count after it is the same partial/final aggregate."""
    name, view = register_nonword_tokens(spark), f"docs_{uuid.uuid4().hex[:8]}"
    _docs(spark, sf_dir).createOrReplaceTempView(view)
    words = spark.sql(f"SELECT word FROM (SELECT {name}_array(text) AS words FROM {view}) LATERAL VIEW explode(words) w AS word")
    spark.catalog.dropTempView(view)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@query("flat_map_batches", oracle=f"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest({_NONWORD}) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def flat_map_batches(spark, sf_dir):
    """A user's function over Arrow batches as a SQL table function."""
    name, view = f"words_{uuid.uuid4().hex[:8]}", f"docs_{uuid.uuid4().hex[:8]}"
    spark.udtf.register(name, udfs.flat_map_batches(udfs.nonword_tokens_of, "word string"))
    _docs(spark, sf_dir).createOrReplaceTempView(view)
    words = spark.sql(f"SELECT word FROM {name}(TABLE(SELECT text FROM {view}))")
    spark.catalog.dropTempView(view)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
