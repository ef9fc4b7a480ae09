"""The reference's user-function surfaces (U1, U2, U4, U5), kept as small
Arrow-batched helpers. Built-in expressions do the same work faster and are
what the main queries use; these exist so a user porting UDF code has the
same entry points."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.functions.tokenize import NONWORD_REGEX


def register_nonword_tokens(spark: SparkSession, name: str = "nonword_tokens") -> str:
    """U4: the flat-map function as a SQL table function of the session,
    ``name(text) -> (word)``: lower-case, split on ASCII non-word characters,
    drop empty pieces. Its body is built-in expressions, so rows stay in the
    JVM.

    Spark plans a table function of a column as a join of the distinct values to
    the pieces of each, every piece beside its whole text. For the rows of a
    table use ``{name}_array(text) -> array<string>``, which is registered too,
    with ``LATERAL VIEW explode``: that stays in the row's task."""
    pattern = NONWORD_REGEX.replace("\\", "\\\\")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}_array(body STRING) RETURNS ARRAY<STRING>
        RETURN filter(split(lower(body), '{pattern}'), word -> word <> '')""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(body STRING) RETURNS TABLE (word STRING)
        RETURN SELECT word FROM explode(split(lower(body), '{pattern}')) AS t(word) WHERE word <> ''""")
    return name


def flat_map_batches(fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch | pa.Table]], schema: T.StructType | str):
    """A user's flat map as a table function. ``fn`` turns an Arrow batch
    of rows into any number of batches or tables of ``schema``; it is called in
    every task, batch by batch, so it must not rely on which rows come together.

    The result is called with a table argument, ``f(df.asTable())``, or
    registered and used in SQL: ``spark.udtf.register("f", f)``, then
    ``SELECT * FROM f(TABLE(t))``."""
    class FlatMap:
        def eval(self, batch: pa.RecordBatch):
            for out in fn(batch):
                yield out if isinstance(out, pa.Table) else pa.Table.from_batches([out])

    return F.arrow_udtf(FlatMap, returnType=schema)


def nonword_tokens_of(batch: pa.RecordBatch) -> Iterable[pa.Table]:
    """A flat map of one text column: its lower-case words between ASCII non-word characters."""
    import pyarrow.compute as pc

    words = pc.split_pattern_regex(pc.utf8_lower(batch.column(0)), NONWORD_REGEX).flatten()
    yield pa.table({"word": words.filter(pc.not_equal(words, ""))})


@F.pandas_udf(T.IntegerType())
def weekday_pudf(date_time: pd.Series) -> pd.Series:
    """Monday=0 weekday of a ``dd/MMM/yyyy:HH:mm:ss +zzzz`` text, in the
    text's own offset (the wall-clock date is what counts); NULL for a text
    whose date or time of day does not exist."""
    d = pd.to_datetime(date_time.str.slice(0, 20), format="%d/%b/%Y:%H:%M:%S", errors="coerce")
    return d.dt.weekday.astype("Int32")
