"""SimHash near-duplicates with pivot distance tables.

Every document gets a 64-bit fingerprint of its word shingles; only distinct
fingerprints are compared. A table holds each fingerprint's Hamming distances
to 21 reference fingerprints. Two fingerprints within ``max_bits`` of each
other have distances to any reference that differ by ``max_bits`` at most, so a
pair whose coordinates differ by more anywhere is discarded before it is
verified bit by bit.

The table alone would still have to look at all pairs. So pairs are only formed
between fingerprints that agree on three of ``max_bits + 3`` blocks of bits,
which any two within ``max_bits`` do. Where many fingerprints agree on the same
three blocks, the remaining bits are blocked once more in the same way. Both
steps are exact: no link is lost, none is capped.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import star_components
from ..operators.skew import join_unique
from ..session import release
from .common import borrowed, fresh, small_batches, written

#: References; seven 8-bit distances lie in one long. CROWD: fingerprints in a block before it is blocked again.
LANES, LONGS, CROWD = 7, 3, 64


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


PIVOTS = [signed(random.Random(f"pivot {k}").getrandbits(64)) for k in range(LANES * LONGS)]


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit fingerprint of a text's shingles, repeats included.

    A-Z are lower-cased and words are runs of anything but ASCII white space.
    Fewer words than a shingle form one; no words give zero.
    """
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b - 1], 42) for a, b in zip(starts, ends[shingle - 1:])]  # noqa: B905
                 or [digest(line, 42)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 4096):
        part = h[k:k + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(part, axis=1, bitorder="little"), axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp",
                     keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if none are named) and ``out``: each text's fingerprint as a long."""
    small_batches(df.sparkSession)
    keep = [c for c in (keep or df.columns) if c.lower() != out.lower()]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(len(keep)).cast(pa.binary()).to_pylist()
            fp = pa.array([fingerprint(t, shingle) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fp], names=[*keep, out])

    (body,) = fresh(df, "body")
    return df.select(*keep, F.col(text).alias(body)).mapInArrow(run, schema)


def pivot_table(fp: Column) -> list[Column]:
    """The distances to all references, seven to a long."""
    out = []
    for k in range(LONGS):
        lanes = [F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long"), 8 * j)
                 for j, p in enumerate(PIVOTS[LANES * k:LANES * (k + 1)])]
        total = lanes[0]
        for x in lanes[1:]:
            total = total.bitwiseOR(x)
        out.append(total)
    return out


def close_by(a: Column, b: Column, most: int) -> Column:
    """No two of seven distances differ by more than ``most``: with a guard bit
    above each distance, the guard survives a subtraction where the first is
    not the smaller one."""
    guard, slack = F.lit(sum(0x80 << 8 * j for j in range(LANES))), F.lit(sum(most << 8 * j for j in range(LANES)))
    up, down = (a + slack).bitwiseOR(guard) - b, (b + slack).bitwiseOR(guard) - a
    return up.bitwiseAND(down).bitwiseAND(guard) == guard


def block_masks(bits: list[int], blocks: int, agree: int) -> list[int]:
    """Masks of every choice of ``agree`` out of ``blocks`` blocks of some bit positions."""
    cut = [bits[k * len(bits) // blocks:(k + 1) * len(bits) // blocks] for k in range(blocks)]
    return [sum(1 << b for block in chosen for b in block) for chosen in itertools.combinations(cut, agree)]


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints ``fp`` that differ in 1 to ``max_bits`` bits."""
    coarse = block_masks(list(range(64)), max_bits + 3, 3)
    fine = [[m | s for s in block_masks([b for b in range(64) if not m >> b & 1], max_bits + 4, 4)] for m in coarse]
    keyed = distinct.select("fp", F.inline(F.array(*[
        F.struct(F.lit(k).alias("m"), F.col("fp").bitwiseAND(F.lit(signed(x))).alias("key")) for k, x in enumerate(coarse)])))
    crowds = keyed.groupBy("m", "key").agg(F.count("*").alias("n")).filter("n > 1")
    masks = F.when(F.col("n") > CROWD, F.array(*[F.array(*[F.lit(signed(x)) for x in row]) for row in fine])[F.col("m")]) \
        .otherwise(F.array(F.array(*[F.lit(signed(x)) for x in coarse])[F.col("m")]))
    place = (keyed.join(crowds, ["m", "key"]).select("fp", F.explode(masks).alias("mask"))
             .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"),
                     *[p.alias(f"p{k}") for k, p in enumerate(pivot_table(F.col("fp")))]))
    place = written(place, "pivot-table")
    x, y = place.alias("x"), place.alias("y")
    near = (F.col("x.mask") == F.col("y.mask")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
    for k in range(LONGS):
        near &= close_by(F.col(f"x.p{k}"), F.col(f"y.p{k}"), max_bits)
    near &= F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits
    return borrowed(x.join(y, near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct(), place)


def groups(rows: DataFrame, max_bits: int, id_col: str = "doc_id", fp: str = "fp") -> DataFrame:
    """``fp`` and ``root`` (the smallest fingerprint that it reaches) and
    ``component_id`` (the smallest id of any row it reaches; null if all are
    null) for each distinct fingerprint of ``rows``. A component that holds a
    third of all fingerprints is joined to its id in pieces."""
    distinct = written(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("first_id")), "fingerprints")
    near = links(distinct, max_bits)
    reached = star_components(near, "a", "b")
    release(near)
    rooted = written(distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")), "rooted")
    release(distinct, reached)
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return borrowed(join_unique(rooted, first, "root").select("fp", "root", "component_id"), rooted)


def near_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``fingerprint`` (16 lower-case
    hex digits) and ``component_id``, the smallest id that links of at most
    ``max_bits`` bits reach.

    Null and blank texts have fingerprint zero and link like any other; rows
    with a null id take part, but do not name a component. Repeated rows stay.
    A fingerprint that a third of all rows share is joined in pieces. An empty
    table gives an empty result. ``release`` of the result deletes its tables.
    """
    rows = written(with_fingerprint(df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")),
                                    shingle=shingle, keep=["doc_id"]), "row-fingerprints")
    found = groups(rows, max_bits)
    return borrowed(join_unique(rows, found.select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"), rows, found)


def drop_near_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3,
                         max_bits: int = 2) -> DataFrame:
    """``df`` with one row of each component: the one with the smallest id (null
    last; of repeated ids any one row). Null and empty texts are one group. All
    columns are handed through; an empty table gives an empty result."""
    fp, row = fresh(df, "fp", "row")
    rows = written(with_fingerprint(df, text, shingle, fp).withColumn(row, F.monotonically_increasing_id()), "row-fingerprints")
    slim = rows.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    found = groups(slim, max_bits, "id")
    stay = (slim.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row")).alias("best"))
            .join(found.select("fp", "root"), "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row)))
    return borrowed(rows.join(stay, row, "left_semi").select(*df.columns), rows, found)
