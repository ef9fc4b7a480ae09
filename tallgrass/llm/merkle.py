"""Merkle manifests of a dataset: one root over everything, a proof per row.

Rows of a group stand in a fixed order; their digests are level 0 of the
group's tree. Every ``FAN`` neighbours of a level are hashed to one node of the
next, the last run with what is left, until one node remains. The groups' roots
are the leaves of one more tree, whose root stands for the whole dataset.

A tree is built in aligned blocks of ``FAN ** 2`` nodes. A block keeps its level
as one hex string: parents are the hashes of its fixed-width substrings, and the
siblings of a node are the two substrings beside it in its run. A block comes to
one node, and the blocks' nodes are the leaves of the next stage, so a group of
any size is some ``log`` of stages of bounded rows. On the way down each block
gets the path of its own node from the stage above, and hands it on with two
levels added.

A digest is the lower-case hex SHA-256 of the concatenated inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import ranked
from ..session import release
from .common import written

#: Nodes in a run, characters of a digest.
FAN, WIDTH = 16, 64
BLOCK, RUN = FAN ** 2, FAN * WIDTH
NO_PATH = "array<struct<left:string,right:string>>"


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: of each field ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def cut(level: str, at: Column, n: int) -> Column:
    """``n`` digests of a level from place ``at`` on."""
    return F.substr(F.col(level), at * WIDTH + 1, F.lit(n * WIDTH))


def blocks(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """Blocks of ``nodes`` (``key, rank, size, copies, digest`` and the columns
    ``keep``): ``key, size, block``, ``members`` (place in the block, number of
    equal nodes, ``keep``), the strings ``level0`` and ``level1``, and ``top``."""
    first, last = F.col("block") * BLOCK, (F.col("block") + 1) * BLOCK
    start = F.greatest("rank", first)
    spread = nodes.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("rank") / BLOCK), F.floor((F.col("rank") + F.col("copies") - 1) / BLOCK))))
    member = F.struct((start - first).cast("int").alias("place"),
                      (F.least(F.col("rank") + F.col("copies"), last) - start).cast("int").alias("copies"), "digest", *keep)
    grouped = spread.groupBy("key", "size", "block").agg(F.array_sort(F.collect_list(member)).alias("m"))
    level0 = F.array_join(F.transform("m", lambda x: F.repeat(x["digest"], x["copies"])), "")
    runs = F.sequence(F.lit(0), F.ceil(F.length("level0") / RUN).cast("int") - 1)
    level1 = F.array_join(F.transform(runs, lambda k: F.sha2(F.substr(F.col("level0"), k * RUN + 1, F.lit(RUN)), 256)), "")
    slim = F.transform("m", lambda x: F.struct(*[x[c].alias(c) for c in ("place", "copies", *keep)]))
    return (grouped.select("key", "size", "block", slim.alias("members"), level0.alias("level0"))
            .withColumn("level1", F.when(F.col("size") > 1, level1))
            .withColumn("top", F.when(F.col("size") == 1, F.col("level0")).when(F.col("size") <= FAN, F.col("level1"))
                        .otherwise(F.sha2("level1", 256))))


@dataclass(frozen=True)
class Trees:
    """One tree per key: the block tables of each stage, leaves first."""
    stages: list[DataFrame]
    keep: list[str]

    def roots(self) -> DataFrame:
        """``key`` and ``root``."""
        return self.stages[-1].select("key", F.col("top").alias("root"))

    def paths(self, above: DataFrame) -> DataFrame:
        """One row per leaf: ``key``, ``keep``, ``leaf`` and its ``path``, from
        its own run up, followed by the path that ``above`` has for its key. The
        other columns of ``above`` (one row per key) are handed down."""
        handed = [c for c in above.columns if c not in ("key", "path")]
        way = above.withColumn("block", F.lit(0).cast("long"))
        for k in range(len(self.stages) - 1, -1, -1):
            keep = self.keep if k == 0 else []
            rows = self.stages[k].join(way, ["key", "block"]).select(
                "key", "size", "block", "level0", "level1", "path", *handed, F.inline("members")).select(
                "key", "size", "block", "level0", "level1", "path", *handed, *keep,
                F.explode(F.sequence("place", F.col("place") + F.col("copies") - 1)).alias("i"))
            run, i, j = (F.col("i") / FAN).cast("int"), F.col("i") % FAN, (F.col("i") / FAN).cast("int")
            rows = rows.withColumn("run", cut("level0", run * FAN, FAN))

            def sides(level: str, at: Column) -> Column:
                return F.struct(F.substr(F.col(level), F.lit(1), at * WIDTH).alias("left"),
                                F.substr(F.col(level), (at + 1) * WIDTH + 1, F.lit(RUN)).alias("right"))

            own = F.when(F.col("size") == 1, F.array().cast(NO_PATH)).when(
                F.col("size") <= FAN, F.array(sides("run", i))).otherwise(F.array(sides("run", i), sides("level1", j)))
            path = F.concat(own, F.col("path")).alias("path")
            if k:
                way = rows.select("key", (F.col("block") * BLOCK + F.col("i")).alias("block"), path, *handed)
            else:
                way = rows.select("key", *keep, cut("level0", F.col("i"), 1).alias("leaf"), path, *handed)
        return way

    def release(self) -> None:
        release(*self.stages)


def trees(rows: DataFrame, order: list[str], keep: list[str]) -> Trees:
    """The trees of ``rows`` (``key``, ``digest``, ``copies``, and ``order`` and
    ``keep``, column names of their own): leaves by ``order`` (null first), equal
    places by digest. A row stands for ``copies`` equal leaves."""
    by = [F.col(c).asc_nulls_first() for c in order] + [F.col("digest")]
    nodes, made = ranked(rows, "key", by, "copies", "rank", "size", "merkle-order"), []
    while True:
        made.append(written(blocks(nodes, [] if made else keep), "merkle-blocks"))
        release(nodes)
        if (made[-1].agg(F.max("size")).first()[0] or 0) <= BLOCK:
            return Trees(made, keep)
        nodes = made[-1].select("key", F.col("block").alias("rank"), F.ceil(F.col("size") / BLOCK).alias("size"),
                                F.lit(1).cast("long").alias("copies"), F.col("top").alias("digest"))


def manifest(df: DataFrame, fields: list[str], group: str = "source", id_col: str = "doc_id",
             held: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``df``: the id, ``leaf``, ``subroot`` (of its group),
    ``root``, ``path`` (the siblings left and right of its node on each level up
    to the root), and the columns ``held`` (expressions over ``df`` that its id
    and ``fields`` determine, such as the leaf of a second copy of the row).

    ``fields`` make the leaf. Leaves of a group ascend by id, null ids first,
    repeated ids by digest; rows equal in id and leaf are counted once and stand
    next to each other, so that a row repeated without end fills blocks, not a
    task. The null group comes first, then groups by their UTF-8 bytes. Null
    fields and empty or very long texts make leaves like any other. An empty
    table gives an empty result. ``df`` may have any other columns. ``release``
    of the result deletes its tables when nothing reads it any more.
    """
    held = held or {}
    names = [f"held{k}" for k in range(len(held))]
    key = F.coalesce(F.concat(F.lit("s"), F.col(group)), F.lit("n"))
    rows = df.select(key.alias("key"), F.col(id_col).alias("id"), leaf([F.col(c) for c in fields]).alias("digest"),
                     *[e.alias(n) for n, e in zip(names, held.values(), strict=True)])
    # A row that is held twice is equal in all columns; partial sums come before the shuffle.
    leaves = written(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "merkle-leaves")
    of_group = trees(leaves, ["id"], ["id", *names])
    roots = written(of_group.roots().select(F.lit("").alias("key"), F.col("key").alias("member"), F.col("root").alias("digest"),
                                            F.lit(1).cast("long").alias("copies")), "merkle-subroots")
    of_all = trees(roots, ["member"], ["member"])
    start = of_all.roots().select("key", "root", F.array().cast(NO_PATH).alias("path"))
    above = written(of_all.paths(start).select(F.col("member").alias("key"), F.col("leaf").alias("subroot"), "root", "path"),
                    "merkle-above")
    out = of_group.paths(above).select(F.col("id").alias(id_col), "leaf", "subroot", "root", "path",
                                       *[F.col(n).alias(c) for n, c in zip(names, held, strict=True)])
    release(leaves, roots)
    of_all.release()
    return out


def proof(path: str = "path") -> Column:
    """The digest of all siblings of a path, from the leaf's run to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf_col: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings come to."""
    return F.aggregate(path, leaf_col, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
