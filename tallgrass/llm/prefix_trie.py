"""Prefix trie of conversations by truncation peeling.

A conversation is a sequence of turns, a turn its content address and word
count; a prefix is known by a digest chained over its turns. Work starts at the
greatest depth. The sequences that end there are nodes; their last turns are cut
off, the sequences that end further up join them, and equal ones are grouped:
those are the nodes above, and what their children brought along -- members,
leaves, tokens -- is summed while they are found. A round cuts off ``height``
turns: it groups the prefixes of these depths, sums up inside them, and hands
what is left to the next round, which meets it as one sequence a node. So each
node is met in one round, and a conversation of hundreds of turns costs some
dozen rounds. Every round reads and writes tables of its own depths only.

Equal whole conversations are merged before the first round, and sums are
partial before each shuffle, so neither a copy in a third of all conversations
nor a common first turn fills a task. The way back from a parent to its children
is one join in the end, in pieces for parents of many children.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, join_unique, ranked
from ..session import release
from .common import borrowed, owning, shared_path, written
from .mixing import word_count

#: Ids in a page of a node's member list.
PAGE = 4096
#: Turns that a round cuts off.
HEIGHT = 32
NODES = ("key binary, up binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string")
EMPTY = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id`` and ``path``: each conversation's turns in order, as structs
    of ``id`` (a digest of role and text) and ``words``.

    Turns ascend, null first; equal turns by role and digest. Null roles and
    texts are empty. Rows without a conversation id belong to none and are left
    out. Texts are digested before the shuffle, so a conversation's row holds
    some fifty bytes a turn.
    """
    speaker, body = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(speaker).cast("string"), F.lit(":"), speaker, body), 256))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), speaker.alias("role"), digest.alias("id"),
        word_count(text).alias("words"))
    # Null sorts before any value inside a struct.
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "id", "words")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("path"))


def rebuilt(paths: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose start comes from the first of their ``every``
    neighbours: the first h turns of conversation ``c - c % every`` (all, if it
    has fewer; none, if there is no such conversation), then its own turns after
    its first h, where h is the CRC-32 of its decimal id modulo ``most``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = paths.select("conv_id", "path", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    starts = paths.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("path", 1, most - 1).alias("start"))
    none = F.array().cast(paths.schema["path"].dataType)
    return own.join(starts, "base", "left").select("conv_id", F.concat(
        F.coalesce(F.slice("start", F.lit(1), F.col("h")), none),
        F.slice("path", F.col("h") + 1, F.greatest(F.size("path"), F.lit(1)))).alias("path"))


def id_list_hashes(members: DataFrame) -> DataFrame:
    """``whole`` and ``ends_sha256``: the SHA-256 of the decimal ids of each
    ``whole``, ascending and joined by commas. ``members`` has both columns.

    Ids are ranked by a range-partitioned sort and written out in pages of
    ``PAGE``. One page is hashed as it is. The pages of a longer list go through
    one running hash, in order: a page at a time in memory, however many ids.
    """
    rows = ranked(members.withColumn("n", F.lit(1).cast("long")), "whole", [F.col("conv_id")], "n", "rank", "size", "trie-ids")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    pages = written(rows.groupBy("whole", F.floor(F.col("rank") / PAGE).alias("page"), "size").agg(ids.alias("ids")), "trie-pages")
    release(rows)
    short = pages.where(F.col("size") <= PAGE).select("whole", F.sha2("ids", 256).alias("ends_sha256"))
    long = pages.where(F.col("size") > PAGE).select("whole", "page", "ids").repartition("whole").sortWithinPartitions("whole", "page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, sha = None, hashlib.sha256()
        for batch in batches:
            for w, page, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if page == 0:
                    if whole is not None:
                        yield pa.RecordBatch.from_pydict({"whole": [whole], "ends_sha256": [sha.hexdigest()]})
                    whole, sha = w, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
        if whole is not None:
            yield pa.RecordBatch.from_pydict({"whole": [whole], "ends_sha256": [sha.hexdigest()]})

    return borrowed(short.unionByName(long.mapInArrow(run, "whole binary, ends_sha256 string")), pages)


def chained(path: str = "path") -> Column:
    """The prefixes of a path, the empty one first: structs of ``id`` and the ``words`` of the last turn."""
    root = F.array(F.struct(F.unhex(F.lit("")).alias("id"), F.lit(0).cast("long").alias("words")))

    def longer(prefixes: Column, t: Column) -> Column:
        digest = F.sha2(F.concat(F.element_at(prefixes, -1)["id"], t["id"]), 256)
        return F.concat(prefixes, F.array(F.struct(F.unhex(digest).alias("id"), t["words"].alias("words"))))

    return F.aggregate(path, root, longer)


def trie(paths: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The nodes of the trie over ``paths`` (``conv_id``, one row each, and
    ``path``), one row per distinct sequence of first turns:

    * ``conv_id``, the smallest conversation that starts with it, and ``depth``;
      together they name the node; ``parent_conv_id`` (null for the root);
    * ``n_convs`` that start with it, ``n_children``, and ``n_leaves``, the
      childless nodes of its subtree, itself included;
    * ``saved_tokens``: over its subtree, each node's words in its last turn times
      its conversations but one;
    * ``ends_sha256``: SHA-256 of the ids of the conversations that end there.

    A conversation without turns ends at the root. Without conversations there
    are no nodes. ``height`` turns are cut off in a round; the result does not
    depend on it. ``release`` of the result deletes its table.
    """
    spark = paths.sparkSession
    whole = F.element_at("path", -1)["id"]
    convs = written(paths.select("conv_id", chained().alias("path")).withColumn("whole", whole), "trie-convs")
    hashes = id_list_hashes(convs.select("whole", "conv_id"))
    groups = convs.groupBy("whole", "path").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    # The root is level 1. A round reads the folders of its own levels only.
    ended = written(groups.join(hashes, "whole").select("path", "conv_id", "n_convs", "ends_sha256", F.size("path").alias("level")),
                    "trie-ended", by="level")
    release(convs, hashes)
    out, below = shared_path(spark, "trie-nodes"), None
    spark.createDataFrame([], NODES).write.parquet(out)
    top = ended.agg(F.max("level")).first()[0] or 0
    while top > 0:
        base = max(0, top - height)
        below = cut_off(ended.where((F.col("level") > base) & (F.col("level") <= top)), below, base, out)
        top = base
    release(ended)
    nodes = owning(spark.read.schema(NODES).parquet(out), out)
    # Each parent's row says how many children it has: no counting pass.
    hot = hot_keys(nodes.select("key", "n_children"), "key", "n_children")
    parents = nodes.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    named = join_unique(nodes, parents, "up", "left", hot)
    return borrowed(named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                 F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")), nodes)


def cut_off(ended: DataFrame, below: DataFrame | None, base: int, out: str) -> DataFrame | None:
    """One round: append the nodes of the levels above ``base`` to ``out``;
    returns the nodes that are left at level ``base``, as sequences.

    ``ended`` are sequences that end in these levels, ``below`` those that the
    round before left at the last of them, with the children, leaves and saved
    tokens that lie under them.
    """
    zero, none = F.lit(0).cast("long"), F.lit(None)
    found = ended.select("path", "conv_id", "n_convs", "ends_sha256", zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"))
    if below is not None:
        found = found.unionByName(below.select("path", "conv_id", "n_convs", none.cast("string").alias("ends_sha256"), "kids", "leaves", "saved"))
    last = F.col("k") == F.size("path")
    ids = F.transform(F.slice("path", F.lit(base + 1), F.col("k") - base), lambda p: p["id"])

    def at_end(c: str) -> Column:
        return F.sum(F.when(last, F.col(c)).otherwise(zero)).alias(c)

    levels = found.withColumn("k", F.explode(F.sequence(F.lit(base + 1), F.size("path"))))
    nodes = written(levels.groupBy(
        "k", ids.alias("line"), F.get("path", F.col("k") - 1)["words"].alias("words"), F.get("path", F.col("k") - 2)["id"].alias("up"),
        F.when(F.col("k") == base + 1, F.slice("path", 1, base)).alias("rest")).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), at_end("kids"), at_end("leaves"), at_end("saved"),
        F.max(F.when(last, F.col("ends_sha256"))).alias("ends_sha256")).withColumn("key", F.element_at("line", -1)), "trie-round")
    kids = nodes.where(F.col("k") > base + 1).groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    n_children = F.col("kids") + F.coalesce("more", zero)
    full = written(nodes.join(kids, "key", "left").withColumn("kids", n_children).drop("more").withColumns({
        "leaves": F.col("leaves") + (F.col("kids") == 0).cast("long"),
        "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("words")}), "trie-round")
    # What a node has goes to itself and to all nodes above it in these levels.
    sums = (full.where("leaves > 0 OR saved > 0").select(F.explode("line").alias("key"), "leaves", "saved")
            .groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    done = full.join(sums, "key")
    done.select("key", "up", "conv_id", (F.col("k") - 1).cast("long").alias("depth"), "n_convs", F.col("kids").alias("n_children"),
                "n_leaves", "saved_tokens", "ends_sha256").write.mode("append").parquet(out)
    left = done.where(F.col("k") == base + 1).groupBy(F.col("rest").alias("path")).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.count(F.lit(1)).alias("kids"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    left = written(left, "trie-left") if base else None
    release(nodes, full, *([below] if below is not None else []))
    return left
