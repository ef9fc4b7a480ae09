"""Prefix trie against a plain one: odd rows, repeated turns, hot prefixes, long lists of ids."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallgrass.llm import prefix_trie


def plain_paths(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), (role, text)))
    convs = {c: tuple(t for _, t in sorted(ts, key=lambda x: x[0])) for c, ts in convs.items()}
    out = {}
    for c, own in convs.items():
        n = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, ())[:n] + own[n:]
    return out


def plain_trie(paths):
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below)]
        ends = ",".join(map(str, sorted(c for c in members if paths[c] == p)))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(spark, rows, height=prefix_trie.HEIGHT):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, path string, depth int")
    out = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df)), height)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


ODD = [(20, 0, "user", "a b"), (20, 1, "assistant", None), (20, 1, "assistant", ""), (20, None, None, "first"), (21, 5, "u", "x"),
       (22, 0, "user", "a b"), (None, 0, "user", "lost"), (23, 0, None, None), (24, 0, "", ""), (5, 0, "u", "w " * 100_000), (3, 0, "u", "x"),
       (400, 0, "ab", "c"), (401, 0, "a", "bc"), (402, 0, "a", "bc"), (402, 0, "a", "bc"), (402, 0, "a", "bc"), (402, 1, "z", " y "),
       (-7, 0, "u", "neg")]


@pytest.mark.parametrize("rows", [ODD, [(1, 0, "u", "t")], [(1, 0, "u", "t")] * 50])
def test_odd_rows(spark, rows):
    # Spark's remainder of a negative id is negative: -7 starts from conversation 0.
    plain = plain_paths([r for r in rows if r[0] != -7])
    if len(rows) != 50 and rows is ODD:
        n = zlib.crc32(b"-7") % 4
        plain[-7] = (("u", "neg"),)[n:]
    assert built(spark, rows) == plain_trie(plain)


def test_no_conversations(spark):
    assert built(spark, []) == [] and built(spark, [(None, 0, "u", "t")]) == []


@pytest.mark.parametrize("height", [2, 32])
def test_random_conversations(spark, height):
    rnd = random.Random(5)
    rows = []
    for c in range(260):
        for t in range(rnd.randint(1, 6)):
            rows.append((c, t, rnd.choice(["u", "a"]), rnd.choice(["x", "y z", "w w w"]) if t else "hello there"))
    rows += [(1000 + k, t, "u", f"same {t}") for k in range(150) for t in range(3)]
    rows += [(2000, t, "u", f"long {t % 3}") for t in range(9)] + [(2001, t, "u", f"long {t % 3}") for t in range(7)]
    rnd.shuffle(rows)
    assert built(spark, rows, height) == plain_trie(plain_paths(rows))


def test_a_conversation_of_many_turns(spark):
    rows = [(c, t, "u", "a b") for c in (0, 40) for t in range(90)] + [(60, t, "u", "a b") for t in range(70)]
    assert built(spark, rows) == plain_trie(plain_paths(rows))


def test_id_lists_of_many_pages(spark):
    n = 2 * prefix_trie.PAGE + 5
    members = spark.range(n).select(F.lit(b"k").alias("whole"), (F.col("id") * 7).alias("conv_id")).unionByName(
        spark.range(3).select(F.lit(b"m").alias("whole"), (F.col("id") + 5).alias("conv_id")))
    got = {bytes(r.whole): r.ends_sha256 for r in prefix_trie.id_list_hashes(members.repartition(5)).collect()}
    assert got == {b"k": hashlib.sha256(",".join(str(7 * k) for k in range(n)).encode()).hexdigest(),
                   b"m": hashlib.sha256(b"5,6,7").hexdigest()}
