"""Merkle manifest against a plain tree: odd rows, sizes around the block bounds, repeated rows, tampering."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tallgrass.llm import merkle
from tallgrass.llm.common import ascii_lower


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(nodes):
    """Root, and for each node its siblings as (left, right) up to the root."""
    paths, spot = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
        for p, at in enumerate(spot):
            run, i = runs[at // 16], at % 16
            paths[p].append(("".join(run[:i]), "".join(run[i + 1:])))
            spot[p] = at // 16
        nodes = [h(*r) for r in runs]
    return nodes[0], paths


def plain_manifest(rows):
    """rows: (doc_id, source, text)"""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], plain_leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(groups[s], key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        trees[s] = (members, *plain_tree([m[1] for m in members]))
    root, above = plain_tree([trees[s][1] for s in order])
    out = []
    for s, up in zip(order, above, strict=True):
        members, sub, paths = trees[s]
        out += [(m[0], m[1], sub, root, [*p, *up]) for m, p in zip(members, paths, strict=True)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows],
                                 "doc_id long, source string, text string, leaf string, size int, path string")


def check(spark, rows):
    got = merkle.manifest(frame(spark, rows), ["doc_id", "source", "text"])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path"]
    have = [(r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path]) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(plain_manifest(rows), key=repr)
    assert got.where(merkle.folded(F.col("leaf")) != F.col("root")).count() == 0


ODD = [(1, "a", "x"), (2, "a", None), (3, "a", ""), (None, "a", "x"), (None, "a", "x"), (None, None, None), (4, None, "n"), (5, "", "e"),
       (6, "Z", "z" * 300_000), (6, "Z", "again"), (6, "Z", "again"), (7, "é", "ü"), (8, "𐍈", "8"), (9, "￿", "9"), (10, "n", "n")]


@pytest.mark.parametrize("rows", [ODD, [(1, "a", "only")], [(1, None, None)], [(5, "a", "same")] * 700])
def test_odd_rows(spark, rows):
    check(spark, rows)


def test_sizes_around_runs_and_blocks(spark):
    sizes = {"a": 1, "b": 15, "c": 16, "d": 17, "e": 255, "f": 256, "g": 257, "h": 272, "i": 4097}
    rows = [(1000 * k + i, s, f"{s}{i}") for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    check(spark, rows + [(9, "b", "copy")] * 400)


def test_many_groups(spark):
    check(spark, [(k, f"s{k % 300}", f"t{k}") for k in range(900)])


def test_empty_table(spark):
    assert merkle.manifest(frame(spark, [(1, "a", "x")]).limit(0), ["doc_id", "text"]).collect() == []


def test_tampering_shows(spark):
    rows = [(k, "a" if k % 3 else "b", f"Text {k}" if k % 2 else f"text {k}") for k in range(500)]
    df = frame(spark, rows).select("doc_id", "source", "text")
    seen = merkle.leaf([F.col("doc_id"), F.col("source"), ascii_lower(F.col("text"))])
    out = merkle.manifest(df, ["doc_id", "source", "text"], held={"seen": seen})
    got = out.select("doc_id", merkle.folded(F.col("seen")).alias("folded"), "root", merkle.proof().alias("proof")).collect()
    want = {d: (root, h(*[x for s in path for x in s])) for d, _, _, root, path in plain_manifest(rows)}
    assert len(got) == 500 and all((r.root, r.proof) == want[r.doc_id] for r in got)
    assert all((r.folded == r.root) == (r.doc_id % 2 == 0) for r in got)
