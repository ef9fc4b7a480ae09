"""SimHash: fingerprints, links, components and groups against brute force."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from tallgrass.llm import simhash
from tallgrass.operators.graph import star_components


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def clustered(seed, centres=40, per=30, spread=4, free=None):
    rnd = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = rnd.getrandbits(64)
        for _ in range(per):
            x = c
            for _ in range(rnd.randint(0, spread)):
                x ^= 1 << rnd.choice(free or range(64))
            out.add(simhash.signed(x))
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", " \n\t ", "One", "one TWO", "ÄB c d", "x y z " * 3000, "a  b\x0bc\x00d\x85e f"])
def test_fingerprint_of_odd_texts(text):
    got = simhash.fingerprint(text.encode() if text is not None else None, 3)
    assert got % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("rows", [clustered(1), clustered(2, 3, 600, 5, [1, 2, 3, 5, 8, 13, 21, 34, 55, 60, 61, 62, 63]),
                                  clustered(3, 300, 3, 3), [0, 1, 3, 7, -1]])
def test_links_are_all_pairs_within_two_bits(spark, rows):
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in rows], "fp long"), 2).collect()}
    want = {(a, b) for i, a in enumerate(rows) for b in rows[i + 1:] if ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert got == want and (want or len(rows) < 3)


def test_pivot_filter_never_drops_a_near_pair(spark):
    rnd = random.Random(5)
    pairs = []
    for _ in range(500):
        a = rnd.getrandbits(64)
        b = a
        for _ in range(rnd.choice([0, 1, 2, 2, 5, 20])):
            b ^= 1 << rnd.randrange(64)
        pairs.append((simhash.signed(a), simhash.signed(b)))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(pairs, "a long, b long")
    ok = F.lit(True)
    for x, y in zip(simhash.pivot_table(F.col("a")), simhash.pivot_table(F.col("b")), strict=True):
        ok &= simhash.close_by(x, y, 2)
    for a, b, got in df.select("a", "b", ok).collect():
        far = max(abs(((a ^ p) % 2**64).bit_count() - ((b ^ p) % 2**64).bit_count()) for p in simhash.PIVOTS)
        assert got == (far <= 2)


def test_components(spark):
    rnd = random.Random(7)
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 80)] \
        + [(rnd.randrange(2000, 2200), rnd.randrange(2000, 2200)) for _ in range(120)] + [(5, 5), (None, 3), (61, 60)]
    got = {r.node: r.component for r in star_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == roots({x for e in real for x in e}, real)
    assert star_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")


BASE = " ".join(f"w{k}" for k in range(400))
ROWS = [(1, None, "a", 1), (2, "", "b", 2), (3, " \n", "c", 3), (9, BASE, "d", 4), (8, BASE.upper(), "e", 5),
        (8, BASE, "e", 5), (7, BASE + " tail", "f", 6), (6, "quite other words here", "g", 7), (None, BASE, "h", 8),
        (None, "alone with no id at all", "i", 9), (5, "long " * 20000, "j", 10)]


def test_near_duplicates_against_brute_force(spark):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in
                  simhash.near_duplicates(documents(spark, ROWS)).collect()), key=repr)
    fps = [plain_fingerprint(t) for _, t, _, _ in ROWS]
    names = roots(set(fps), [(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 2])
    first = {}
    for (d, *_), f in zip(ROWS, fps, strict=True):
        if d is not None:
            first[names[f]] = min(first.get(names[f], d), d)
    assert got == sorted(((d, f"{f:016x}", first.get(names[f])) for (d, *_), f in zip(ROWS, fps, strict=True)), key=repr)


def test_one_document_of_each_group_stays(spark):
    got = simhash.drop_near_duplicates(documents(spark, ROWS))
    assert got.columns == ["doc_id", "text", "fp", "component_id"]
    fps = [plain_fingerprint(t) for _, t, _, _ in ROWS]
    names = roots(set(fps), [(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 2])
    want = {}
    for (d, *_), f in zip(ROWS, fps, strict=True):
        want.setdefault(names[f], []).append(d)
    smallest = sorted((min((d for d in ds if d is not None), default=None) for ds in want.values()), key=repr)
    assert sorted((r.doc_id for r in got.collect()), key=repr) == smallest


def test_empty_table(spark):
    empty = documents(spark, [])
    assert simhash.near_duplicates(empty).collect() == [] and simhash.drop_near_duplicates(empty).collect() == []
