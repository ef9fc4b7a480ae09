"""Exact dedup and source mixing: odd rows, hot groups, plans without Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallgrass.llm import exact_dedup, mixing
from tallgrass.session import release


def normal(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def want_groups(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(normal(t), []).append(d)
    return {k: (max((d for d in v if d is not None), default=None), len(v)) for k, v in groups.items()}


ODD = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "Äb"), (6, "äb"), (7, "x" * 200_000), (7, "X" * 200_000), (None, "a b"),
       (None, "only nulls"), (None, "only nulls"), (8, " a b"), (9, "p" * 40 + "1"), (10, "P" * 40 + "2"), (11, "ẞ"), (12, "ß")]
HOT = [(k, "Hot text " * 5) for k in range(3000)] + [(5000 + k, f"text {k % 700}") for k in range(2000)]


@pytest.mark.parametrize("rows", [ODD, HOT, []])
def test_content_groups(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, salt string, kept int")
    got = exact_dedup.content_groups(df)
    assert got.columns == ["doc_id", "text", "salt", "keep_id", "group_size", "kept", "text_sha256"]
    got, want = got.collect(), want_groups(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[normal(r.text)]
        assert r.text_sha256 == hashlib.sha256(normal(r.text).encode()).hexdigest()
    kept = [r for r in got if r.kept]
    assert len(kept) == len(want) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.drop_copies(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, normal(r.text)) for r in left.collect()), key=repr) == sorted(((v[0], k) for k, v in want.items()), key=repr)


def test_repeated_hot_rows_keep_one(spark):
    df = spark.createDataFrame([(1, "same")] * 500 + [(2, f"t{k}") for k in range(300)], "doc_id long, text string")
    got = exact_dedup.drop_copies(df).collect()
    assert len(got) == 301 and sum(r.text == "same" for r in got) == 1


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def want_targets(sizes):
    """Excess handed on by weight, step by step, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, target, full = 1.5 * sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(2.0 * sizes[s] for s in full)
        mass = sum(weight[s] for s in order if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / mass for s in order}
        over = {s for s in order if target[s] > 2.0 * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, "c": 7, None: 30}, {"b": 1}, {"x": 0, "y": 9}, {"x": 0}, {},
                                   {f"s{k}": (k * 37) % 101 + 1 for k in range(30)}, {"a": 3, "á": 4, "Z": 5, "": 2, "𐍈": 9, "￿": 8}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(want_targets(sizes) if sizes else {})


def test_mix(spark):
    rnd = random.Random(3)
    rows = [(k, " ".join(["w"] * rnd.choice([1, 5, 40, 300])), rnd.choice(["a"] * 6 + ["b", "c", None])) for k in range(4000)]
    rows += [(None, "no id", "a"), (7, "twice", "b"), (7, "twice", "b"), (9000, None, "c"), (9001, "", "d")]
    df = spark.createDataFrame([(*r, 5, "t") for r in rows], "doc_id long, text string, source string, size int, target string")
    sized = df.select("doc_id", "source", mixing.word_count().alias("size"))
    got = mixing.systematic_copies(sized).collect()
    assert len(got) == len(rows) and {r.copies for r in got} <= {0, 1, 2}
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        target[r.source] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(400, 0.03 * t), (s, taken[s], t)
    out = mixing.mix(df)
    assert out.columns == df.columns
    have = sorted((r.doc_id, r.source) for r in out.filter("doc_id IS NOT NULL").collect() if r.source)
    assert have == sorted((r.doc_id, r.source) for r in got if r.source and r.doc_id is not None for _ in range(r.copies))
    assert sorted(map(repr, mixing.systematic_copies(sized.repartition(7)).collect())) == sorted(map(repr, got))
    assert mixing.mix(df.limit(0)).collect() == []


@pytest.mark.parametrize("text", [None, "", " ", "a", " a", "a ", "\x0ba\x0c\tb\n", "a b", "a\x1fb c\x85d", "  a  b  "])
def test_word_count(spark, text):
    df = spark.createDataFrame([(text,)], "text string").select(mixing.word_count().alias("n"))
    assert df.first().n == words(text)


def test_plans_run_no_python(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string").select(
        F.col("doc_id"), F.col("text"), F.col("source"))
    for out in (exact_dedup.content_groups(df), mixing.mix(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_repeated_hot_rows_are_cut_into_pieces(spark):
    """A third of all rows are one row, id included, and a third have no id: no sorting task gets them all."""
    rows = [(1, "same")] * 3000 + [(None, "nobody's")] * 3000 + [(k, f"text {k}") for k in range(10, 3010)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions are not merged
    try:
        got = exact_dedup.content_groups(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (path,) = [x.path for x in got._scratch]
    sorted_rows = spark.read.parquet(path)
    sizes = [r["count"] for r in sorted_rows.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 2999
    rows = got.collect()
    assert sum(r.kept for r in rows) == 3002
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id == 1} == {(1, 3000)}
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id is None} == {(None, 3000)}
    release(got)
