"""Every query against its SQL, and the pipeline against a plain version."""

from __future__ import annotations

import os
import sys
import zlib

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from oracle_check import canon, duck  # noqa: E402
from test_native import normal, want_targets, words  # noqa: E402
from test_simhash import plain_fingerprint, roots  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallgrass.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    out = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in out.collect()]
    if name in queries.ORACLES:
        cur = duck(SF).execute(queries.ORACLES[name])
        assert canon(out.columns, rows, False) == canon([c[0] for c in cur.description], cur.fetchall(), False)
    else:
        assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_with_odd_rows(spark):
    """Null and empty texts, repeated rows, null ids and languages, a column that clashes, and no rows at all."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = [r.text for r in docs.limit(30).collect()]
    rows = [(k, t, "en", "s1", len(t)) for k, t in enumerate(good)]
    rows += [(3, good[3], "en", "s1", 1)] * 3 + [(None, good[4] + " more", None, None, None), (900, None, None, "s2", None),
                                                  (901, "", "en", None, 0), (902, " \n ", "en", "s2", 3), (903, "long " * 100_000, "en", "s2", 5)]
    odd = spark.createDataFrame(rows, docs.schema).withColumn("row", F.lit("mine")).withColumn("_fp", F.lit(1))
    for frame in (odd, odd.limit(0)):
        now = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, SF)
            kept = out.collect()
            if name != "SentencePiece":
                assert out.columns == odd.columns
                assert {(r.doc_id, r.text) for r in kept} <= {(r[0], r[1]) for r in rows}
                now = spark.createDataFrame(kept, odd.schema)
            else:
                assert len(kept) == now.count() and all(r.n_tokens == len(r.ids) for r in kept)
            if name == "exact dedup":
                assert len({normal(r.text) for r in kept}) == len(kept)


def test_sentencepiece_columns(spark):
    import hashlib

    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op3_sentencepiece"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = sp.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("name, m, part", [("op5_language", 4, 2), ("op7_quality", 5, 0), ("op9_toxicity", 5, 0)])
def test_held_out(spark, name, m, part):
    rows = queries.QUERIES[name](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % m == part) for r in rows)
    assert {r.held_out for r in rows} == {True, False}


def test_pipeline_stage_by_stage(spark):
    import public_tokenizers
    import sentencepiece

    from tallgrass.llm.common import table, written

    docs = table(spark, SF, "documents")
    before, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = written(stage(spark, before, SF), "test-stage")
        if name != "SentencePiece":
            assert kept[name].columns == docs.columns
        before = kept[name]
    rows = {n: [(r.doc_id, r.text, r.source) for r in kept[n].collect()] for n in kept if n != "SentencePiece"}
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op7_quality"](spark, SF).collect()}
    first = rows["quality classifier"]
    assert sorted(r[0] for r in first) == sorted(d for d, p in scores.items() if p)
    best = {}
    for d, t, _ in first:
        best[normal(t)] = max(best.get(normal(t), d), d)
    assert sorted(r[0] for r in rows["exact dedup"]) == sorted(best.values())
    fps = {d: plain_fingerprint(t) for d, t, _ in rows["exact dedup"]}
    some = sorted(set(fps.values()))
    group = roots(some, [(a, b) for k, a in enumerate(some) for b in some[k + 1:] if (a ^ b).bit_count() <= 2])
    stay = {}
    for d, f in fps.items():
        stay[group[f]] = min(stay.get(group[f], d), d)
    assert sorted(r[0] for r in rows["SimHash near-dedup"]) == sorted(stay.values())
    sizes, taken, text = {}, {}, {}
    for d, t, s in rows["SimHash near-dedup"]:
        sizes[s], text[d] = sizes.get(s, 0) + words(t), (t, s)
    longest = max(words(t) for t, _ in text.values())
    for d, t, s in rows["source mixing"]:
        assert text[d] == (t, s)
        taken[s] = taken.get(s, 0) + words(t)
    assert all(abs(taken.get(s, 0) - t) <= 2 * longest for s, t in want_targets(sizes).items())
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    out = kept["SentencePiece"].collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows["source mixing"])
    for r in out:
        assert r.ids == sp.encode(text[r.doc_id][0] or "") and r.n_tokens == len(r.ids) and r.decoded == sp.decode(r.ids)


def test_run_gives_the_stages_rows(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "source", "n_tokens", "ids", "decoded"]
