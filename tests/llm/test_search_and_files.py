"""Top-k search, wavelet shards and WARC archives against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from tallgrass.llm import topk, warc, wavelet
from tallgrass.llm.worker import Folder


def plain_search(rows, k=5):
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ints:
        if q is None or q % 50:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c is None, c or 0) for c, w in ints
                       if c != q and len(w) == len(v))[:k]
        out += [(q, n + 1, None if late else c, -s) for n, (s, late, c) in enumerate(found)]
    return sorted(out, key=repr)


def random_vectors(n, dim, scale, seed):
    rnd = random.Random(seed)
    return [(k, [rnd.choice([rnd.uniform(-scale, scale), 0.0, 1.0]) for _ in range(dim)]) for k in range(n)]


ODD_VECTORS = [(0, [1.0, 2.0]), (50, [1.0, None]), (100, None), (150, [float("nan"), 1.0]), (200, [float("inf"), 0.0]), (250, []),
               (300, [1.0, 2.0, 3.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [1.0, 2.0]), (5, [1.0, 2.0]),
               (6, [1.0, 2.0]), (None, [9.0, 9.0]), (None, [1.0, 2.0]), (7, []), (-50, [0.5, -0.001]), (350, [1e12, 3e12]), (8, [1e12, -1e12])]


@pytest.mark.parametrize("rows", [ODD_VECTORS, random_vectors(400, 8, 1, 1), random_vectors(130, 3, 4e6, 2), [(0, [1.0])], []])
def test_search(spark, rows, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = topk.search(df, df.filter("vec_id % 50 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(rows)


def test_wavelet_matrix():
    rng = np.random.default_rng(0)
    for n, top in ((0, 5), (1, 1), (3000, 7), (4000, 60000), (1500, 2**31)):
        a = rng.integers(0, top, n).astype(np.uint32)
        w = wavelet.from_file(wavelet.to_file(list(range(n)), np.ones(n), a))[2]
        assert (w.tokens() == a).all() and (n == 0 or (w.access(np.arange(n)) == a).all())
        for t in [*a[:15].tolist(), top + 3]:
            at = np.flatnonzero(a == t)
            assert w.count(t) == len(at) and w.count(t, n // 2) == (at < n // 2).sum()
            assert [w.locate(t, k) for k in range(min(4, len(at)))] == at[:4].tolist()
            with pytest.raises(IndexError):
                w.locate(t, len(at))


def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


ODD_TEXTS = [None, "", " ", "Hello, WORLD!! it's ", "a<|endoftext|> b", "é é Ａ日本 Σς", "\x1c a\x85b c", "1234 ''s 'S.", "don't." * 3,
             "İ ŉ ǆ ﬁ", "x" * 5000, "word " * 30000]


def test_word_tokenizer_equals_the_library():
    from tokenizers import Tokenizer
    rnd = random.Random(2)
    chars = " \n\té́ÉßΣς'sdon't<|endoftext|>日本ＡÀ×µ ŸàΑabc123!!"
    texts = ODD_TEXTS + ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 50))) for _ in range(500)]
    with open(tokenizer(), encoding="utf-8") as f:
        flat, counts = wavelet.WordTokenizer(f.read()).encode(texts)
    lib, at = Tokenizer.from_file(tokenizer()), 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        assert flat[at:at + n].tolist() == lib.encode(t or "", add_special_tokens=False).ids
        at += n


def test_shards_round_trip(spark):
    from tokenizers import Tokenizer
    rows = [(k * 7 % 101, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "no id")] + [(200 + k, f"text {k}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder, shards = wavelet.write_shards(df, tokenizer(), 1, shard_tokens=2000, chunk_docs=50)
    assert shards.count() > 2
    got = [tuple(r) for r in wavelet.read_shards(folder, shards).collect()]
    lib, start, want = Tokenizer.from_file(tokenizer()), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    empty = wavelet.write_shards(df.limit(0), tokenizer(), 1)
    assert wavelet.read_shards(*empty).collect() == []


BIG, OTHER = "<p>" + "x" * 1200, "é" * 600
PAGES = [(1, "http://a.example.com/x?y=1", BIG), (5, "https://b.example.org:8080/z", BIG), (3, None, BIG), (9, "not a url", OTHER), (10, "", OTHER),
         (2, "http://[bad", "short"), (4, "http://a.example.com/x?y=1", "short"), (6, "http://ü.example/\r\n a\tb", None), (7, "http://c.example", ""),
         (None, "http://c.example", BIG), (None, "http://d.example", "z" * 2000), (None, "http://d.example", "z" * 2000),
         (8, "http://e.example/\r\n\r\nWARC/1.1", "a\r\n\r\nWARC/1.1\r\n" + "b" * 1500), (8, "http://e.example/\r\n\r\nWARC/1.1", "a\r\n\r\nWARC/1.1\r\n" + "b" * 1500)]


def plain_archive(rows):
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        first = max((j for j, _, g in rows if (g or "").encode() == body and j is not None), default=None)
        again = len(body) >= 1000 and first is not None and i != first
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_archive_round_trip(spark):
    rows = PAGES + [(100 + k, f"http://hot.example.com/p/{k % 7}", f"page {k}" * 200) for k in range(60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    got = warc.round_trip(df)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_archive(rows)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_single_lookup_reads_the_page(spark):
    from tallgrass.llm.common import shared_path
    folder = shared_path(spark, "warc-test")
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    files = warc.write_index(warc.write_archives(df, folder), folder, block_lines=3)
    assert [f for f, _ in files] == sorted(f for f, _ in files)
    (place,) = warc.Index(Folder(folder), files).lookup(warc.capture_key("https://b.example.org:8080/z", 5))
    assert list(warc.Index(Folder(folder), files).lookup(warc.capture_key("http://nowhere.example/", 5))) == []
    name, at, n = place
    raw = Folder(folder).read(name)
    fields, payload = warc.parse_record(zlib.decompress(raw[at:at + n], 31))
    assert fields["WARC-Type"] == "response" and payload.decode() == BIG
    import gzip
    whole = gzip.decompress(raw)  # the members one after the other are a plain WARC file
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and raw[:2] == b"\x1f\x8b"


def test_keys_reverse_the_host():
    assert warc.capture_key("http://www.Example.com/a?b", 3).startswith("com,example,www)/a?b 0")
    assert warc.capture_key(None, None) == "-) -"
    assert "\n" not in warc.capture_key("http://x/\n", 1) and warc.capture_key("u", -5) < warc.capture_key("u", 5)


def test_a_hot_payload_and_its_records_go_to_many_tasks(spark):
    """A third of all pages have one payload; releasing the result leaves nothing behind."""
    import os

    from pyspark.sql import functions as F

    from tallgrass.session import checkpoint_root, release
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    df = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 5).alias("url"), F.when(
        F.col("id") % 3 == 0, F.repeat(F.lit("x"), 1500)).otherwise(F.concat(F.repeat(F.lit("y"), 1200), F.col("id"))).alias("html"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = warc.round_trip(df)
        folder = got._scratch[-1].path
        archives = [f for f in os.listdir(folder.removeprefix("file:")) if f.endswith(".warc.gz")]
        rows = got.collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(archives) > 1 and len(rows) == 3000
    assert {(r.record_type, r.refers_to) for r in rows if r.page_id % 3 == 0 and r.page_id != 2997} == {("revisit", 2997)}
    release(got)
    assert set(os.listdir(root)) == before


def test_shards_and_fingerprints_leave_nothing(spark):
    import os

    from tallgrass.llm import simhash
    from tallgrass.session import checkpoint_root, release
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    df = spark.createDataFrame([(k, f"a b c {k % 4}") for k in range(40)] + [(1, "same id")] * 30, "doc_id long, text string")
    out = wavelet.read_shards(*wavelet.write_shards(df, tokenizer(), 1))
    assert out.count() == 70
    release(out)
    out = simhash.near_duplicates(df)
    assert out.count() == 70
    release(out)
    assert set(os.listdir(root)) == before


def test_counts_come_from_the_file():
    ids = np.array([random.Random(k).randrange(50_000) for k in range(3000)], np.uint32)
    docs, counts, m = wavelet.from_file(wavelet.to_file([1, None], np.array([1000, 2000]), ids))
    assert docs == [1, None] and counts.tolist() == [1000, 2000] and m.tokens().tolist() == ids.tolist()
    assert [o.tolist() for o in m.ones] == [o.tolist() for o in wavelet.WaveletMatrix.of(ids).ones]
    assert m.access(np.arange(0, 3000, 17)).tolist() == ids[::17].tolist()
    assert m.count(int(ids[5])) == int((ids == ids[5]).sum()) and m.locate(int(ids[5]), 0) == int(np.flatnonzero(ids == ids[5])[0])
