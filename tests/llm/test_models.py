"""Tokenizer and learned operators: the library, brute force, held-out accuracy."""

from __future__ import annotations

import math
import random
import re
import string
import zlib

import numpy as np
import pytest

from tallgrass.llm import langid, quality, sentencepiece_bpe, toxicity

SF = "/root/testdata/sf0.1"


def model_path():
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    with open(model_path(), "rb") as f:
        return sentencepiece_bpe.Pieces(f.read())


ODD = [None, "", " ", "▁", "  a  b ", "a" * 3000, "ab" * 900, " " * 700 + "x" + " " * 33, "=" * 999, "<s><0x41></s>", "日本語 𐍈𐍈 é́",
       "\x00a\r\n\tb", "1" * 777, "the" * 500 + " 😀" * 300, "-" * 50 + "_" * 50, "word " * 40000]


def test_encoding_equals_the_library(pieces):
    rnd = random.Random(1)
    chars = " ▁  aàb日本語の\n\tthe Ωab😀é́0123---===___   "
    texts = ODD + ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    flat, counts = pieces.encode(texts)
    at = 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        got, want = flat[at:at + n].tolist(), pieces.sp.encode(t or "")
        assert got == want, repr(t)[:80]
        assert pieces.decode(got) == pieces.sp.decode(want)
        at += n


def test_one_merge_at_a_time_agrees(pieces):
    rnd = random.Random(4)
    for _ in range(300):
        w = "".join(rnd.choice("▁▁thein ong") for _ in range(rnd.randint(1, 25))).replace(" ", "▁")
        sym = pieces.char_sym[pieces.char_no[[ord(c) for c in w]]].tolist()
        flat, size = pieces.merge_words([w])
        assert flat.tolist() == pieces.one_by_one(sym) and size.tolist() == [len(flat)]


def test_decoding_any_ids_equals_the_library(pieces):
    rnd = random.Random(2)
    for _ in range(1500):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(262)]) for _ in range(rnd.randint(0, 8))]
        assert pieces.decode(ids) == pieces.sp.decode(ids), ids


def test_long_texts_are_cut_where_no_piece_spans(pieces, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "CHUNK_CHARS", 50)
    texts = ["the quick brown fox " * 30, "x" * 400, "日本語" * 100]
    flat, counts = pieces.encode(texts)
    assert np.split(flat, np.cumsum(counts)[:-1])[0].tolist() == pieces.sp.encode(texts[0])
    assert flat.tolist() == [i for t in texts for i in pieces.sp.encode(t)]


def test_encode_frame(spark, pieces):
    df = spark.createDataFrame([(k, t, 7, "z") for k, t in enumerate(ODD)], "doc_id long, text string, ids int, decoded string")
    out = sentencepiece_bpe.encode_decode(df, model_path(), decoded="decoded")
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for r in out.collect():
        assert r.ids == pieces.sp.encode(r.text or "") and r.decoded == pieces.sp.decode(r.ids)
    assert sentencepiece_bpe.encode_decode(df.limit(0), model_path()).collect() == []


def occurs(seq, part):
    return any(seq[k:k + len(part)] == part for k in range(len(seq) - len(part) + 1))


@pytest.mark.parametrize("width", [512, 50, 7, 1])
def test_cross_parsing_against_substring_search(monkeypatch, width):
    """Phrases of whole texts, however they are cut into windows: the fewest in
    a language means the longest match at each place, a literal costs more."""
    monkeypatch.setattr(langid, "WINDOW_CHARS", width)
    rnd = random.Random(3)
    samples = {"aa": "".join(rnd.choice("abc ") for _ in range(200)), "bb": "".join(rnd.choice("bcdé") for _ in range(200)), "cc": "aaaaaaa"}
    model = langid.build(samples)
    codes = model.codes()
    texts = ["".join(rnd.choice("abcdéxZ .") for _ in range(rnd.randint(0, 300))) for _ in range(10)]
    texts += ["", "...", "a", "a" * 40, samples["aa"] + samples["bb"] + samples["aa"]]  # the last parses into few long phrases
    got = langid.entropies(texts, model, codes)
    for t, row in zip(texts, got, strict=True):
        seq = langid.numbered([t], codes)[0].tolist()
        for k, name in enumerate(model.languages):
            sample, n, at = langid.numbered([samples[name]], codes)[0].tolist(), 0, 0
            while at < len(seq):
                size = 0
                while at + size < len(seq) and occurs(sample, seq[at:at + size + 1]):
                    size += 1
                n, at = n + (1 if size else langid.LITERAL), at + max(size, 1)
            want = n * model.bits / len(seq) if seq else float("nan")
            assert row[k] == pytest.approx(want, nan_ok=True)


def test_tiny_languages_do_no_harm(spark):
    extra = [("ok", "zz"), ("12 34", "dd"), ("", "ee"), (None, "ff"), ("the the the", "tt"), ("e t a o n i s r h l d u", "ll"),
             ("abcdefghijklmnopqrstuvwxyz äöüéèñ", "mm")]
    docs = spark.read.parquet(f"{SF.replace('sf0.1', 'sf0.01')}/documents.parquet").select("doc_id", "text", "lang")
    ids = [i for i in range(10**6, 10**6 + 100) if not held(i, 4, 2)]
    more = spark.createDataFrame([(i, t, x) for i, (t, x) in zip(ids, extra, strict=False)], docs.schema)
    right = []
    for model in (langid.train(docs), langid.train(docs.union(more))):
        rows = [r for r in langid.with_language(docs, model).collect() if held(r.doc_id, 4, 2)]
        right.append(np.mean([r.lang == r.lang_pred for r in rows]))
    assert right[0] > 0.98 and abs(right[0] - right[1]) < 0.005
    assert not {"dd", "ee", "ff"} & set(model.languages)


def test_samples_are_bounded_and_whole(spark):
    texts = [(k, f"word{k} " * (3000 if k % 5 == 0 else 20), "aa" if k % 3 else "bb") for k in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = langid.train(docs, sample_chars=4000, sample_docs=30)
    assert all(len(s) <= 4000 for s in model.samples)
    assert all(len(s) <= 1000 for s in langid.train(docs, total_chars=2000).samples)
    long = docs.filter("doc_id % 5 = 0")  # longer than a sample each: cut, not left out
    assert langid.train(long, sample_chars=4000).languages == ["aa", "bb"]


def docs_and_labels(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held(i, m, r):
    return zlib.crc32(str(i).encode()) % m == r


def test_language_of_held_out_documents(spark):
    docs, _ = docs_and_labels(spark)
    model = langid.train(docs)
    test = docs.filter("doc_id < 3000").select("doc_id", "text", "lang", "doc_id", ).toDF("doc_id", "text", "lang", "score")
    out = langid.with_language(test, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    rows = [r for r in out.collect() if held(r.doc_id, 4, 2)]
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98 and all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, " 12 ."), (3, "der die das " * 50000), (4, "日本")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.with_language(odd, model).collect()}
    assert got[None] == got[1] == got[2] == ("und", 0.0) and got[3][0] == "de" and got[4][0] in model.languages
    none = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.with_language(odd, none).collect()} == {"und"}


def invented(rnd, letters, n=40):
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(n)]


def test_every_language_is_learned(spark):
    rnd = random.Random(5)
    vocabulary = {f"l{k:02d}": invented(rnd, "abcdefghijklmnopqrstuvwxyz") for k in range(70)}
    texts = [(name, " ".join(rnd.choice(w) for _ in range(60))) for name, w in vocabulary.items() for _ in range(8)]
    docs = spark.createDataFrame([(k, t, name) for k, (name, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    known = {name for k, (name, _) in enumerate(texts) if not held(k, 4, 2)}
    assert model.languages == sorted(known) and len(known) == 70
    assert all(r.lang_pred == r.lang for r in langid.with_language(docs, model).collect())


def test_every_letter_of_the_samples_is_told_apart():
    rnd = random.Random(6)
    scripts = {"aa": [chr(0x4E00 + k) for k in range(400)], "bb": [chr(0x4E00 + k) for k in range(400, 800)],
               "cc": [chr(0xAC00 + k) for k in range(300)]}
    words = {name: invented(rnd, letters, 300) for name, letters in scripts.items()}
    model = langid.build({name: " ".join(rnd.choice(w) for _ in range(3000)) for name, w in words.items()})
    codes = model.codes()
    seen = {c for w in words.values() for x in w for c in x}
    assert len({int(codes[ord(c)]) for c in seen} - {0, 1}) == len(seen) > 900
    for k, w in enumerate(words.values()):
        h = langid.entropies([" ".join(rnd.choice(w) for _ in range(40)) for _ in range(20)], model, codes)
        assert (h.argmin(1) == k).all() and (np.delete(h, k, 1).min(1) > 2 * h[:, k]).all()


def test_quality_of_held_out_documents(spark):
    docs, labels = docs_and_labels(spark)
    model = quality.train(docs, labels)
    rows = quality.with_score(docs.join(labels, "doc_id"), model).select("doc_id", "quality", "score").collect()
    rows = [r for r in rows if held(r.doc_id, 5, 0)]
    assert np.mean([(r.score >= quality.CUT) == (r.quality == 1) for r in rows]) > 0.97
    assert np.mean([r.score >= quality.CUT for r in rows if r.quality == 1]) > 0.98
    odd = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (2, "x " * 200000, "c")], "doc_id long, text string, score string")
    assert all(0 <= r.score <= 1 for r in quality.with_score(odd, model).collect())
    empty = quality.train(docs.limit(0), labels.limit(0))
    assert all(r.score >= quality.CUT for r in quality.with_score(odd, empty).collect())
    assert quality.with_score(odd.limit(0), model).collect() == []


def test_repeated_rows_do_not_change_the_samples(spark, monkeypatch):
    sf = SF.replace("sf0.1", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    some = {m: [r.doc_id for r in labels.filter(f"{m[0]} = {m[1]}").collect() if not held(r.doc_id, 5, 0)][:20]
            for m in (("quality", 0), ("quality", 1), ("toxic", 1))}
    ids = ",".join(map(str, sorted({i for x in some.values() for i in x})))

    def repeated(df):
        return df.union(df.filter(f"doc_id IN ({ids})").crossJoin(spark.range(30).select()))

    fitted = []
    for module in (quality, toxicity):
        monkeypatch.setattr(module, "fit", lambda x, mark, *a, fit=module.fit, **k: fitted.append((x, mark, a)) or fit(x, mark, *a, **k))
    for module in (quality, toxicity):
        fitted.clear()
        for d, m in ((docs, labels), (repeated(docs), repeated(labels))):
            module.train(d, m, sample=100)
        (x, mark, share), (x2, mark2, share2) = fitted
        assert 0 < len(x) <= 200 and np.array_equal(x, x2) and np.array_equal(mark, mark2) and share == share2
    one, two = langid.train(docs, sample_docs=20), langid.train(repeated(docs), sample_docs=20)
    assert one.languages == two.languages and all(map(np.array_equal, one.samples, two.samples))


def test_pairwise_fit_orders_by_preference():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    good = x[:, 3] - x[:, 5] + 0.1 * rng.normal(size=600) > 0.8
    model = quality.fit(x, good, good.mean())
    assert np.mean((model.score(x) >= quality.CUT) == good) > 0.95
    assert abs(model.quantile - (1 - good.mean())) < 0.05


def test_toxicity_of_held_out_documents(spark):
    docs, labels = docs_and_labels(spark)
    model = toxicity.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.with_severity(docs.join(labels, "doc_id"), model).select("doc_id", "toxic", "severity", "toxic_score").collect()
    rows = [r for r in rows if held(r.doc_id, 5, 0)]
    assert np.mean([r.toxic_score >= 0.5 for r in rows if r.toxic == 1]) > 0.9
    assert not any(r.toxic_score >= 0.5 for r in rows if r.toxic == 0)
    assert all(r.toxic_score <= r.severity + 1e-9 <= toxicity.GRADES + 1e-6 for r in rows)
    odd = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (2, "x " * 200000, "c")], "doc_id long, text string, severity string")
    assert {r.toxic_score < 0.5 for r in toxicity.with_severity(odd, model).collect()} == {True}
    empty = toxicity.train(docs.limit(0), labels.limit(0))
    assert {r.toxic_score < 0.5 for r in toxicity.with_severity(odd, empty).collect()} == {True}


def test_only_near_copies_with_one_label_are_dropped(spark, monkeypatch):
    import xxhash

    rnd = random.Random(7)
    passage = min((" ".join(invented(rnd, "abcdefgh", 4)) for _ in range(20000)), key=lambda p: xxhash.xxh64_intdigest(p) >> 1)
    own = [invented(rnd, "abcdefghijklm", 100) for _ in range(40)]
    rows = [(f"{passage} {' '.join(w)}", k % 2) for k, w in enumerate(own)]  # one shared run
    rows += [(f"{passage} {' '.join(w[:50] + ['new'] + w[51:])}", k % 2) for k, w in enumerate(own[:10])]  # near copies
    rows += [(f"{passage} {' '.join(w)}", 1 - k % 2) for k, w in enumerate(own[20:30], 20)]  # copies with the other label
    ids = [i for i in range(200) if not held(i, 5, 0)][:len(rows)]
    df = spark.createDataFrame([(i, t, m) for i, (t, m) in zip(ids, rows, strict=True)], "doc_id long, text string, toxic int")
    fitted, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda x, grade, share: fitted.append(grade) or fit(x, grade, share))
    toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert [(g == 0).sum() for g in fitted] == [25] and [(g > 0).sum() for g in fitted] == [25]


def test_ordinal_fit_shares_weights():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (800, 6)).astype(float)
    z = x[:, 0] + x[:, 1] - 2
    grade = np.digitize(z + 0.1 * rng.normal(size=800), [0.5, 1.5, 2.5])
    w, th = toxicity.fit(x, grade, float((grade > 0).mean()))
    assert (np.diff(th) > 0).all() and w[0] > 1 and w[1] > 1 and np.abs(w[2:]).max() < 0.3 * w[0]
    expected = toxicity.sigmoid((x @ w)[:, None] - th).sum(1)
    assert np.corrcoef(expected, grade)[0, 1] > 0.95


TEXTS = ["", "  \n", "one", "The cat. The CAT, the dog!", "### $$$ a!b 1,2,3\nline\nline\n\nother", "Ä ö ß é", "x " * 50, "A B C D " * 20 + "\n" * 5]


def plain_statistics(text):
    words = re.findall(r"[^ \t-\r]+", text)
    if not words:
        return [0.0] * 14
    raw = text.encode()
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    bare = re.findall(r"[^ \t-\r]+", re.sub("[.,;:]", "", fold)) or words
    signs, n = "#$%&*+/<=>@[\\]^_`{|}~!?", len(words)
    letters = max(1, sum(c in string.ascii_letters or ord(c) > 127 for c in text for _ in c.encode()))
    lines = [x for x in text.split("\n") if x]

    def share(chars, of):
        return sum(c in chars for c in text) / of

    return [math.log(1 + n), len(set(bare)) / len(bare), sum(a == b for a, b in zip(bare, bare[1:])) / n,
            (max(bare.count(w) for w in bare) - 1) / (len(bare) + 10), sum(all(c in signs for c in w) for w in bare) / n,
            share(string.ascii_uppercase, letters), share(string.digits, len(raw)), share("#$%&*+/<=>@[\\]^_`{|}~", len(raw)),
            share(".,;:", n), share("!?", n), share("\n", n), min(30.0, (len(raw) - n) / n),
            1 - len(set(lines)) / max(1, len(lines)), sum(w[-1] in signs for w in words) / n]


@pytest.mark.parametrize("text", TEXTS)
def test_quality_statistics_against_plain_counts(text):
    assert quality.statistics(text.encode()) == pytest.approx(plain_statistics(text))


def test_quality_weights_minimise_the_pairs_loss():
    """The fitted weights beat every small step away from them on the loss of the pairs, written out pair by pair."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, len(quality.FEATURES)))
    good = x[:, 0] - x[:, 1] + rng.normal(size=60) > 0
    model = quality.fit(x, good, 0.5, seed=7)
    z = [[min(4.0, max(-4.0, v)) for v in row] for row in (x - model.mean) / model.scale]
    b = np.array([[*r, *[max(v - 1, 0) for v in r], *[max(-v - 1, 0) for v in r]] for r in z])
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    draw, n = np.random.default_rng(7), quality.PAIRS_EACH * max(len(up), len(down))
    pairs = list(zip(draw.choice(up, n), draw.choice(down, n), strict=True))

    def loss(w):
        return sum(math.log(1 + math.exp(-float((b[i] - b[j]) @ w))) for i, j in pairs) / n + 0.5e-3 * float(w @ w)

    best = loss(model.weights)
    for k in range(len(model.weights)):
        for step in (-0.05, 0.05):
            other = model.weights.copy()
            other[k] += step
            assert loss(other) > best
    strength = b @ model.weights
    want = 1 / (1 + np.exp(-(strength - model.cut + math.log(quality.CUT / (1 - quality.CUT)))))
    assert model.score(x) == pytest.approx(want)


def test_toxicity_features_and_scores_against_plain_counts():
    rnd = random.Random(8)
    for _ in range(100):
        text = " ".join(rnd.choice(["Ab", "abcde", "abcdef", "x1", "é,é", "A-b"]) for _ in range(rnd.randint(0, 30)))
        words = re.findall(r"\w+", text.lower())
        want = {}
        for w in words:
            for f in [w] + [f"^{w[:k]}" for k in (4, 5) if len(w) > k]:
                want[f] = want.get(f, 0) + 1
        assert toxicity.features(text) == want
        model = toxicity.Model({"ab": 0, "^abcd": 1, "é": 2}, np.array([0.5, -1.0, 2.0]), np.array([0.1, 0.7, 1.5]))
        z = sum(model.weights[k] * math.log(1 + want[f]) for f, k in model.vocabulary.items() if f in want)
        assert model.at_least(text) == pytest.approx([1 / (1 + math.exp(t - z)) for t in model.thresholds])


def test_ordinal_weights_minimise_the_loss():
    """The mean log loss of the grades, written out row by row, falls in no direction from the fitted parameters."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, (200, 4)).astype(float)
    grade = np.digitize(x[:, 0] + x[:, 1] + rng.normal(size=200), [2.0, 3.0, 4.0])
    share = float((grade > 0).mean())
    w, th = toxicity.fit(x, grade, share, rounds=6000)

    def loss(w, th):
        total = 0.0
        for row, g in zip(x, grade, strict=True):
            at = [1.0, *[1 / (1 + math.exp(t - float(row @ w))) for t in th], 0.0]
            weight = (1 - share) / (grade == 0).sum() if g == 0 else share / (grade > 0).sum()
            total -= weight * math.log(at[g] - at[g + 1])
        return total + 0.5 * 3e-5 * float(w @ w)

    best = loss(w, th)
    for k in range(len(w) + len(th)):
        for step in (-0.1, 0.1):
            w2, th2 = w.copy(), th.copy()
            (w2 if k < len(w) else th2)[k if k < len(w) else k - len(w)] += step
            assert loss(w2, th2) > best


def test_vocabulary_is_a_parameter(spark):
    docs, labels = docs_and_labels(spark)
    small = toxicity.train(docs, labels, vocabulary=10)
    assert len(small.vocabulary) == 10


def test_a_clashing_column_is_handed_through(spark, pieces):
    df = spark.createDataFrame([(1, "the cat", "mine", "a")], "doc_id long, text string, _text_to_encode string, __text_to_encode string")
    row = sentencepiece_bpe.encode_decode(df, model_path()).first()
    assert row["_text_to_encode"] == "mine" and row["__text_to_encode"] == "a" and row.ids == pieces.sp.encode("the cat")
