"""Toxicity by cumulative-link ordinal regression on sparse text features.

A text's features are the words, and beginnings of words, out of a learned
vocabulary, weighed by the logarithm of their counts. One weight vector serves
all severity grades: grade ``k`` or more has probability
``sigmoid(weights . features - threshold_k)`` with rising thresholds, and the
expected severity is the sum of these probabilities.

Labels only say toxic or not. The grades of toxic training texts come from the
text: thirds by the number of occurrences of words typical of toxic texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import release
from .common import fresh, id_crc, small_batches, written

#: Most labelled documents of each kind that a model is fitted on, and features that it keeps.
SAMPLE, VOCABULARY = 4000, 1500
#: Evidence that a feature must have beyond the best that chance gives, and the share of toxic texts among those with
#: it (or none of them is toxic).
MARGIN, PURITY = 2.0, 0.5
GRADES, STEMS = 3, (4, 5)
#: Hash functions of a sketch, and the share of equal values from which two texts are near copies.
SKETCH, SAME = 256, 0.8
FACTORS, OFFSETS = (np.random.default_rng(k).integers(0, 2**63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1) for k in (1, 2))
WORDS = re.compile(r"\w+").findall


def features(text: str | None, vocabulary: dict[str, int] | None = None) -> dict[str, int]:
    """Counts of the text's words and of the beginnings of its longer words
    (marked ``^``), of those in ``vocabulary`` if one is given."""
    seen: dict[str, int] = {}
    for w in WORDS(text.lower()) if text else ():
        seen[w] = seen.get(w, 0) + 1
    out: dict[str, int] = {}
    for w, n in seen.items():
        for f in (w, *(f"^{w[:k]}" for k in STEMS if len(w) > k)):
            if vocabulary is None or f in vocabulary:
                out[f] = out.get(f, 0) + n
    return out


def sketch(text: str | None) -> np.ndarray:
    """The smallest values of the text's runs of four words under each of SKETCH
    hash functions: two texts agree in about as many as their Jaccard similarity says."""
    import xxhash

    words = WORDS(text.lower()) if text else []
    runs = {" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))}
    h = np.array([xxhash.xxh64_intdigest(r) for r in runs], np.uint64)
    parts = (h[k:k + 2048, None] * FACTORS + OFFSETS for k in range(0, len(h), 2048))
    return np.minimum.reduce([p.min(0) >> np.uint64(32) for p in parts]).astype(np.uint32)


def without_copies(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
    """Mark and id of each of ``rows`` (mark, id, sketch), in order, unless one
    already kept with the same mark is its near copy."""
    kept, sizes, held = [], {}, {}
    for mark, doc, raw in sorted(rows):
        own, n = np.frombuffer(raw, np.uint32), sizes.get(mark, 0)
        if mark not in held:
            held[mark] = np.empty((len(rows), SKETCH), np.uint32)
        if (np.count_nonzero(held[mark][:n] == own, axis=1) >= SAME * SKETCH).any():
            continue
        held[mark][n], sizes[mark] = own, n + 1
        kept.append((mark, doc))
    return kept


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, text: str | None) -> np.ndarray:
        """Probabilities that the text's severity is at least 1, 2, ..."""
        found = features(text, self.vocabulary)
        z = sum(self.weights[self.vocabulary[f]] * np.log1p(n) for f, n in found.items())
        return sigmoid(z - self.thresholds)


def fit(x: np.ndarray, grade: np.ndarray, share: float, rounds: int = 800, ridge: float = 3e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds by accelerated gradient steps on the mean
    log loss of the grades, sharing the weights among all thresholds. Grades
    above 0 together weigh ``share``."""
    top = int(grade.max(initial=0))
    w, first, gaps = np.zeros(x.shape[1]), 1.0, np.zeros(max(0, top - 1))
    if top == 0:
        return w, np.full(GRADES, 40.0)
    balance = np.where(grade == 0, (1 - share) / max(1, (grade == 0).sum()), share / (grade > 0).sum())
    par = np.concatenate([w, [first], gaps])  # weights, first threshold, logarithms of the steps to the next ones
    m, v, at, rows = np.zeros_like(par), np.zeros_like(par), x.shape[1], np.arange(len(x))
    for t in range(1, rounds + 1):
        w, steps = par[:at], np.exp(par[at + 1:])
        thresholds = np.cumsum(np.concatenate([par[at:at + 1], steps]))
        upper = np.hstack([np.ones((len(x), 1)), sigmoid((x @ w)[:, None] - thresholds)])  # at least 0, 1, ..., top
        lower = np.hstack([upper[:, 1:], np.zeros((len(x), 1))])
        a, b = upper[rows, grade], lower[rows, grade]
        p = np.maximum(a - b, 1e-9)
        da, db = balance * a * (1 - a) / p, balance * b * (1 - b) / p
        by_threshold = np.array([da[grade == k].sum() - db[grade == k - 1].sum() for k in range(1, top + 1)])
        above = np.cumsum(by_threshold[::-1])[::-1]
        grad = np.concatenate([x.T @ (db - da) + ridge * w, above[:1], above[1:] * steps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        par = par - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return par[:at], np.cumsum(np.concatenate([par[at:at + 1], np.exp(par[at + 1:])]))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic",
          sample: int = SAMPLE, vocabulary: int = VOCABULARY, purity: float = PURITY) -> Model:
    """A model from the rows of ``labels`` whose id is not held out and whose
    label is 0 or 1: at most ``sample`` ids of each, the first by a hash of the
    id, and of rows that share an id and a label one;
    of near copies with the same label among them one. Without toxic rows no
    text is toxic.

    Features are all words and beginnings whose evidence exceeds chance and that
    are toxic in a share ``purity`` of the texts with them, or never; beyond
    ``vocabulary`` of them, those with most evidence."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.filter(F.col(label).isin(0, 1) & (id_crc(id_col) % 5 != 0)).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("mark")).distinct()
    total = {r["mark"]: r["n"] for r in known.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for mark in (0, 1):
        part = known.filter(F.col("mark") == mark).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("body")).join(F.broadcast(chosen), "id")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = [features(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([sketch(t).tobytes() for t in texts], pa.binary()),
                 pa.array([list(f) for f in found], pa.list_(pa.string())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))], names=["id", "mark", "sketch", "f", "n"])

    sparse_rows = rows.select("id", "mark", "body").mapInArrow(
        sparse, "id long, mark int, sketch binary, f array<string>, n array<long>")
    held = sample_table = written(sparse_rows.groupBy("id", "mark").agg(F.min(F.struct("sketch", "f", "n")).alias("x")).select(
        "id", "mark", "x.*"), "toxic-sample")
    one = without_copies([(r["mark"], r["id"], bytes(r["sketch"])) for r in held.select("mark", "id", "sketch").collect()])
    held = held.join(F.broadcast(spark.createDataFrame(one, "mark int, id long")), ["mark", "id"], "left_semi")
    sizes = {r["mark"]: r["n"] for r in held.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    bad, fine = sizes.get(1, 0), sizes.get(0, 0)
    texts = held.select("mark", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum("mark").alias("bad"), F.sum(1 - F.col("mark")).alias("fine"))
    # evidence that the feature's share of toxic texts is not the usual one (log-likelihood ratio), against
    # what the best of so many features reaches by chance
    rate, seen = bad / max(1, bad + fine), F.col("bad") + F.col("fine")
    part = lambda n, p: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (seen * p))).otherwise(0.0)
    kept = []
    if bad and fine:
        evidence = texts.withColumn("evidence", 2 * (part("bad", rate) + part("fine", 1 - rate)))
        chance = 2 * float(np.log(max(2, texts.count()))) + MARGIN
        pure = (F.col("bad") >= purity * seen) | (F.col("fine") == seen)
        kept = evidence.filter(pure & (F.col("evidence") >= chance)).orderBy(F.desc("evidence"), "f").limit(vocabulary).collect()
    known_features = {r["f"]: k for k, r in enumerate(sorted(kept, key=lambda r: r["f"]))}
    typical = {r["f"] for r in kept if r["bad"] > rate * (r["bad"] + r["fine"]) and not r["f"].startswith("^")}
    words = spark.createDataFrame([(f,) for f in known_features], "f string")
    found = {}
    for r in held.select("id", "mark", F.inline(F.arrays_zip("f", "n"))).join(F.broadcast(words), "f").collect():
        found.setdefault((r["mark"], r["id"]), []).append((r["f"], r["n"]))
    data = sorted((r["mark"], r["id"]) for r in held.select("id", "mark").collect())
    release(sample_table)
    x = np.zeros((len(data), len(known_features)))
    hits = np.zeros(len(data))
    for k, row in enumerate(data):
        for f, n in found.get(row, ()):
            x[k, known_features[f]] = np.log1p(n)
            hits[k] += n * (f in typical)
    mark = np.array([d[0] for d in data], int)
    grade = np.zeros(len(data), int)
    if bad:
        cuts = np.quantile(hits[mark == 1], [g / GRADES for g in range(1, GRADES)])
        grade[mark == 1] = 1 + (hits[mark == 1, None] > cuts).sum(1)
    weights, thresholds = fit(x, grade, total.get(1, 0) / max(1, sum(total.values())))
    return Model(known_features, weights, np.concatenate([thresholds, np.full(GRADES - len(thresholds), 40.0)]))


def with_severity(df: DataFrame, model: Model, text: str = "text", out: str = "severity", toxic: str = "toxic_score",
                  keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if none are named) with ``out``,
    the expected severity of each whole text (0 to GRADES), and ``toxic``, the
    probability of any. Null and empty texts score like a text without any
    feature."""
    spark = df.sparkSession
    small_batches(spark)
    keep = [c for c in (keep or df.columns) if c.lower() not in (out.lower(), toxic.lower())]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.DoubleType()), T.StructField(toxic, T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array([shared.value.at_least(t) for t in batch.column(len(keep)).to_pylist()]).reshape(-1, GRADES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p.sum(1)), pa.array(p[:, 0])], names=[*keep, out, toxic])

    (body,) = fresh(df, "body")
    return df.select(*keep, F.col(text).alias(body)).mapInArrow(run, schema)
