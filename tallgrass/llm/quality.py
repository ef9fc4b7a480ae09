"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of text statistics. The weights come
from preference pairs -- a document marked good is preferred to one marked bad
-- by minimising the logistic loss on the difference of the two documents'
statistics. The cut between good and bad is a quantile of the strengths of all
labelled documents, chosen where it agrees best with the marks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import release
from .common import fresh, id_crc, small_batches, written

#: Pairs for each document of the commoner mark.
PAIRS_EACH = 8
#: Labelled documents of a block, inside which pairs are drawn, and documents of the rarer mark that a block has at least, if there are so many.
BLOCK, LEAST_OF_MARK = 8000, 64
#: Scores at the cut; a score of at least this predicts a good document.
CUT = 0.3

FEATURES = ("log_words", "distinct_words", "repeated_neighbours", "top_word", "wordless", "upper", "digits", "symbols",
            "stops", "shouts", "breaks", "word_length", "repeated_lines", "marked_words")
UPPER, DIGIT, SYMBOL, STOP, SHOUT, BREAK, LETTER = (np.zeros(256, np.int64) for _ in range(7))
UPPER[ord("A"):ord("Z") + 1] = 1
DIGIT[ord("0"):ord("9") + 1] = 1
for table, chars in ((SYMBOL, b"#$%&*+/<=>@[\\]^_`{|}~"), (STOP, b".,;:"), (SHOUT, b"!?"), (BREAK, b"\n")):
    table[list(chars)] = 1
LETTER[ord("A"):ord("Z") + 1] = LETTER[ord("a"):ord("z") + 1] = 1
LETTER[128:] = 1
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~!?"


def statistics(text: bytes | None) -> list[float]:
    """The text's statistics, all zero for a text without words. ``top_word`` is
    how often the commonest word comes back, among as many words and ten more."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    bare = text.lower().translate(None, b".,;:").split() or words
    seen: dict[bytes, int] = {}
    for w in bare:
        seen[w] = seen.get(w, 0) + 1
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = max(1, int(count @ LETTER))
    lines = [x for x in text.split(b"\n") if x]
    same = sum(map(bytes.__eq__, bare[1:], bare[:-1]))
    signs = sum(w[-1] in _SYMBOLS for w in words)
    return [np.log1p(n), len(seen) / len(bare), same / n, (max(seen.values()) - 1) / (len(bare) + 10),
            sum(c for w, c in seen.items() if not w.translate(None, _SYMBOLS)) / n,
            int(count @ UPPER) / letters, int(count @ DIGIT) / size, int(count @ SYMBOL) / size, int(count @ STOP) / n,
            int(count @ SHOUT) / n, int(count @ BREAK) / n, min(30.0, (size - n) / n), 1 - len(set(lines)) / max(1, len(lines)),
            signs / n]


def with_statistics(df: DataFrame, text: str = "text", out: str = "statistics", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if none are named) with ``out``: the
    statistics of each whole text (array of double)."""
    small_batches(df.sparkSession)
    keep = [c for c in (keep or df.columns) if c.lower() != out.lower()]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in batch.column(len(keep)).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], names=[*keep, out])

    (body,) = fresh(df, "body")
    return df.select(*keep, F.col(text).alias(body)).mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float  # strength at the chosen quantile
    quantile: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return basis((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, equal to CUT at the cut."""
        z = self.strength(x) - self.cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def basis(z: np.ndarray) -> np.ndarray:
    """Standardised statistics within four deviations, and how far each lies beyond one on either side."""
    z = np.clip(z, -4, 4)
    return np.hstack([z, np.maximum(z - 1, 0), np.maximum(-z - 1, 0)])


def differences(b: np.ndarray, good: np.ndarray, seed: int) -> np.ndarray:
    """The preferred document's row of ``b`` less the other's, for each pair drawn; none without rows of both marks."""
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        return b[:0]
    rng, n = np.random.default_rng(seed), PAIRS_EACH * max(len(up), len(down))
    return b[rng.choice(up, n)] - b[rng.choice(down, n)]


def slope(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the pairs' logistic loss, summed."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
    return -(d * p[:, None]).sum(0), (d * (p * (1 - p))[:, None]).T @ d


def newton(sums: Callable[[np.ndarray], tuple[int, np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Weights that minimise the mean logistic loss with a small ridge; ``sums`` gives the pairs and their summed slope."""
    w = np.zeros(size)
    for _ in range(25):
        n, grad, hess = sums(w)
        step = np.linalg.solve(hess / max(1, n) + 1e-3 * np.eye(size), grad / max(1, n) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, share_good: float, seed: int = 7) -> Model:
    """Weights from preference pairs and the cut that agrees best with the
    marks, ``share_good`` being the share of good ones among all labelled rows.
    Without rows of both marks every document scores alike: as good, unless all
    rows are bad."""
    if not len(x):
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(3 * len(FEATURES)), -1.0, 0.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    b = basis((x - mean) / scale)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):  # nothing to prefer
        return Model(mean, scale, np.zeros(b.shape[1]), -1.0 if len(up) else 1.0, 0.0)
    d = differences(b, good, seed)
    w = newton(lambda w: (len(d), *slope(d, w)), b.shape[1])
    s = b @ w
    order = np.argsort(s, kind="stable")
    mass = np.where(good, share_good / len(up), (1 - share_good) / len(down))[order]
    right = np.concatenate([[0], np.cumsum(np.where(good[order], -mass, mass))])  # agreement gained by rejecting the lowest k
    k = int(np.argmax(right))
    below, above = s[order[max(k - 1, 0)]], s[order[min(k, len(s) - 1)]]
    return Model(mean, scale, w, float((below + above) / 2), float(mass[:k].sum()))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality",
          sample: int | None = None) -> Model:
    """A model from all rows of ``labels`` whose id is not held out and whose
    label is 0 or 1; of rows that share an id and a label one. A caller may ask
    for a ``sample`` of at most so many ids of each label, the first by a hash of
    the id. Without such rows every document is accepted."""
    known = labels.filter(F.col(label).isin(0, 1) & (id_crc(id_col) % 5 != 0)).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("mark")).distinct()
    total = {r["mark"]: r["n"] for r in known.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    share_good = total.get(1, 0) / max(1, sum(total.values()))
    if sample is None:
        learn = docs.filter(id_crc(id_col) % 5 != 0).select(F.col(id_col).alias("id"), F.col(text).alias("body"))
        return fit_all(with_statistics(learn, "body", keep=["id"]).join(known, "id").groupBy("id", "mark").agg(
            F.min("statistics").alias("statistics")), share_good)
    chosen = None
    for mark in (0, 1):
        part = known.filter(F.col("mark") == mark).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    rows = with_statistics(docs.select(F.col(id_col).alias("id"), F.col(text).alias("body"))
                           .join(F.broadcast(chosen), "id"), "body").groupBy("id", "mark").agg(F.min("statistics").alias("statistics")).collect()
    rows.sort(key=lambda r: (r["id"], r["mark"]))  # the same fit whatever order rows arrive in
    return fit(np.array([r["statistics"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["mark"] == 1 for r in rows]),
               share_good)


def fit_all(rows: DataFrame, share_good: float, seed: int = 7) -> Model:
    """``fit`` over all ``rows`` (``id``, ``mark``, ``statistics``), however many.

    Rows are dealt by a hash of their id into blocks of about BLOCK; pairs are
    drawn inside each block as ``fit`` draws them, and their summed slopes come
    to the driver, one row a task. If a mark is so rare that a block would have
    fewer than LEAST_OF_MARK of it, its rows are paired in several blocks."""
    width = 3 * len(FEATURES)
    rows = written(rows, "quality-rows")
    x = [F.col("statistics")[k] for k in range(len(FEATURES))]
    first = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("mark"), F.lit(0)), *[F.avg(c) for c in x]).first()
    n, up, mean = first[0], first[1], np.array(first[2:], float)
    if not n:
        release(rows)
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0, bool), share_good)
    scale = np.maximum(np.sqrt(np.array(rows.agg(*[F.avg((c - F.lit(float(m))) ** 2) for c, m in zip(x, mean)]).first(), float)), 1e-6)
    if up in (0, n):  # nothing to prefer
        release(rows)
        return Model(mean, scale, np.zeros(width), -1.0 if up else 1.0, 0.0)

    n_blocks, few = -(-n // BLOCK), min(up, n - up)
    times = min(n_blocks, -(-LEAST_OF_MARK * n_blocks // few))  # 1 unless a mark is rare
    turns = F.when(F.col("mark") == int(up <= n - up), F.sequence(F.lit(0), F.lit(times - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.select("*", F.explode(turns).alias("turn")).groupBy(
        F.pmod(F.xxhash64("id") + F.col("turn"), F.lit(n_blocks)).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("id", "mark", "turn", "statistics"))).alias("r"))
    blocks = written(dealt.select("block", F.col("r.mark").alias("mark"), F.col("r.turn").alias("turn"),
                                  F.flatten("r.statistics").alias("x")), "quality-blocks")
    small_batches(rows.sparkSession)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, mark, turn, flat = (batch.column(c)[k] for c in range(4))
                values = flat.values.to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
                yield (block.as_py(), mark.values.to_numpy(zero_copy_only=False) == 1, turn.values.to_numpy(zero_copy_only=False) == 0,
                       basis((values - mean) / scale))

    def sums(w: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            least, pairs, grad, hess = None, 0, np.zeros(width), np.zeros((width, width))
            for block, good, _, b in unpacked(batches):
                d = differences(b, good, seed + block)
                g, h = slope(d, w)
                least, pairs, grad, hess = block if least is None else min(least, block), pairs + len(d), grad + g, hess + h
            if least is not None:
                yield pa.RecordBatch.from_arrays([pa.array([least], pa.int64()), pa.array([pairs], pa.int64()), pa.array(
                    [np.concatenate([grad, hess.ravel()])], pa.list_(pa.float64()))], names=["block", "pairs", "sums"])

        parts = sorted(blocks.mapInArrow(run, "block long, pairs long, sums array<double>").collect())
        all_sums = np.sum([p["sums"] for p in parts], 0)
        return sum(p["pairs"] for p in parts), all_sums[:width], all_sums[width:].reshape(width, width)

    w = newton(sums, width)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, good, own, b in unpacked(batches):
            yield pa.RecordBatch.from_arrays([pa.array((b @ w)[own]), pa.array(good[own].astype(np.int64))], names=["s", "good"])

    cut, quantile = best_cut(blocks.mapInArrow(strengths, "s double, good long"), share_good / up, (1 - share_good) / (n - up))
    release(rows, blocks)
    return Model(mean, scale, w, cut, quantile)


def best_cut(strengths: DataFrame, of_good: float, of_bad: float) -> tuple[float, float]:
    """The cut between two strengths ``s`` that agrees best with the marks
    ``good``, and the share of rows below it, a good row weighing ``of_good`` and
    a bad one ``of_bad``. Strengths are sorted over all tasks; each gives one row."""
    schema = "first double, last double, gain double, mass double, best double, below double, above double, share double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = below = above = share = None
        gain, mass, best, open_end = 0.0, 0.0, -np.inf, False
        for batch in batches:
            s, up, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            if not len(s):
                continue
            first, above, open_end = s[0] if first is None else first, s[0] if open_end else above, False
            rejected, kept = (n - up) * of_bad, up * of_good
            g, m = gain + np.cumsum(rejected - kept), mass + np.cumsum(rejected + kept)
            k = int(np.argmax(g))
            if g[k] > best:
                best, below, share, open_end = g[k], s[k], m[k], k + 1 == len(s)
                above = None if open_end else s[k + 1]
            gain, mass, last = g[-1], m[-1], s[-1]
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.float64()) for v in (first, last, gain, mass, best, below, above, share)],
                                             names=[c.split()[0] for c in schema.split(", ")])

    counts = strengths.groupBy("s").agg(F.sum("good").alias("up"), F.count(F.lit(1)).alias("n"))
    parts = sorted(counts.repartitionByRange("s").sortWithinPartitions("s").mapInArrow(run, schema).collect(), key=lambda p: p["first"])
    gain, mass, best, cut, share = 0.0, 0.0, 0.0, parts[0]["first"], 0.0  # reject none
    for k, p in enumerate(parts):
        if gain + p["best"] > best:
            follows = parts[k + 1]["first"] if k + 1 < len(parts) else p["last"]
            best, cut = gain + p["best"], (p["below"] + (follows if p["above"] is None else p["above"])) / 2
            share = mass + p["share"]
        gain, mass = gain + p["gain"], mass + p["mass"]
    return float(cut), float(share)


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "score",
               keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if none are named) with ``out``, the
    model's score of each whole text, 0 to 1 (null and empty texts too)."""
    small_batches(df.sparkSession)
    keep = [c for c in (keep or df.columns) if c.lower() != out.lower()]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(len(keep)).cast(pa.binary()).to_pylist()
            x = np.array([statistics(t) for t in raw]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.score(x))], names=[*keep, out])

    (body,) = fresh(df, "body")
    return df.select(*keep, F.col(text).alias(body)).mapInArrow(run, schema)
