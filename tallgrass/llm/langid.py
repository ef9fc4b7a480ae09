"""Language identification by cross-parsing entropy.

A suffix automaton of a sample of each language answers, character by
character, how far a text can be followed inside that sample. Parsing a text
greedily into the longest phrases that occur in a sample, the language that
needs the fewest phrases for each character of the text wins. A phrase weighs
the same in every language, however small its sample; a character that a sample
lacks costs ``LITERAL`` phrases, so a language of a few words can't win by
having little to point into.

Texts are parsed whole. To parse many characters at once, a text is cut into
windows: all windows of a batch are followed side by side from the start state,
one numpy lookup a step. Then each window is followed again from the state that
the window before it ended in, until that meets the state of the first pass at
the same character; from there both are one. Where they do not meet inside the
window, the next one is followed again as well. The result is the parse of the
whole text, character for character.

Every language of the training rows whose sample holds a letter has an
automaton, and every letter of the samples a number of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, id_crc, small_batches

#: Sample of a language: characters and documents; characters of all samples.
SAMPLE_CHARS, SAMPLE_DOCS, TOTAL_CHARS = 24_000, 400, 1_500_000
#: Phrases that a character costs which the sample lacks.
LITERAL = 2
WINDOW_CHARS = 512
UNKNOWN = "und"


@dataclass
class Automaton:
    """Transitions of a suffix automaton: that of state ``s`` by ``c`` is in cell
    ``(base[s] + c) % len(cells)``, if the cell's upper half is ``s``, and leads
    to the lower half. State 0 is the start; 0 as a target means none."""

    base: np.ndarray
    cells: np.ndarray
    root: np.ndarray  # targets of state 0

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        cell = self.cells[(self.base[state] + c) & (len(self.cells) - 1)]
        return np.where(cell >> 32 == state, cell & 0xFFFFFFFF, 0)


def automaton(seq: list[int], width: int) -> Automaton:
    """The suffix automaton of ``seq`` (values below ``width``)."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return packed(nxt, width)


def packed(nxt: list[dict[int, int]], width: int, size: int = 0) -> Automaton:
    """The transitions in ``size`` cells, half of them free at least: states with
    most transitions first, each at the first of a series of mixed bases where
    all its cells are free. Twice the cells if that takes too many tries."""
    size = size or 1 << max(2 * sum(map(len, nxt)), width).bit_length()
    mask, base, cells, at, tries = size - 1, [0] * len(nxt), [-1] * size, 0, 4 * len(nxt) + 64
    for s in sorted(range(len(nxt)), key=lambda s: -len(nxt[s])):
        row = nxt[s]
        while any(cells[(at + c) & mask] >= 0 for c in row):
            at, tries = (at * 1664525 + 1013904223) & mask, tries - 1
            if tries < 0:
                return packed(nxt, width, 2 * size)
        base[s] = at
        for c, to in row.items():
            cells[(at + c) & mask] = s << 32 | to
    root = np.zeros(width, np.int64)
    root[list(nxt[0])] = list(nxt[0].values())
    return Automaton(np.array(base, np.int64), np.array(cells, np.int64), root)


def letter_classes() -> np.ndarray:
    """For every code point: 0 for no letter, else the code point of its lower case."""
    out = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@dataclass
class Model:
    languages: list[str]
    alphabet: list[int]  # code points; number 0 is the blank, 1 a letter that no sample holds
    samples: list[np.ndarray]  # numbers of the characters
    bits: float  # of a phrase: a place in the longest sample

    def codes(self) -> np.ndarray:
        """Number of every code point."""
        lower = letter_classes()
        number = np.ones(0x110000, np.int32)
        number[self.alphabet] = np.arange(2, 2 + len(self.alphabet))
        return np.where(lower > 0, number[lower], 0).astype(np.int32)

    def automata(self) -> list[Automaton]:
        """One for each language, some hundred bytes for each character of its sample."""
        return [automaton(seq.tolist(), len(self.alphabet) + 2) for seq in self.samples]


def numbered(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all texts' characters with runs of non-letters as one blank,
    and how many each text has. Texts do not begin with a blank."""
    joined = "".join(texts)
    seq = codes[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum([len(t) for t in texts])
    before = np.concatenate([[0], seq[:-1]]) if len(seq) else seq
    first = (ends - [len(t) for t in texts])
    before[first[first < len(seq)]] = 0
    keep = (seq > 0) | (before > 0)
    upto = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
    return seq[keep], np.diff(upto)


@dataclass
class Windows:
    """Windows of the texts, long ones first."""
    starts: np.ndarray
    sizes: np.ndarray
    owner: np.ndarray  # the text
    after: np.ndarray  # the next window of the text, or -1


def windows_of(size: np.ndarray) -> Windows:
    """Windows of texts that lie end to end and have ``size`` characters each."""
    many = -(-size // WINDOW_CHARS)
    owner = np.repeat(np.arange(len(size)), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    sizes = np.minimum(WINDOW_CHARS, size[owner] - nth * WINDOW_CHARS)
    order = np.argsort(-sizes, kind="stable")
    place = np.empty(len(owner), np.int64)
    place[order] = np.arange(len(owner))
    after = np.append(place[1:], 0)[:len(owner)]
    after[nth == many[owner] - 1] = -1
    return Windows((np.cumsum(size) - size)[owner][order] + nth[order] * WINDOW_CHARS, sizes[order], owner[order], after[order])


def phrases(seq: np.ndarray, w: Windows, table: Automaton, texts: int) -> np.ndarray:
    """Phrases of each text when parsed with an automaton."""
    def step(state: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after the characters at some places, and the phrases that they end."""
        c = seq[at]
        again, to = table.root[c], table.step(state, c)
        end = to == 0
        return np.where(end, again, to), (end & (state > 0)) + LITERAL * (end & (again == 0))

    state, count = np.zeros(len(w.starts), np.int64), np.zeros(len(w.starts), np.int64)
    first, ended = np.zeros(len(seq), np.int32), np.zeros(len(seq), np.int8)  # of each character in the first pass
    active = len(w.starts)
    for t in range(int(w.sizes.max(initial=0))):
        active = int(np.searchsorted(-w.sizes[:active], -t, "left"))
        at = w.starts[:active] + t
        state[:active], ends = step(state[:active], at)
        first[at], ended[at] = state[:active], ends
        count[:active] += ends

    some = np.flatnonzero((w.after >= 0) & (state > 0))
    again, enter = w.after[some], state[some]
    last = state.copy()  # states that the windows end in
    moved = np.zeros(len(state), np.int64)  # phrases more than in the first pass
    while len(again):
        moved[again], ends_in = 0, state[again]
        k, here, t = np.arange(len(again)), enter, 0
        while len(k):
            at = w.starts[again[k]] + t
            here, ends = step(here, at)
            moved[again[k]] += ends - ended[at]
            apart, inside = here != first[at], t + 1 < w.sizes[again[k]]
            out = apart & ~inside
            ends_in[k[out]] = here[out]
            k, here, t = k[apart & inside], here[apart & inside], t + 1
        new = ends_in != last[again]
        last[again] = ends_in
        some = again[new & (w.after[again] >= 0)]
        again, enter = w.after[some], last[some]
    return np.bincount(w.owner, count + moved + ((w.after < 0) & (last > 0)), texts)


def entropies(texts: list[str], model: Model, codes: np.ndarray, automata: list[Automaton] | None = None) -> np.ndarray:
    """Bits per character of each text (row) under each language; NaN for texts without a letter."""
    seq, size = numbered(texts, codes)
    cut = windows_of(size)
    out = np.full((len(texts), len(model.languages)), np.nan)
    some = size > 0
    for k, table in enumerate(model.automata() if automata is None else automata):
        out[some, k] = phrases(seq, cut, table, len(texts))[some] * model.bits / size[some]
    return out


def train(docs: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang", sample_chars: int = SAMPLE_CHARS,
          sample_docs: int = SAMPLE_DOCS, total_chars: int = TOTAL_CHARS) -> Model:
    """Samples from the rows whose id is not held out and whose language is known.

    Of each language the documents are put in the order of a hash of the id,
    those of more than a tenth of ``sample_chars`` last, and joined whole until
    there are ``sample_chars`` characters (the last one is cut there) or
    ``sample_docs`` documents. Languages share ``total_chars``, so the driver and
    the workers hold a bounded amount however many there are. Of rows that share
    an id and a language the one with the smallest text counts. A language whose
    sample has no letter is not learned; one with a tiny sample is, and wins only
    texts that its sample covers in fewer phrases than the others do. Without
    such rows the model knows no language and every text is ``und``.
    """
    known = docs.filter(F.col(lang).isNotNull() & (id_crc(id_col) % 4 != 2)).select(
        F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    sizes = known.select("id", "lang").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a language
    if not sizes:
        return build({})
    chars = max(1, min(sample_chars, total_chars // len(sizes)))
    counts = docs.sparkSession.createDataFrame(sizes, "lang string, n long")
    # A hash keeps some four times as many as are taken, and all of a small language: no task ranks a whole language.
    drawn = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) * F.col("n") < F.lit(4 * sample_docs << 30)
    rows = (known.join(F.broadcast(counts), "lang").filter(drawn).groupBy("lang", "id")
            .agg(F.min(F.substring("body", 1, chars)).alias("body")))
    order = Window.partitionBy("lang").orderBy(F.length("body") > sample_chars // 10, F.xxhash64("id"), "id")
    before = F.sum(F.length("body") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1))
    taken = (rows.select("lang", "body", F.row_number().over(order).alias("k"), F.coalesce(before, F.lit(0)).alias("before"))
             .filter((F.col("k") <= sample_docs) & (F.col("before") < chars)).collect())
    samples: dict[str, list[str]] = {}
    for r in sorted(taken, key=lambda r: (r["lang"], r["k"])):
        samples.setdefault(r["lang"], []).append(r["body"] + "\n")
    return build({name: "".join(s)[:chars] for name, s in samples.items()})


def build(samples: dict[str, str]) -> Model:
    """A model from one sample text per language; those without a letter are left out."""
    lower = letter_classes()
    used = {name: lower[[ord(c) for c in s]] for name, s in samples.items() if s}
    used = {name: found for name, found in used.items() if found.any()}
    letters = np.unique(np.concatenate([[0], *used.values()]))
    model = Model(sorted(used), [int(c) for c in letters if c > 0], [], 0.0)
    codes = model.codes()
    for name in model.languages:
        model.samples.append(numbered([samples[name]], codes)[0].astype(np.int32))
    model.bits = float(np.log2(max(map(len, model.samples), default=0) + 2))
    return model


def with_language(df: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score",
                  keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if none are named) with the
    language of each whole text and how clear it is, 0 to 1. Null texts and
    texts without a letter are ``und`` with score 0; of languages with equal
    entropy the first by name wins."""
    spark = df.sparkSession
    small_batches(spark)
    keep = [c for c in (keep or df.columns) if c.lower() not in (out.lower(), score.lower())]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())])
    # bounded by the characters of all samples
    shared = spark.sparkContext.broadcast((replace(model, samples=[]), model.codes(), model.automata()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, codes, automata = shared.value
        names = np.array([*known.languages, UNKNOWN], object)
        for batch in batches:
            h = entropies([t or "" for t in batch.column(len(keep)).to_pylist()], known, codes, automata)
            none = np.isnan(h).all(1)
            h[none] = 0.0
            best = h.argmin(1) if h.shape[1] else np.zeros(len(h), int)
            sure = 1 / np.maximum(1, np.exp(-10 * (h - h.min(1, initial=np.inf, keepdims=True))).sum(1))
            cols = [pa.array(names[np.where(none, len(names) - 1, best)], pa.string()), pa.array(np.where(none, 0.0, sure))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=[*keep, out, score])

    (body,) = fresh(df, "body")
    return df.select(*keep, F.col(text).alias(body)).mapInArrow(run, schema)
