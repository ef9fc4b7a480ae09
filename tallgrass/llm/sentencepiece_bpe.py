"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

A normalised text is first cut wherever its two neighbouring characters are
neighbours in no piece: no merge can ever span such a place, so the segments
("words") are independent and each distinct one is encoded once for as long as a worker remembers it.

The words of a batch lie in one flat numpy array of symbols. Each round finds
the lowest pair rank of every word (segmented minimum), merges all its
occurrences at once from the left, compacts the array, and retires the words
that have no pair left. The library merges one pair at a time; doing all at
once gives the same pieces unless a merge creates a pair of the same or a lower
rank. Words where that happens are finished one merge at a time, with a heap.
Characters without a piece become byte pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import fresh, small_batches
from .worker import WordIds, once

SPACE = "▁"
NONE = np.int32(2**31 - 1)
#: Characters worked on at once.
CHUNK_CHARS = 1 << 20


class Pieces:
    """A model's pieces as lookup arrays."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        byte = {int(names[i], 16): i for i in range(n) if sp.is_byte(i) for names[i] in [names[i][1:-1]]}
        if len(byte) != 256:
            raise ValueError("the model has no byte pieces")
        self.byte_ids = [byte[b] for b in range(256)]
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.byte_ids] = True
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        ids = {names[i]: i for i in normal}
        self.vocab = n
        chars = sorted({c for p in ids for c in p})
        for c in chars:  # a character of some piece that is no piece itself can still be merged
            ids.setdefault(c, len(names))
            if ids[c] == len(names):
                names.append(c)
        self.names, self.total = names, len(names)
        # characters: 0 stands for those in no piece
        self.char_no = np.zeros(0x110000, np.int32)
        self.char_no[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_sym = np.concatenate([[-1], [ids[c] for c in chars]]).astype(np.int32)
        self.near = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in ids:
            if len(p) > 1:
                at = self.char_no[[ord(c) for c in p]]
                self.near[at[:-1], at[1:]] = True
        # pairs: rank by falling score, equal scores share a rank
        score = {i: sp.get_score(i) for i in normal}
        rank = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = [(ids[p[:k]] * self.total + ids[p[k:]], rank[score[i]], i) for p, i in ids.items() if i < n
                 for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        pairs.sort()
        self.keys, ranks, merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.ranks, self.merged = ranks.astype(np.int32), merged.astype(np.int32)
        self.text = [b"" if i < n and sp.is_control(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte_ids):
            self.text[i] = bytes([b])
        self.text[sp.unk_id()] = " ⁇ ".encode()
        self.opens = [i < n and names[i].startswith(SPACE) and not self.is_byte[i] for i in range(n)]
        self.strips = sp.normalize("x").startswith(SPACE)
        self.words = WordIds(self.learn)

    # ---- merging

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if there is no such piece) and merged symbol of each pair."""
        key = left.astype(np.int64) * self.total + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def one_by_one(self, sym: list[int]) -> list[int]:
        """The same merges with a heap, for one word."""
        sym, n = list(sym), len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: np.ndarray) -> None:
            i = i[i >= 0]
            if len(i):
                a = np.array([sym[x] for x in i])
                b = np.array([sym[after[x]] for x in i])
                rank, merged = self.pair(a, b)
                for x, s, t, r, m in zip(i.tolist(), a.tolist(), b.tolist(), rank.tolist(), merged.tolist(), strict=True):
                    if r != NONE:
                        heapq.heappush(heap, (r, x, s, t, m))

        push(np.arange(n - 1))
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = m, -2
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(np.array([before[i], i if after[i] < n else -1]))
        return [s for s in sym if s != -2]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words after all merges, end to end, and how many each word has."""
        cps = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym = self.char_sym[self.char_no[cps]]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        over: list[tuple[np.ndarray, np.ndarray]] = []  # symbols and word numbers of finished words
        rank, merged = np.full(len(sym), NONE), np.zeros(len(sym), np.int32)
        at = np.flatnonzero(word[1:] == word[:-1])
        rank[at], merged[at] = self.pair(sym[at], sym[at + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            done = low == NONE
            over.append((sym[done], word[done]))
            # every other one of a run of overlapping occurrences, from the left
            i = np.flatnonzero((rank == low) & ~done)
            if not len(i):
                break
            run = np.maximum.accumulate(np.where(np.diff(i, prepend=-2) != 1, i, -1))
            i = i[(i - run) % 2 == 0]
            new, keep, here = sym.copy(), ~done, np.zeros(len(sym) + 2, bool)
            new[i], keep[i + 1], here[i] = merged[i], False, True
            # the pairs that one merge at a time would also see: with the right neighbour not merged yet
            beside = i[here[i + 2]]
            beside = beside[word[beside] == word[beside + 2]]
            seen, _ = self.pair(merged[beside], sym[beside + 2])
            odd = word[beside[seen <= low[beside]]]
            p = (np.cumsum(keep) - 1)[i]
            sym, word, rank, merged, low = new[keep], word[keep], rank[keep], merged[keep], low[keep]
            touched = np.zeros(len(sym), bool)
            touched[p], touched[np.maximum(p - 1, 0)] = True, True
            rank[touched] = NONE
            touched[:-1] &= word[1:] == word[:-1]
            touched[-1] = False
            at = np.flatnonzero(touched)
            rank[at], merged[at] = self.pair(sym[at], sym[at + 1])
            odd = np.unique(np.concatenate([odd, word[at[rank[at] <= low[at]]]]))
            if len(odd):
                for w in odd.tolist():
                    one = np.array(self.one_by_one(self.char_sym[self.char_no[[ord(c) for c in words[w]]]].tolist()))
                    over.append((one, np.full(len(one), w)))
                stay = ~np.isin(word, odd)
                sym, word, rank, merged = sym[stay], word[stay], rank[stay], merged[stay]
        flat, word = (np.concatenate(x) for x in zip(*over, strict=True))
        return flat[np.argsort(word, kind="stable")].astype(np.int32), np.bincount(word, minlength=len(words))

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each."""
        flat, size = self.merge_words(words)
        if len(bad := np.flatnonzero((flat < 0) | (flat >= self.vocab))):  # no piece: its bytes
            ends, names = np.cumsum(size), {}
            for k in bad.tolist():
                w = int(np.searchsorted(ends, k, "right"))
                names[k] = words[w] if flat[k] < 0 else self.names[flat[k]]
                size[w] += len(names[k].encode()) - 1
            flat = np.array([y for k, x in enumerate(flat.tolist())
                             for y in ([self.byte_ids[b] for b in names[k].encode()] if k in names else (x,))], np.int32)
        return flat, size

    # ---- whole texts

    def cuts(self, s: str) -> list[str]:
        """``s`` in pieces of about CHUNK_CHARS, cut where no merge can span."""
        out, a = [], 0
        while len(s) - a > CHUNK_CHARS:
            b = a + CHUNK_CHARS
            while b < len(s) and self.near[self.char_no[ord(s[b - 1])], self.char_no[ord(s[b])]]:
                b += 1
            out.append(s[a:b])
            a = b
        return [*out, s[a:]]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units end to end, and the number of ids of each. No unit is empty."""
        joined = "".join(units)
        no = self.char_no[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum([len(u) for u in units])
        cut = ~self.near[no[:-1], no[1:]]
        cut[ends[:-1] - 1] = True
        stop = np.append(np.flatnonzero(cut) + 1, len(no))
        words = [joined[a:b] for a, b in zip(np.append(0, stop[:-1]).tolist(), stop.tolist(), strict=True)]
        ids, size = self.words.ids(words)
        upto = np.cumsum(size)[np.searchsorted(stop, ends)]
        return ids, np.diff(upto, prepend=0)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text (null: none)."""
        counts, parts, units, owner, held = np.zeros(len(texts), np.int64), [], [], [], 0

        def flush() -> None:
            nonlocal units, owner, held
            if units:
                ids, n = self.encode_units(units)
                parts.append(ids)
                np.add.at(counts, owner, n)
                units, owner, held = [], [], 0

        for k, t in enumerate(texts):
            for u in self.cuts(self.sp.normalize(t)) if t else ():
                if u:
                    units.append(u)
                    owner.append(k)
                    held += len(u)
                if held >= CHUNK_CHARS:
                    flush()
        flush()
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), counts

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, as the library's ``decode`` gives it."""
        raw = b"".join(map(self.text.__getitem__, ids))
        lead = next((i for i in ids if self.text[i]), None)
        drop = int(self.strips and lead is not None and self.opens[lead])
        try:
            return raw.decode()[drop:]
        except UnicodeDecodeError:
            pass
        out, k = [], 0  # one replacement character for each byte that is part of no character
        while k < len(raw):
            n = 1 if raw[k] < 0x80 else 2 if raw[k] < 0xE0 else 3 if raw[k] < 0xF0 else 4
            try:
                out.append(raw[k:k + n].decode())
                k += n
            except UnicodeDecodeError:
                out.append("�")
                k += 1
        return "".join(out)[drop:]


def encode_decode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids",
                  decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids`` (array of int: the whole text's piece ids, no begin
    or end id) and, if named, ``decoded``: the text those ids decode to.

    Null and empty texts have no ids and decode to an empty text. Columns of
    ``df`` with these names are replaced; all others are handed through.
    """
    spark = df.sparkSession
    small_batches(spark)
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    made = [c.lower() for c in (ids, decoded) if c]
    kept = [f for f in df.schema.fields if f.name.lower() not in made]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType()))]
                          + ([T.StructField(decoded, T.StringType())] if decoded else []))
    names, (body,) = [f.name for f in kept], fresh(df, "text_to_encode")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = once(("pieces", hash(model.value)), lambda: Pieces(model.value))
        for batch in batches:
            flat, counts = pieces.encode(batch.column(body).to_pylist())
            ends = np.concatenate([[0], np.cumsum(counts)])
            cols = [batch.column(k) for k in range(len(names))]
            cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
            if decoded:
                every, e = flat.tolist(), ends.tolist()
                cols.append(pa.array([pieces.decode(every[a:b]) for a, b in zip(e[:-1], e[1:], strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=[*names, ids, *([decoded] if decoded else [])])

    return df.select(*names, df[text].alias(body)).mapInArrow(run, schema)
