"""Token-id files as wavelet matrices.

A shard file holds the ids of a run of documents in ascending id order. Bit
planes run from the highest bit of an id to the lowest; each plane is stored in
the order that a stable partition by all higher bits leaves, with running
counts of ones every 512 bits. Any token can be read (``access``), counted up
to a position (``count``) or located (``locate``) from the planes and counts
alone. Planes, counts and document table are compressed one by one inside the
file, whose head says where each lies.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_ROWS, borrowed, partitions, shared_path, small_batches, written
from .worker import Folder, WordIds, once

MAGIC = b"WVMX0002"
STEP = 512  # bits between running counts
#: Words of letters that are composed already (ASCII and Latin-1), with or without a mark at the end.
PLAIN = "^[A-Za-zªµºÀ-ÖØ-öø-ÿ]+[.,]?$"
#: Ids after which a shard is closed, and most reading tasks for each partition of a shuffle.
SHARD_TOKENS, MOST_TASKS = 2_000_000, 16


class WaveletMatrix:
    """Bit planes of a sequence of unsigned 32-bit ids."""

    def __init__(self, n: int, planes: list[np.ndarray], ones: list[np.ndarray]):
        self.n, self.planes = n, planes  # packed bits, lowest bit first
        self.ones = ones  # of each plane, before every STEP bits and at the end
        self.zeros = [n - int(o[-1]) for o in ones]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(ids.max(initial=0)).bit_length())
        a, planes = ids.astype(np.uint16 if levels <= 16 else np.uint32), []
        for level in range(levels - 1, -1, -1):
            bit = ((a >> level) & 1).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            a = np.concatenate([a[~bit], a[bit]])
        counts = [np.bitwise_count(np.pad(p, (0, -len(p) % (STEP // 8))).reshape(-1, STEP // 8)).sum(1, dtype=np.int64)
                  for p in planes]
        return cls(len(ids), planes, [np.concatenate([[0], np.cumsum(c)]) for c in counts])

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position of a plane."""
        block = at // STEP
        out = self.ones[level][block].copy()
        plane = np.pad(self.planes[level], (0, STEP // 8))
        byte = block * (STEP // 8)
        span = plane[byte[:, None] + np.arange(STEP // 8)]
        left = np.clip(at[:, None] - (byte[:, None] + np.arange(STEP // 8)) * 8, 0, 8)
        return out + np.bitwise_count(span & ((1 << left) - 1).astype(np.uint8)).sum(1, dtype=np.int64)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some positions."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for level, plane in enumerate(self.planes):
            bit = (plane[at // 8] >> (at % 8).astype(np.uint8)) & 1
            ones = self._rank(level, at)
            out = (out << np.uint32(1)) | bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return out

    def _follow(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences before ``end`` lie below the last plane."""
        a, b = 0, end
        if token >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            ra, rb = self._rank(level, np.array([a, b])).tolist()
            one = token >> (len(self.planes) - 1 - level) & 1
            a, b = (self.zeros[level] + ra, self.zeros[level] + rb) if one else (a - ra, b - rb)
        return a, b

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of a token before position ``end`` (all, if None)."""
        a, b = self._follow(token, self.n if end is None else end)
        return b - a

    def _select(self, level: int, one: int, k: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        upto = self.ones[level] if one else np.arange(len(self.ones[level])) * STEP - self.ones[level]
        block = int(np.searchsorted(upto, k, "right")) - 1
        bits = np.unpackbits(self.planes[level][block * STEP // 8:(block + 1) * STEP // 8], bitorder="little")
        return block * STEP + int(np.flatnonzero(bits == one)[k - int(upto[block])])

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        a, b = self._follow(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - level) & 1
            at = self._select(level, one, at - self.zeros[level] if one else at)
        return at

    def tokens(self) -> np.ndarray:
        """All ids, undoing the partitions from the lowest plane up."""
        small = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.n, small)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            up = np.empty_like(out)
            up[~bit], up[bit] = out[:self.zeros[level]], out[self.zeros[level]:]
            out = up | (bit.astype(small) << small(len(self.planes) - 1 - level))
        return out.astype(np.uint32)


def to_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard file's bytes."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    matrix = WaveletMatrix.of(ids)
    parts = [pack(json.dumps(doc_ids).encode()), pack(counts.astype("<i8").tobytes()),
             *[pack(p.tobytes()) for p in matrix.planes], *[pack(np.diff(o).astype("<u2").tobytes()) for o in matrix.ones]]
    head = struct.pack("<8sqqi", MAGIC, len(doc_ids), len(ids), len(matrix.planes))
    return head + struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts)


def from_file(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, ids per document and the wavelet matrix of a shard file."""
    import zstandard

    magic, _, n, levels = struct.unpack_from("<8sqqi", data)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    at = struct.calcsize("<8sqqi")
    sizes = struct.unpack_from(f"<{2 * levels + 2}q", data, at)
    at += 8 * (2 * levels + 2)
    parts = []
    for size in sizes:
        parts.append(zstandard.ZstdDecompressor().decompress(data[at:at + size]))
        at += size
    planes = [np.frombuffer(p, np.uint8) for p in parts[2:levels + 2]]
    ones = [np.concatenate([[0], np.cumsum(np.frombuffer(p, "<u2"), dtype=np.int64)]) for p in parts[levels + 2:]]
    return json.loads(parts[0]), np.frombuffer(parts[1], "<i8"), WaveletMatrix(n, planes, ones)


class WordTokenizer:
    """Whole texts through a ``tokenizers`` model that drops white space and
    works word by word. Words are split off and numbered for a whole batch by
    Arrow; the distinct ones come to lower-case parts, and parts are encoded once
    and remembered."""

    def __init__(self, spec: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_str(spec)
        conf = json.loads(spec)
        steps = conf["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in conf["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"] or \
                [s["type"] for s in steps] != ["Split", "ByteLevel"] or not steps[0]["invert"] or steps[1]["add_prefix_space"]:
            raise ValueError("not a tokenizer that works word by word")
        self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.shown = dict(zip(shown, shown, strict=True)) | {b: 256 + k for k, b in enumerate(hidden)}
        end = self.tok.model.end_of_word_suffix
        vocab = self.tok.get_vocab(with_added_tokens=False)
        if not end or any(chr(c) + end not in vocab or chr(c) not in vocab for c in self.shown.values()):
            raise ValueError("not a tokenizer of bytes with word ends")
        self.shown[ord(" ")] = ord(" ")
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(end)]] = True
        # the same model on words that are normalised and split already
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.parts = WordIds(self.encode_parts, 600_000)

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words as the tokenizer splits them; those that begin with a blank are to be split yet."""
        simple = [p for p in parts if p[0] != " "]
        lines = [" ".join(simple[k:k + 1000]) for k in range(0, len(simple), 1000)]
        lines = [x.encode().decode("latin-1").translate(self.shown) for x in lines]
        got = [e.ids for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.array([i for ids in got for i in ids], np.int32)
        size = np.diff(np.flatnonzero(self.last[flat]), prepend=-1) if len(flat) else np.zeros(0, np.int64)
        if len(simple) == len(parts):
            return flat, size
        each = iter(np.split(flat, np.cumsum(size)[:-1]))
        out = [next(each) if p[0] != " " else np.array(self.tok.encode(p[1:], add_special_tokens=False).ids, np.int32)
               for p in parts]
        return np.concatenate(out), np.array([len(x) for x in out])

    def encode_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words end to end, and the number of ids of each."""
        plain = np.asarray(pc.match_substring_regex(words, PLAIN).fill_null(False))
        # letters and perhaps a mark: the lower-case letters are a part, the mark another
        some = words.filter(pa.array(plain))
        marked = np.asarray(pc.match_substring_regex(some, r"[.,]$"))
        core = pc.utf8_lower(pc.utf8_rtrim(some, ".,"))
        mark = pc.utf8_slice_codeunits(some.filter(pa.array(marked)), -1)
        rest = [self.split(w.lower()) if (w.isascii() or max(w) <= "ÿ") and "<|" not in w else [" " + w]
                for w in strings(words.filter(pa.array(~plain)))]
        count = np.ones(len(words), np.int64)
        count[np.flatnonzero(plain)[marked]] = 2
        count[~plain] = [len(x) for x in rest]
        first = np.cumsum(count) - count
        # all parts in the order of the words, as places in one list of distinct ones
        made = pa.concat_arrays([core, mark, pa.array([p for x in rest for p in x], pa.string())]).dictionary_encode()
        number, place = np.asarray(made.indices), np.zeros(int(count.sum()), np.int64)
        at = first[plain]
        own = np.ones(len(place), bool)
        own[at], own[at[marked] + 1] = False, False
        place[at], place[at[marked] + 1], place[own] = np.split(number, [len(core), len(core) + len(mark)])
        flat, size = self.parts.ids(strings(made.dictionary))
        ids, each = spread(flat, size, place)
        upto = np.append(0, np.cumsum(each))[np.append(first, len(place))]
        return ids, np.diff(upto)

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each (null: none)."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        lists = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        flat, size = self.encode_words(words.dictionary)
        ids, each = spread(flat, size, np.asarray(words.indices))
        upto = np.append(0, np.cumsum(each))[np.append(0, np.cumsum(np.asarray(pc.list_value_length(lists))))]
        return ids, np.diff(upto)


def strings(words: pa.StringArray) -> list[str]:
    """Words, none of which holds a line break, as Python strings: joined and split, many times as fast as one by one."""
    lines = pa.ListArray.from_arrays([0, len(words)], words)
    return pc.binary_join(lines, "\n")[0].as_py().split("\n") if len(words) else []


def spread(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` (``size`` long each) numbered ``which``, end to end, and the length of each."""
    each = size[which]
    total = np.cumsum(each)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int32), each
    return flat[np.repeat((np.cumsum(size) - size)[which] - (total - each), each) + np.arange(total[-1])], each


def write_shards(df: DataFrame, tokenizer_path: str, end_id: int, text: str = "text", id_col: str = "doc_id",
                 folder: str | None = None, shard_tokens: int = SHARD_TOKENS, chunk_docs: int = BATCH_ROWS) -> tuple[str, DataFrame]:
    """Tokenize ``df``, append ``end_id`` to each document, and write shard
    files in ascending id order to ``folder`` (default: a fresh one in the
    shared checkpoint folder), ``chunk_docs`` documents at once.

    Returns the folder and the shard table: ``file``, ``start`` (ids before
    the shard), ``n_docs``, ``n_tokens``. Null texts count as empty and hold
    only the end id; null ids come first; rows with equal ids stand side by
    side in any order, in as many shards as they need. An empty table has no
    shards. Only files named in the table count: what a lost task left behind is
    never read. ``df`` should be a scan or a written table, so that a task that
    runs again numbers its rows the same way.
    """
    spark = df.sparkSession
    small_batches(spark)
    folder = folder or shared_path(spark, "token-shards")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = once(("words", hash(spec.value)), lambda: WordTokenizer(spec.value))
        out, part, no = Folder(folder), TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal docs, held, no
            counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            name = out.write(".wvm", to_file(docs, counts, ids))
            row = [[part], [no], [name], [len(docs)], [len(ids)]]
            docs, held, no = [], [], no + 1
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=["part", "no", "file", "n_docs", "n_tokens"])

        for batch in batches:
            for a in range(0, len(batch), chunk_docs):
                flat, counts = tok.encode(batch.column(1).slice(a, chunk_docs))
                docs += batch.column(0).slice(a, chunk_docs).to_pylist()
                held.append((counts + 1, np.insert(flat, np.cumsum(counts), end_id).astype(np.uint32)))
                if sum(len(ids) for _, ids in held) >= shard_tokens:
                    yield close()
        if docs:
            yield close()

    # the row number parts rows that share an id
    ordered = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("body"),
                        F.monotonically_increasing_id().alias("row")).repartitionByRange("id", "row") \
        .sortWithinPartitions("id", "row").select("id", "body")
    shards = written(ordered.mapInArrow(run, "part long, no long, file string, n_docs long, n_tokens long"), "shards")
    # ids before each writing task (a row each), and inside it before each shard
    tasks = shards.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("first") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    found = shards.join(tasks, "part").select("file", start.alias("start"), "n_docs", "n_tokens")
    return folder, borrowed(found, shards, folder=folder)


def read_shards(folder: str, shards: DataFrame) -> DataFrame:
    """Per document of the shard files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32`` (of its ids as
    little-endian unsigned 32-bit integers). Each shard holds SHARD_TOKENS ids or
    so, and a task reads one at a time; releasing the result deletes the shards."""
    small_batches(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Folder(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs, counts, matrix = from_file(store.read(name))
                raw = memoryview(matrix.tokens().astype("<u4").tobytes())
                ends = np.cumsum(counts)
                crc = [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(start + ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, min(shards.count(), MOST_TASKS * partitions(shards.sparkSession)))
    dealt = shards.select("file", "start").repartitionByRange(tasks, "start")
    return borrowed(dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"), shards)
