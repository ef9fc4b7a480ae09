"""Helpers that run inside Python workers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import repeat

import numpy as np

_KEPT: dict[object, object] = {}


def once(key: object, make: Callable[[], object]):
    """``make()``, kept for the later tasks of this worker process (one object per kind of key)."""
    if key not in _KEPT:
        for old in [k for k in _KEPT if isinstance(k, tuple) and isinstance(key, tuple) and k[0] == key[0]]:
            del _KEPT[old]
        _KEPT[key] = make()
    return _KEPT[key]


class WordIds:
    """Remembers the ids of words: ``encode_new`` gets a list of words and
    returns their ids end to end and the number of ids of each. The memory
    starts anew beyond ``most`` words, so it stays bounded."""

    def __init__(self, encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 200_000):
        self.encode_new, self.most = encode_new, most
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.known) > self.most:
            self.forget()
        code = np.array(list(map(self.known.get, words, repeat(-1))), np.int64)
        if len(gaps := np.flatnonzero(code < 0)):
            missing = [words[k] for k in gaps.tolist()]
            new = list(dict.fromkeys(missing))
            flat, size = self.encode_new(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(size)])
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            code[gaps] = list(map(self.known.__getitem__, missing))
        size = self.starts[code + 1] - self.starts[code]
        total = np.cumsum(size)
        return self.flat[np.repeat(self.starts[code] - (total - size), size) + np.arange(total[-1])], size


class Folder:
    """A folder of the shared store, by URI. Files get names of their own, so a
    task that runs again never meets the files of an earlier attempt."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.store, self.root = fs.FileSystem.from_uri(uri)
        self.store.create_dir(self.root, recursive=True)

    def new_file(self, suffix: str):
        """Name and output stream of a new file."""
        name = uuid.uuid4().hex + suffix
        return name, self.store.open_output_stream(f"{self.root}/{name}", compression=None)

    def write(self, suffix: str, data: bytes) -> str:
        name, out = self.new_file(suffix)
        with out:
            out.write(data)
        return name

    def open(self, name: str):
        return self.store.open_input_file(f"{self.root}/{name}")

    def read(self, name: str) -> bytes:
        with self.open(name) as f:
            return f.read()
