"""Columns of rows of different length as one flat array and offsets, and distinct words of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def edges_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of rows with these lengths, 0 first."""
    edges = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=edges[1:])
    return edges


def runs_of(edges: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, stop) ranges of rows with at most ``most`` values together, one row at least."""
    start = 0
    while start < len(edges) - 1:
        stop = int(np.searchsorted(edges, edges[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), len(edges) - 1)
        yield start, stop
        start = stop


def take_rows(flat: np.ndarray, edges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen rows (in order, repeats allowed) as a new flat array and its offsets."""
    lengths = (edges[1:] - edges[:-1])[rows]
    out = edges_of(lengths)
    at = np.repeat(edges[rows] - out[:-1], lengths)
    at += np.arange(out[-1])
    return flat[at], out


def binary_rows(flat: np.ndarray, edges: np.ndarray, kind: pa.DataType = pa.large_binary()) -> pa.Array:
    """Each row's bytes; ``kind`` is ``large_binary`` or ``large_string``."""
    raw = np.ascontiguousarray(flat)
    return pa.Array.from_buffers(kind, len(edges) - 1, [None, pa.py_buffer(edges * raw.itemsize), pa.py_buffer(raw)])


def distinct_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words and, for every word, its place among them."""
    coded = pc.dictionary_encode(words)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def split_rows(split: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat words and row offsets of a list array (as Arrow's split functions return)."""
    offsets = split.offsets.to_numpy().astype(np.int64)
    return split.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


class WordRows:
    """Rows of numbers kept for words in Arrow and numpy, so that a batch's words are looked up together."""

    def __init__(self, dtype: str, most: int, first: dict[str, list[int]] | None = None):
        self.dtype, self.most, self.first = dtype, most, first or {}
        self._forget()

    def _forget(self) -> None:
        self.names = pa.array(list(self.first), pa.large_string())
        self.flat = np.array([x for row in self.first.values() for x in row], self.dtype)
        self.edges = edges_of(np.array([len(row) for row in self.first.values()], np.int64))

    def rows(self, words: pa.Array, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Row of each of some distinct words; ``learn`` gives the flat rows and offsets of new ones.
        Beyond ``most`` words the rest is forgotten, so rows hold until the next call."""
        found = pc.index_in(words, self.names)
        new = words.filter(pc.is_null(found))
        if len(new) and len(self.names) + len(new) > self.most:
            self._forget()
            found = pc.index_in(words, self.names)
            new = words.filter(pc.is_null(found))
        at = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(new):
            flat, edges = learn(new.to_pylist())
            at[at < 0] = np.arange(len(self.names), len(self.names) + len(new))
            self.names = pa.concat_arrays([self.names, new])
            self.flat = np.concatenate([self.flat, flat])
            self.edges = np.concatenate([self.edges, edges[1:] + self.edges[-1]])
        return at
