"""Encoding whole texts with a public byte-level tokenizer, word by word from a cache.

The pre-tokenizer of a byte-level vocabulary never reaches from a sign that is
not white space over the white space after it, so where every white space
stands alone, lines and words can be encoded apart: a line break is a piece of
its own, a word after a space starts with that space, and a mark that ends a
word is a piece of its own. Each distinct word is encoded once by the
tokenizers library and kept. Texts with white space next to white space, at
their ends or of other kinds are cut before spaces that follow another sign only.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import batches_of
from .ragged import WordRows, distinct_words, edges_of, split_rows, take_rows

#: Words kept in one worker process, of each kind.
CACHE_WORDS = 1_000_000
#: Text encoded at a time, in bytes.
TEXT_BYTES = 4 << 20
#: Words encoded in one text.
RUN = 500

#: Texts with white space next to white space, at an end or of other kinds than space and line break.
_ODD = "^$|^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_CUT = re.compile(r"(?<=\S)(?= )")


class WordEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.kind).itemsize
        self.dtype = f"<u{self.width}"
        vocabulary = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that begin with a space
        self.starts[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.plain = WordRows(self.dtype, CACHE_WORDS)  # by text
        self.spaced = WordRows(self.dtype, CACHE_WORDS)  # by the word that follows a space

    def _learn_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = []
        for lo in range(0, len(texts), 4096):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(texts[lo : lo + 4096], add_special_tokens=False)]
        return np.array([i for one in ids for i in one], self.dtype), edges_of(np.array([len(one) for one in ids], np.int64))

    def _learn_spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words are encoded in one text a run and cut where a piece begins with a space."""
        flat, edges = [np.zeros(0, self.dtype)], [np.zeros(1, np.int64)]
        for lo in range(0, len(words), RUN):
            part = words[lo : lo + RUN]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            at = np.flatnonzero(self.starts[ids])
            if len(at) != len(part) or at[0]:  # a word without a piece that begins with the space
                ids, own = self._learn_plain([" " + w for w in part])
                at = own[:-1]
            flat.append(ids)
            edges.append(edges[-1][-1] + np.append(at[1:], len(ids)))
        return np.concatenate(flat), np.concatenate(edges)

    def encode(self, texts: list[str], tail: int | None = None) -> list[bytes]:
        """Little-endian ids of every text (``width`` bytes an id), each with ``tail`` after it."""
        column, out = pa.array(texts, pa.large_string()), []
        for lo, hi in batches_of(column, TEXT_BYTES):
            ids, rows = self.encode_array(column.slice(lo, hi - lo), tail)
            raw, edges = ids.tobytes(), (rows * self.width).tolist()
            out += [raw[a:b] for a, b in zip(edges[:-1], edges[1:])]
        return out

    def encode_array(self, texts: pa.Array, tail: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (none null), each text's with ``tail`` after them, and the row offsets."""
        texts = texts.cast(pa.large_string())
        uneven = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        even_ids, even_rows = self._even(texts.filter(pa.array(~uneven)))
        odd_ids, odd_rows = self._odd(texts.filter(pa.array(uneven)).to_pylist())
        order = np.empty(len(texts), np.int64)
        order[~uneven], order[uneven] = np.arange((~uneven).sum()), np.arange((~uneven).sum(), len(texts))
        rows = np.concatenate([even_rows, odd_rows[1:] + even_rows[-1]])
        ids, rows = take_rows(np.concatenate([even_ids, odd_ids]), rows, order)
        if tail is None:
            return ids, rows
        rows = rows + np.arange(len(rows))
        out = np.full(rows[-1], tail, ids.dtype)
        own = np.ones(len(out), bool)
        own[rows[1:] - 1] = False
        out[own] = ids
        return out, rows

    def _even(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts where all white space stands alone: Arrow cuts them and finds the distinct words."""
        words, rows = split_rows(pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " "))
        names, place = distinct_words(words)
        breaks = place == pc.index(names, pa.scalar("\n", pa.large_string())).as_py()
        alone = breaks.copy()  # no space goes before line breaks, the words after them, and first words
        alone[rows[:-1]] = True
        alone[1:] |= breaks[:-1]
        codes = place * 2 + alone
        used = np.bincount(codes, minlength=2 * len(names)).astype(bool)
        row = np.zeros(2 * len(names), np.int64)
        row[0::2][used[0::2]] = self.spaced.rows(names.filter(pa.array(used[0::2])), self._learn_spaced)
        row[1::2][used[1::2]] = self.plain.rows(names.filter(pa.array(used[1::2])), self._learn_plain) + len(self.spaced.names)
        edges = np.concatenate([self.spaced.edges, self.plain.edges[1:] + self.spaced.edges[-1]])
        ids, edges = take_rows(np.concatenate([self.spaced.flat, self.plain.flat]), edges, row[codes])
        return ids, edges[rows]

    def _odd(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [_CUT.split(text) for text in texts]
        names, place = distinct_words(pa.array([p for parts in cut for p in parts], pa.large_string()))
        row = self.plain.rows(names, self._learn_plain)
        ids, edges = take_rows(self.plain.flat, self.plain.edges, row[place])
        return ids, edges[edges_of(np.array([len(parts) for parts in cut], np.int64))]


_ENCODERS: dict[str, WordEncoder] = {}  # of a worker process


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
