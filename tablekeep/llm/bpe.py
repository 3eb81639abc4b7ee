"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A sequence of pieces is what the merges make of a text exactly if every piece is
what they make of its own string and every pair of neighbours is what they make
of the pair's string. So a word is encoded without merging at all: an
Aho-Corasick automaton finds the longest piece that starts at each place, the
encoder goes on from left to right with the longest piece that is compatible with
the one before it, tries the next shorter prefix that is a piece where it is not,
and takes the last piece back where none is left. The merges of a prefix are
unique, so a place from which no piece goes on is dead for good and each place is
left at most once: the time is linear in the word.

Compatibility of a pair is decided by undoing the merges at the seam, latest
first, and kept in a table. It needs merges that make each piece in one way from
earlier pieces; other vocabularies are refused. The end-of-word mark is one more
sign after the word, which only word-final pieces contain.

Distinct words of a batch come from Arrow; each is encoded once by a worker and
kept, and the ids of a text are gathered from them. Normalising and cutting into
words is the tokenizers library's for words of other than ASCII signs and common Latin letters.

Defined results: null and empty texts, and texts of white space only, have no
ids and decode to the empty text; strings of special tokens in a text become
their ids, as the library does by default; repeated rows and rows with null ids
are encoded each; words of any length are encoded whole; an empty table gives an
empty table; columns other than the wanted ones are ignored. An id outside the
vocabulary decodes to nothing, as in the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import batches_of, pick
from .ragged import WordRows, binary_rows, distinct_words, edges_of, runs_of, split_rows, take_rows

#: Text handled at a time, in bytes.
TEXT_BYTES = 2 << 20
#: Words kept in one worker.
CACHE_WORDS = 500_000
#: Words encoded as one text.
RUN = 2000
#: Pairs kept in the compatibility table.
PAIRS = 200_000

#: The end-of-word mark inside this module: a sign that no byte maps to.
END = "\n"

#: Letters that lower-casing alone normalises, and signs that make one word where they stand together.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SIGNS_ONLY = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
_SIMPLE = rf"^[{_LETTERS}]*[!-&(-/:;=-@\[-`{{-~]*$"

#: The byte-level alphabet writes a byte as the sign of its number, and the bytes without a visible sign from here on.
_HIDDEN = {byte: chr(256 + n) for n, byte in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
_SIGNS = {c: "".join([_HIDDEN.get(b, chr(b)) for b in chr(c).encode()]) for c in range(0xC0, 0x100)}

#: Normalising and cutting of the vocabularies that this module reads (fixed values).
_NORMALIZER = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Pieces:
    """Pieces of a vocabulary, the automaton over them, and the pair-compatibility table."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.text = {i: p[: -len(suffix)] + END if p.endswith(suffix) and p != suffix else p for p, i in vocabulary.items()}
        self.ends = {i for i, t in self.text.items() if t.endswith(END)} | {-1}  # pieces that end a word, and the start
        self.final = np.isin(np.arange(max(self.text) + 1), list(self.ends))
        self.size = {i: len(t) for i, t in self.text.items()}
        self.rank: dict[int, int] = dict.fromkeys(self.text, -1)  # of the merge that makes the piece
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            whole, pair = vocabulary[left + right], (vocabulary[left], vocabulary[right])
            if whole in self.halves or max(self.rank[pair[0]], self.rank[pair[1]]) >= rank:
                raise ValueError("the merges must make each piece in one way, from earlier pieces")
            self.rank[whole], self.halves[whole], self.merge[pair] = rank, pair, rank
        self.pairs: dict[tuple[int, int], bool] = {}
        usable = self._usable()
        by_text = {self.text[i]: i for i in usable}
        self.shorter = {i: next((by_text[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_text), None) for i, t in ((i, self.text[i]) for i in usable)}
        self.automaton = ahocorasick.Automaton()
        for text, i in by_text.items():
            self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()

    def _usable(self) -> set[int]:
        """Pieces that the merges make of their own string."""
        good = {i for i in self.text if i not in self.halves and len(self.text[i].replace(END, "")) == 1}
        for whole, (left, right) in self.halves.items():  # by rank
            if left in good and right in good and self._seam(left, right, self.rank[whole]):
                good.add(whole)
        return good

    def _seam(self, a: int, b: int, below: int) -> bool:
        """Whether no merge of rank less than ``below`` ever joins the last sign of ``a`` to the first of ``b``.

        The pieces at the seam are undone in reverse order of their making. While a piece was not yet
        made, a merge across the seam had its chance if it came first: with a lower rank, or with the
        same rank further to the left.
        """
        merge, rank, halves = self.merge, self.rank, self.halves
        limit = below
        while True:
            crossing = merge.get((a, b))
            if crossing is not None and crossing < limit:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[b] >= rank[a]:  # made later, or at the same rank further to the right
                limit = rank[b] + 1  # a crossing merge of the same rank lies to the left and comes first
                b = halves[b][0]
            else:
                limit = rank[a]  # the merge inside ``a`` lies to the left
                a = halves[a][1]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` side by side."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        good = self.pairs[a, b] = self._seam(a, b, len(self.merge))
        return good

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of every word (byte-level signs, none empty) as one array, and where each word's end.

        The words are encoded as one text: nothing merges over an end-of-word mark.
        """
        text = END.join(words) + END
        longest: list[int | None] = [None] * (len(text) + 1)
        for end, (size, piece) in self.automaton.iter(text):
            longest[end - size + 1] = piece  # matches come by their end, so the longest comes last
        size, shorter, known, final = self.size, self.shorter, self.pairs.get, self.ends
        out: list[int] = [-1]  # what stands before the first piece
        at, dead, piece, stop = 0, set(), longest[0], len(text)
        while at < stop:
            last = out[-1]
            begins = last in final  # a word; nothing merges into the one before it
            while piece is not None:
                end = at + size[piece]
                good = begins or known((last, piece))
                if good is None:
                    good = self.compatible(last, piece)
                if good and end not in dead:
                    break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at, piece = end, longest[end]
            else:
                if last < 0:
                    raise ValueError(f"no pieces for {text[:40]!r}")
                dead.add(at)
                piece = out.pop()
                at -= size[piece]
                piece = shorter[piece]
        ids = np.array(out[1:], "<u4")
        return ids, np.flatnonzero(self.final[ids]) + 1


class Bpe:
    """Encoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("a plain BPE vocabulary is needed")
        if spec["decoder"] or spec["post_processor"]:
            raise ValueError("a vocabulary without decoder and post-processor is needed")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain")
        self.tokenizer = Tokenizer.from_file(path)
        if not model["end_of_word_suffix"]:
            raise ValueError("a vocabulary with an end-of-word mark is needed")
        self.pieces = Pieces({p: i for p, i in model["vocab"].items() if p not in added}, merges, model["end_of_word_suffix"])
        self.added = added
        self.marks = re.compile("(" + "|".join([re.escape(t) for t in sorted(added, key=len, reverse=True)] or ["(?!)"]) + ")")
        steps = [(s["type"], (s.get("pattern") or {}).get("Regex")) for s in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if steps != _NORMALIZER or (cuts[0].get("pattern") or {}).get("Regex") != _SPLIT:
            raise ValueError("a vocabulary of lower-cased words without white space is needed")
        self.words = WordRows("<u4", CACHE_WORDS, {t: [i] for t, i in added.items()} | {"": []})

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, edges = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for lo in range(0, len(words), RUN):
            ids, ends = self.pieces.encode([w[1:] if w[0] == END else w if w.isascii() else w.translate(_SIGNS) for w in words[lo : lo + RUN]])
            flat.append(ids)
            edges.append(ends + edges[-1][-1])
        return np.concatenate(flat), np.concatenate(edges)

    def _cut(self, stretch: str) -> list[str]:
        """Words and special tokens of any stretch without ASCII white space; words of byte-level signs
        outside ASCII have a mark before them, as Latin words in the cache are written in letters."""
        parts = self.marks.split(stretch) if "<" in stretch else [stretch]
        out = []
        for part in parts:
            if part in self.added:
                out.append(part)
            elif part:
                part = self.tokenizer.normalizer.normalize_str(part)
                out += [w if w.isascii() else END + w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (32-bit) and the row offsets into them.

        Letters with signs after them, the most common stretches, are lower-cased and cut by Arrow.
        """
        stretches, rows = split_rows(pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null("")))
        names, place = distinct_words(stretches)
        simple = pc.match_substring_regex(names, _SIMPLE).to_numpy(zero_copy_only=False)
        plain = names.filter(pa.array(simple))
        word, tail = pc.utf8_rtrim(pc.utf8_lower(plain), _SIGNS_ONLY), pc.replace_substring_regex(plain, f"^[{_LETTERS}]*", "")
        parts, at = distinct_words(pa.concat_arrays([word, tail]))
        cuts = [self._cut(name) for name in names.filter(pa.array(~simple)).to_pylist()]
        others, other_at = distinct_words(pa.array([w for c in cuts for w in c], pa.large_string()))
        extra = others.filter(pc.is_null(pc.index_in(others, parts)))
        known = pa.concat_arrays([parts, extra])
        row = self.words.rows(known, self._learn)
        of_others = row[pc.index_in(others, known).to_numpy(zero_copy_only=False).astype(np.int64)][other_at]
        of_plain = row[at].reshape(2, -1).T.ravel()  # a word and the signs after it
        units = edges_of(np.concatenate([np.full(len(plain), 2), np.array([len(c) for c in cuts], np.int64)]))
        order = np.empty(len(names), np.int64)
        order[simple], order[~simple] = np.arange(len(plain)), np.arange(len(plain), len(names))
        words, word_edges = take_rows(np.concatenate([of_plain, of_others]), units, order[place])
        ids, id_edges = take_rows(self.words.flat, self.words.edges, words)
        return ids, id_edges[word_edges[rows]]


class OffsetTable:
    """The strings of all pieces in one array, each after a space, and where each begins."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        table = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            table[i] = b" " + name.encode()
        self.signs = np.frombuffer(b"".join(table), np.uint8)
        self.places = edges_of(np.array([len(t) for t in table]))

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of every row's pieces with a space between, and the row offsets."""
        known = ids < len(self.places) - 1
        if not known.all():  # left out, as in the library
            ids, rows = ids[known], edges_of(known)[rows]
        signs, edges = take_rows(self.signs, self.places, ids.astype(np.int64))
        starts = edges[rows]
        first = starts[:-1][starts[1:] > starts[:-1]]  # the space before a row's first piece goes
        keep = np.ones(len(signs), bool)
        keep[first] = False
        return signs[keep], starts - np.searchsorted(first, starts, side="left")


_ENCODERS: dict[str, Bpe] = {}  # of a worker process
_TABLES: dict[str, OffsetTable] = {}


def encoder(path: str) -> Bpe:
    if path not in _ENCODERS:
        _ENCODERS[path] = Bpe(path)
    return _ENCODERS[path]


def offset_table(path: str) -> OffsetTable:
    if path not in _TABLES:
        _TABLES[path] = OffsetTable(path)
    return _TABLES[path]


def encode(docs: DataFrame, *, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids): little-endian 32-bit piece ids of every whole text."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for frame in frames:
            for lo, hi in batches_of(frame.column("text"), TEXT_BYTES):
                part = frame.slice(lo, hi - lo)
                ids, rows = own.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), binary_rows(ids, rows).cast(pa.binary())], ["id", "ids"])

    rows = pick(docs, id=id_column, text=text_column).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, *, tokenizer: str) -> DataFrame:
    """(id, ids, text) of rows (id, ids): the pieces' strings with a space between. Null ids are none."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = offset_table(tokenizer)
        for frame in frames:
            packed = frame.column("ids").cast(pa.large_binary()).fill_null(b"")
            ends = edges_of(pc.binary_length(packed).to_numpy(zero_copy_only=False) // 4)
            for lo, hi in runs_of(ends, TEXT_BYTES // 4):
                part = frame.slice(lo, hi - lo)
                ids = np.frombuffer(b"".join(packed.slice(lo, hi - lo).to_pylist()), "<u4")
                signs, rows = own.decode(ids, ends[lo : hi + 1] - ends[lo])
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("ids"), binary_rows(signs, rows, pa.large_string()).cast(pa.string())], ["id", "ids", "text"])

    rows = pick(encoded, id="id", ids="ids")
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, text string")
