"""SentencePiece encoding with N-best segmentation, and decoding.

A text's pieces form a lattice whose arcs carry the piece scores of the model.
A forward Viterbi pass gives the best score from the start to every position;
these scores are exact heuristics for an A* search backward from the end, which
therefore pops complete segmentations in order of their score.

Spaces are written as U+2581 and one is put before the text. No piece holds
U+2581 after another sign (checked when the model is read) and none a line
break, so the lattice of a text falls apart into words: the best segmentation is that of each word, and
the N best of the text come from the N - 1 words whose second best is closest
to their best, whose N best lists are merged. The result is the N best of the
whole lattice. Words are kept in a cache by worker process.

A sign without a piece is one arc with a score below all pieces, and becomes
the model's byte pieces. Pieces that the model itself puts out of reach (runs
of spaces, at -1e9) count with this score as well.

Defined results: a null or empty text has no piece and one segmentation of
score 0; ties are broken by the search (nearest to the start, then order of
discovery), the same on each run; fewer segmentations than N are returned if the lattice has fewer; U+2581 in a text
decodes to a space; repeated rows are encoded each; null ids and extra columns
stay as they are.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, pick

SPACE = "▁"
CACHE_WORDS = 250_000
#: Text that is cut into words at a time.
SLICE_BYTES = 3 << 20


class Lattice:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.below = min(s for s in map(model.get_score, normal) if s > -1e8) - 10
        self.pieces = {model.id_to_piece(i): (i, max(model.get_score(i), self.below)) for i in normal}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.raw = [b""] * n  # bytes of every piece
        for piece, (i, _) in self.pieces.items():
            self.raw[i] = piece.encode()
        for value, i in self.bytes.items():
            self.raw[i] = bytes([value])
        self.longest = max(map(len, self.pieces))
        # every ending of a piece: the piece itself with its score, or empty
        self.endings: dict[str, tuple] = {p[i:]: () for p in self.pieces for i in range(1, len(p))} | self.pieces
        self.breaks = not any("\n" in p for p in self.pieces)  # no piece reaches over a line break
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces that reach over words are not supported")
        self.cache: dict[str, tuple] = {}  # word: (ids, score, distance of the second best)
        self.lists: dict[tuple, list] = {}  # (word, n): its n best

    def arcs_to(self, word: str, end: int) -> Iterator[tuple[int, int | None, float]]:
        """(start, piece or None for an unknown sign, score) of the arcs that end at ``end``."""
        known = False
        for start in range(max(0, end - self.longest), end):
            got = self.pieces.get(word[start:end])
            if got:
                known = known or start == end - 1
                yield start, got[0], got[1]
        if not known:
            yield end - 1, None, self.below

    def extend(self, word: str, best: list[float], back: list[tuple]) -> None:
        """Carry the forward pass on from the positions that ``best`` and ``back`` hold to the word's end.

        ``best``: best score to each position; ``back``: its last arc as (start, piece), and how much
        worse the second best last arc is.
        """
        get, below = self.endings.get, self.below
        for end in range(len(best), len(word) + 1):
            at = start = end - 1
            got = get(word[at:end])
            second = float("-inf")
            if got:
                piece, top = got[0], best[at] + got[1]
            else:
                piece, top = None, best[at] + below
            while got is not None and start:  # None: no piece ends with these signs
                start -= 1
                got = get(word[start:end])
                if got:
                    score = best[start] + got[1]
                    if score > top:
                        second, top, at, piece = top, score, start, got[0]
                    elif score > second:
                        second = score
            best.append(top)
            back.append((at, piece, top - second))

    def learn(self, words: set[str]) -> None:
        """Best segmentations of new words, in order, so that words share the pass over common beginnings."""
        before, best, back = "", [0.0], [()]
        for word in sorted(words):
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del best[same + 1 :], back[same + 1 :]
            self.extend(word, best, back)
            before = word
            at, least, ids = len(word), float("inf"), []
            while at:
                start, piece, gap = back[at]
                if piece is None:
                    ids += self.ids_of(word, [(start, at, None)])[::-1]
                else:
                    ids.append(piece)
                if gap < least:
                    least = gap
                at = start
            self.cache[word] = (array("I", ids[::-1]).tobytes(), best[-1], least)

    def ids_of(self, word: str, arcs: list[tuple[int, int, int | None]]) -> list[int]:
        out = []
        for start, end, piece in arcs:
            if piece is None:
                out += [self.bytes.get(b, self.unknown) for b in word[start:end].encode()]
            else:
                out.append(piece)
        return out

    def nbest(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a word: A* from the end, with the forward scores as heuristics.

        Of equal scores the one nearest to the start goes first, so that tied segmentations are
        completed one after the other and not side by side. The partial segmentations that reach one
        position leave it in the order of their scores and go on alike, so that those after the first
        n of a position are in no list of n best: a position is left n times at most.
        """
        ahead: list[float] = [0.0]
        self.extend(word, ahead, [()])
        order, out, left = count(), [], [0] * (len(word) + 1)
        heap = [(-ahead[len(word)], len(word), next(order), 0.0, None)]
        while heap and len(out) < n:
            _, at, _, done, path = heapq.heappop(heap)
            left[at] += 1
            if left[at] > n:
                continue
            if at == 0:
                arcs = []
                while path:
                    arc, path = path
                    arcs.append(arc)
                out.append((done, self.ids_of(word, arcs)))
                continue
            for start, piece, score in self.arcs_to(word, at):
                heapq.heappush(heap, (-(ahead[start] + done + score), start, next(order), done + score, ((start, at, piece), path)))
        return out

    def words(self, text: str) -> list[str]:
        """The text's lattice, cut before each space that follows another sign and around line breaks."""
        text = " " + text.replace(SPACE, " ")
        if self.breaks and "\n" in text:
            first, *rest = text.split("\n")
            out = self.line(first)
            for line in rest:
                out.append("\n")
                out += self.line(line) if line[:1] in ("", " ") else self.line(" " + line, bare=True)
            return out
        return self.line(text)

    @staticmethod
    def line(text: str, bare: bool = False) -> list[str]:
        """Words of a line that begins with a space; ``bare``: the space was put there only to split."""
        parts = text.split(" ")[1:]
        if "" not in parts:
            out = [SPACE + p for p in parts]
            if bare:
                out[0] = parts[0]
            return out
        out, spaces = [], 0
        for part in parts:
            if part:
                out.append(SPACE * (spaces + 1) + part)
                spaces = 0
            else:
                spaces += 1
        if spaces:
            out.append(SPACE * spaces)
        if bare:
            out[0] = out[0][1:]
        return out

    def encode(self, texts: list[str | None], n: int = 1) -> list[list[tuple[float, bytes]]]:
        """(score, little-endian 32-bit ids) of the n best segmentations of each whole text."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
            self.lists.clear()
        cut = [self.words(t) if t else [] for t in texts]
        self.learn(set().union(*cut).difference(self.cache))
        return [self.text_nbest(words, n) for words in cut]

    def text_nbest(self, words: list[str], n: int) -> list[tuple[float, bytes]]:
        best = list(map(self.cache.__getitem__, words))
        total, ids = sum([b[1] for b in best]), [b[0] for b in best]
        out = [(float(total), b"".join(ids))]
        if n > 1 and words:
            gaps = [b[2] for b in best]
            near = sorted(heapq.nsmallest(n - 1, range(len(gaps)), key=gaps.__getitem__))
            merged: list[tuple[float, tuple]] = [(0.0, ())]
            for i in near:
                if gaps[i] == float("inf"):
                    continue
                key = (words[i], n)
                if key not in self.lists:
                    found = [(best[i][1] - score, array("I", own).tobytes()) for score, own in self.nbest(words[i], n)]
                    # among ties, the one of the forward pass comes first
                    self.lists[key] = [(0.0, ids[i]), *[f for f in found if f[1] != ids[i]]][:n]
                merged = heapq.nsmallest(n, [(loss + more, chosen + ((i, own),)) for loss, chosen in merged for more, own in self.lists[key]], key=lambda x: x[0])
            for loss, chosen in merged[1:]:
                other = list(ids)
                for i, own in chosen:
                    other[i] = own
                out.append((total - loss, b"".join(other)))
        return out

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.raw.__getitem__, array("I", ids))).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_LATTICES: dict[str, Lattice] = {}  # of a worker process


def lattice(path: str) -> Lattice:
    if path not in _LATTICES:
        _LATTICES[path] = Lattice(path)
    return _LATTICES[path]


def encode(docs: DataFrame, *, model: str, n: int = 1, id_column: str = "doc_id") -> DataFrame:
    """(id, ids, score, scores, others, decoded): ids are little-endian 32-bit numbers of the best
    segmentation, ``others`` those of the next n - 1; ``decoded`` is the text read back from ``ids``."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model)
        for frame in frames:
            for lo, hi in batches_of(frame.column("text"), SLICE_BYTES):
                found = own.encode(frame.column("text").slice(lo, hi - lo).to_pylist(), n)
                ids = [got[0][1] for got in found]
                scores = [[s for s, _ in got] for got in found]
                others = [[o for _, o in got[1:]] for got in found]
                decoded = [own.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays([frame.column("id").slice(lo, hi - lo), pa.array(ids, pa.binary()), pa.array([s[0] for s in scores]), pa.array(scores, pa.list_(pa.float64())), pa.array(others, pa.list_(pa.binary())), pa.array(decoded, pa.string())], ["id", "ids", "score", "scores", "others", "decoded"])

    rows = pick(docs, id=id_column, text="text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids binary, score double, scores array<double>, others array<binary>, decoded string")


def decode(encoded: DataFrame, *, model: str, ids_column: str = "ids") -> DataFrame:
    """(id, text) from ids alone."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model)
        for frame in frames:
            texts = [own.decode(x or b"") for x in frame.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([frame.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select("id", F.col(ids_column).alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string")
