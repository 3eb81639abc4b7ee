"""Periodic runs of words, found in scale-tiled documents.

A run is a stretch of words that repeat with a smallest period q, at least four
times over (six words at least), and that no neighbouring word extends. Periods
are taken in octaves, [P, 2P) for P = 1, 2, 4, .... For each octave a document is
cut into tiles that overlap by six octave lengths to the left and eight to the
right; tiles are rows, dealt out to all tasks. A tile has a boundary every 3P
words. A run of period p repeats over 3p words or more, so it holds a boundary,
and a Z-function forward from the boundary and one backward give, for every
period of the octave, how far words p apart are equal: a fragment of the run,
whole or cut off by the tile. Boundaries where no period can pass (three words
in a row must return p later on one of the two sides) need no Z-function. A
period of which the stretch repeats a proper divisor is left out, so a fragment
has the run's smallest period. Fragments are shuffled by document and period, and
those that overlap are stitched: the runs of a document do not depend on the
tiles.

The octaves up to ``WORDS`` / 64 share one tiling, and a document of ``WORDS``
words or less is one tile of all octaves; such documents (by the size of their
text) are solved where they are read, and only their fragments travel. Long
documents are exploded and their tiles shuffled.

Words hold no tab, line feed, vertical tab, form feed, carriage return or space;
all other signs belong to words, which are compared exactly.

Defined results: null and empty texts, and texts of white space only, have no
words and no runs; a text without runs keeps all words; rows that share id and
text share their runs and stay that many rows; null ids are ids; an empty table
gives an empty table; columns other than the wanted ones are ignored. Long
documents are handled in tiles, but the words of one document are numbered, and
joined again, by one task, as a text is one value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches_of, pick, written
from .ragged import distinct_words, edges_of, split_rows

#: Words of a tile without its overlaps, for the octaves that fit in it.
WORDS = 1 << 15
#: Bytes of a text that certainly has at most ``WORDS`` words.
SHORT = 2 * WORDS
#: Text handled at a time, in bytes.
TEXT_BYTES = 4 << 20

#: A run has at least this many words and periods.
LEAST, TIMES = 6, 4

_TILE = ["low", "high", "start", "core", "core_stop"]
FRAGMENT = "period long, start long, stop long"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and the offsets of each text's."""
    stretches, rows = split_rows(pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null("")))
    real = pc.not_equal(stretches, "").to_numpy(zero_copy_only=False)
    return stretches.filter(pa.array(real)), edges_of(real)[rows]


def joined(words: pa.Array, rows: np.ndarray) -> pa.Array:
    """The words of each row with one space between."""
    lists = pa.LargeListArray.from_arrays(pa.array(rows), words)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def z_function(text: list[int], upto: int) -> list[int]:
    """For each of the first ``upto`` places, how many signs from there on equal the text's beginning."""
    size, out = len(text), [0] * min(upto, len(text))
    left = right = 0
    for i in range(1, len(out)):
        reach = min(right - i, out[i - left]) if i < right else 0
        while i + reach < size and text[reach] == text[i + reach]:
            reach += 1
        if i + reach > right:
            left, right = i, i + reach
        out[i] = reach
    return out


def _divisors(p: int) -> list[int]:
    """``p`` over each of its prime divisors."""
    out, rest, d = [], p, 2
    while d * d <= rest:
        if rest % d == 0:
            out.append(p // d)
            while rest % d == 0:
                rest //= d
        d += 1
    return [*out, p // rest] if rest > 1 else out


def _at_boundary(codes: np.ndarray, c: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) around boundary ``c``: words at start .. stop - 1 equal those a period later."""
    before, after = codes[max(0, c - 6 * octave) : c], codes[c : c + 8 * octave]
    forward = z_function(after.tolist(), 2 * octave)
    mirrored = before[::-1].tolist()
    text = mirrored + [-1] + after[: 2 * octave][::-1].tolist() + mirrored  # -1 stands in no document
    backward = z_function(text, len(mirrored) + 1 + min(2 * octave, len(after)))
    ahead = len(mirrored) + 1 + min(2 * octave, len(after))
    out = []
    for p in range(octave, min(2 * octave, len(forward))):
        back, on = backward[ahead - p] if ahead - p < len(backward) else 0, forward[p]
        if back + on + p >= max(LEAST, TIMES * p) and not any(forward[q] >= p - q for q in _divisors(p)):
            out.append((p, c - back, c + on))
    return out


def solve(codes: np.ndarray, tiles: np.ndarray, cores: np.ndarray, first: np.ndarray, octaves: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(tile, period, start, stop) of the tiles' words: tile i has the words ``codes[tiles[i]:tiles[i + 1]]``,
    of which those from ``cores[i, 0]`` to ``cores[i, 1]`` hold its boundaries and the first is word
    ``first[i]`` of its document. Different tiles must not share codes."""
    size = len(codes)
    grams = codes.astype(np.int64)
    grams = grams * 0x1F3D5B79 + np.append(grams[1:], [-1])
    grams = grams * 0x1F3D5B79 + np.append(codes[2:], [-1, -1])[:size]  # three words; a clash costs work only
    for octave in octaves:
        step = 3 * octave
        low = tiles[:-1] + -(-(first + cores[:, 0]) // step) * step - first
        counts = np.maximum(0, -(-(tiles[:-1] + cores[:, 1] - low) // step))
        counts[tiles[1:] - tiles[:-1] < max(LEAST, TIMES * octave)] = 0
        owner = np.repeat(np.arange(len(counts)), counts)
        places = low[owner] + step * (np.arange(len(owner)) - np.repeat(edges_of(counts)[:-1], counts))
        hit = np.zeros(len(places), bool)
        back = np.maximum(places - 3, 0)
        for lo in range(0, len(places), max(1, (1 << 20) // octave)):
            part = slice(lo, lo + max(1, (1 << 20) // octave))
            lags = np.arange(octave, 2 * octave)
            for here in (places[part], back[part]):
                there = np.minimum(here[:, None] + lags, size - 1)
                hit[part] |= (grams[there] == grams[here][:, None]).any(axis=1)
        found: dict[tuple[int, int], list[int]] = {}
        for c, i in zip(places[hit].tolist(), owner[hit].tolist()):
            own = codes[tiles[i] : tiles[i + 1]]
            for p, start, stop in _at_boundary(own, c - int(tiles[i]), octave):
                last = found.get((i, p))
                if last and start <= last[1]:  # within the tile fragments are stitched at once
                    last[1] = max(last[1], stop)
                else:
                    if last:
                        yield i, p, last[0] + int(first[i]), last[1] + int(first[i])
                    found[i, p] = [start, stop]
        for (i, p), (start, stop) in found.items():
            yield i, p, start + int(first[i]), stop + int(first[i])


def octaves_of(low: int, high: int) -> list[int]:
    return [1 << k for k in range(low, high)]


def tiles_of(n: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(lowest octave, beyond the highest, first word, first of the core, beyond the core, beyond the
    last word) of the tiles of a document of ``n`` words."""
    top = max(1, (n // TIMES).bit_length())  # octaves 0 .. top - 1 hold all periods up to n / 4
    shared = (WORDS // 64).bit_length()
    for low, high in [(0, min(shared, top)), *[(k, k + 1) for k in range(shared, top)]]:
        widest = 1 << (high - 1)
        core = max(WORDS, 16 * widest)
        for at in range(0, n, core):
            yield low, high, max(0, at - 6 * widest), at, min(n, at + core), min(n, at + core + 8 * widest)


def short_fragments(texts: pa.Array) -> tuple[pa.Array, list[list[dict]]]:
    """The words of every text joined by one space, and the fragments of each: one tile a text."""
    words, rows = words_of(texts)
    _, codes = distinct_words(words)
    sizes = rows[1:] - rows[:-1]
    codes = codes + np.repeat(np.arange(len(sizes)), sizes) * (len(codes) + 1)  # no text shares a code with another
    cores = np.stack([np.zeros(len(sizes), np.int64), sizes], axis=1)
    top = max(1, (int(sizes.max(initial=0)) // TIMES).bit_length())
    found: list[list[dict]] = [[] for _ in range(len(sizes))]
    if len(codes):
        for i, p, start, stop in solve(codes, rows, cores, np.zeros(len(sizes), np.int64), octaves_of(0, top)):
            found[i].append({"period": p, "start": start, "stop": stop})
    return joined(words, rows), found


_FOUND = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))


def _solve_short(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for lo, hi in batches_of(frame.column("text"), TEXT_BYTES):
            part = frame.slice(lo, hi - lo)
            words, found = short_fragments(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("copy"), words, pa.array(found, _FOUND)], ["id", "copy", "words", "found"])


def _join_words(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for lo, hi in batches_of(frame.column("text"), TEXT_BYTES):
            part = frame.slice(lo, hi - lo)
            words, rows = words_of(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("copy"), joined(words, rows)], ["id", "copy", "words"])


def _explode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of long documents, one row each; the words of a document are numbered by their first place."""
    for frame in frames:
        for row in range(frame.num_rows):
            words, _ = words_of(frame.column("text").slice(row, 1))
            codes = distinct_words(words)[1].astype("<i4")
            own = frame.select(["id", "copy"]).slice(row, 1).columns
            for *tile, stop in tiles_of(len(codes)):
                yield pa.RecordBatch.from_arrays([*own, *[pa.array([x], pa.int64()) for x in tile], pa.array([codes[tile[2] : stop].tobytes()], pa.binary())], ["id", "copy", *_TILE, "codes"])


def _solve_tiles(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for row in range(frame.num_rows):
            low, high, start, core, core_stop = (frame.column(c)[row].as_py() for c in _TILE)
            codes = np.frombuffer(frame.column("codes")[row].as_py(), "<i4").astype(np.int64)
            found = solve(codes, np.array([0, len(codes)]), np.array([[core - start, core_stop - start]]), np.array([start]), octaves_of(low, high))
            columns = list(zip(*found))[1:] or [[], [], []]
            own = [c.take(pa.array([row] * len(columns[0]), pa.int64())) for c in frame.select(["id", "copy"]).columns]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(c, pa.int64()) for c in columns]], ["id", "copy", "period", "start", "stop"])


def stitch(fragments: DataFrame) -> DataFrame:
    """(id, copy, runs) from fragments (id, copy, period, start, stop): overlapping ones of a document and
    period are one run. ``runs`` are structs (start, period, length), by start, then period."""
    along = Window.partitionBy("id", "copy", "period").orderBy("start", "stop")
    before = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > before, F.lit(True)).cast("long")
    numbered = fragments.withColumn("begins", begins).withColumn("run", F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("id", "copy", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    run = F.struct("start", "period", (F.col("stop") - F.col("start") + F.col("period")).alias("length"))
    return whole.groupBy("id", "copy").agg(F.array_sort(F.collect_list(run)).alias("runs"))


def _collapse(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that stay: none is dropped that stands in the first period of every run around it."""
    for frame in frames:
        for lo, hi in batches_of(frame.column("words"), TEXT_BYTES):
            part = frame.slice(lo, hi - lo)
            words, rows = words_of(part.column("words"))
            change = np.zeros(len(words) + 1, np.int64)
            for at, runs in zip(rows[:-1].tolist(), part.column("runs").to_pylist()):
                for run in runs:
                    change[at + run["start"] + run["period"]] += 1
                    change[at + run["start"] + run["length"]] -= 1
            keep = np.cumsum(change)[:-1] == 0
            kept = joined(words.filter(pa.array(keep)), edges_of(keep)[rows])
            yield pa.RecordBatch.from_arrays([part.column("id"), kept, part.column("runs")], ["id", "kept", "runs"])


RUNS = "array<struct<start: long, period: long, length: long>>"


def collapse_runs(spark: SparkSession, docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, kept, runs) of every row: all runs, by start and period, and the words joined by one space
    without those that any run holds after its first period."""
    rows = pick(docs, id=id_column, text=text_column).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("copy", F.concat_ws(":", F.xxhash64("text"), F.octet_length("text")))  # tells the texts of one id apart
    kind = rows.schema["id"].dataType.simpleString()
    found = f"array<struct<{FRAGMENT.replace(' long', ': long')}>>"
    short = rows.filter(F.octet_length("text") <= SHORT).mapInArrow(_solve_short, f"id {kind}, copy string, words string, found {found}")
    short = written(spark, short, "periods-short")
    long = rows.filter(F.octet_length("text") > SHORT)
    tiles = long.mapInArrow(_explode, f"id {kind}, copy string, {' long, '.join(_TILE)} long, codes binary")
    tiles = tiles.repartition("id", "copy", "low", "start")  # a long document's tiles go to many tasks
    of_tiles = tiles.mapInArrow(_solve_tiles, f"id {kind}, copy string, {FRAGMENT}")
    of_short = short.select("id", "copy", F.explode("found").alias("f")).select("id", "copy", "f.*")
    runs = stitch(of_short.unionByName(of_tiles))
    plain = short.filter(F.size("found") == 0).select("id", F.col("words").alias("kept"), F.array().cast(RUNS).alias("runs"))
    rest = short.filter(F.size("found") > 0).select("id", "copy", "words").unionByName(long.mapInArrow(_join_words, f"id {kind}, copy string, words string"))
    met = rest.alias("d").join(runs.alias("r"), F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.copy") == F.col("r.copy")), "left")
    met = met.select("d.id", "d.words", F.coalesce("r.runs", F.array().cast(RUNS)).alias("runs"))
    return plain.unionByName(met.mapInArrow(_collapse, f"id {kind}, kept string, runs {RUNS}"))
