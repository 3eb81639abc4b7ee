"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z) and split into words; the patterns are all windows
of ``WINDOW`` consecutive words of the benchmark items (a shorter item is one
window). Patterns of one length form one matcher. A block of up to ``BLOCK``
words looks up how far the search may jump: blocks that no pattern contains
skip a whole pattern length. A block that ends a pattern selects the bucket of
the patterns with this suffix, and direct comparison of all words confirms an
occurrence. Each document is searched whole, in its own row; nothing is
shuffled.

The windows go to the tasks as a broadcast variable of at most ``BLOCK_BYTES``
of benchmark text. A larger benchmark is dealt into as many blocks as that
needs; each block is one pass over the documents, and hits add up, so no item
is left out.

Defined results: null and empty texts have no words, so a null or empty item
matches nothing; an item without id counts under the name "null"; repeated
items are one; repeated documents are searched each; empty tables give no hits.
Extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import packed, pick, written

WINDOW = 10
BLOCK = 3
#: Benchmark text of one broadcast: a few hundred MB of tables in a task at most.
BLOCK_BYTES = 4 << 20

_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class Matcher:
    """Wu-Manber tables for patterns of one length (in words)."""

    def __init__(self, length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.suffix: dict[tuple, dict[tuple, set[str]]] = {}

    def add(self, pattern: tuple, item: str) -> None:
        b = self.block
        for end in range(b, self.length + 1):
            block, jump = pattern[end - b : end], self.length - end
            if jump < self.shift.get(block, self.far):
                self.shift[block] = jump
        self.suffix.setdefault(pattern[-b:], {}).setdefault(pattern, set()).add(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(first word, items) of every occurrence."""
        n, b, get, far = self.length, self.block, self.shift.get, self.far
        at, total = n, len(words)  # at: end of the window under test
        while at <= total:
            jump = get(tuple(words[at - b : at]), far)
            if jump:
                at += jump
                continue
            items = self.suffix[tuple(words[at - b : at])].get(tuple(words[at - n : at]))
            if items:
                yield at - n, items
            at += 1


def matchers(items: list[tuple[str, str]], window: int) -> list[Matcher]:
    by_length: dict[int, Matcher] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        if size:
            matcher = by_length.setdefault(size, Matcher(size))
            for i in range(len(words) - size + 1):
                matcher.add(tuple(words[i : i + size]), item)
    return [by_length[k] for k in sorted(by_length)]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find(text: str | None, tables: list[Matcher]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, ranges of words inside occurrences, items that occur)."""
    words = words_of(text)
    ranges, found = [], set()
    for matcher in tables:
        for start, items in matcher.search(words):
            ranges.append((start, start + matcher.length))
            found |= items
    return len(words), merged(ranges), found


_TABLES: dict[tuple, list[Matcher]] = {}  # of a worker process: the tables of the last broadcast


def tables_of(shared, window: int) -> list[Matcher]:
    key = (shared.value[0], window)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = matchers(shared.value[1], window)
    return _TABLES[key]


HITS = [StructField("n_words", LongType()), StructField("ranges", ArrayType(ArrayType(IntegerType()))), StructField("items", ArrayType(StringType()))]


def mark(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with ``n_words``, ``n_hit``, ``ranges`` ([first word, end) of hit words) and ``items``."""
    flat, names = packed(docs)
    text = f"c{names.index('text')}"
    own = [StructField(f.name, f.dataType, True) for f in flat.schema.fields]
    tests = pick(benchmark, item="item_id", text="text").filter("text IS NOT NULL")
    tests = tests.select(F.coalesce(F.col("item").cast("string"), F.lit("null")).alias("item"), "text").distinct()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (block_bytes // 2) if size > block_bytes else 1))

    def one_pass(rows: DataFrame, shared, again: bool) -> DataFrame:
        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = tables_of(shared, window)
            for frame in frames:
                before = zip(frame.column("ranges").to_pylist(), frame.column("items").to_pylist()) if again else None
                n_words, all_ranges, all_items = [], [], []
                for value in frame.column(text):
                    n, ranges, items = find(value.as_py(), tables)
                    if again:
                        old_ranges, old_items = next(before)
                        ranges, items = merged(ranges + [tuple(r) for r in old_ranges]), items | set(old_items)
                    n_words.append(n)
                    all_ranges.append([list(r) for r in ranges])
                    all_items.append(sorted(items))
                columns = [frame.column(f.name) for f in own]
                columns += [pa.array(n_words, pa.int64()), pa.array(all_ranges, pa.list_(pa.list_(pa.int32()))), pa.array(all_items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in own + HITS])

        return rows.mapInArrow(run, StructType(own + HITS))

    rows = flat
    for block in range(blocks):
        part = tests.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else tests
        items = sorted((r["item"], r["text"]) for r in part.collect())  # block_bytes at most, or one item
        shared = spark.sparkContext.broadcast((f"{id(items)}-{block}-{size}-{hash(tuple(items))}", items))
        rows = one_pass(written(spark, rows, "decontaminate") if block else rows, shared, block > 0)
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda total, r: total + (r[1] - r[0]).cast("long"))
    out = rows.select(*[F.col(f.name) for f in own], "n_words", n_hit.alias("n_hit"), "ranges", "items")
    return out.toDF(*names, "n_words", "n_hit", "ranges", "items")


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window."""
    flat, names = packed(docs)
    marked = mark(spark, flat.withColumnRenamed(f"c{names.index('text')}", "text"), benchmark, window=window)
    return marked.filter("n_hit = 0").drop("n_words", "n_hit", "ranges", "items").toDF(*names)
