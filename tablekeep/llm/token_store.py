"""Token ids in binary shards with a minimal perfect hash index for keyed access.

The store is a folder of Parquet files whose rows are shards in key order, a
sub-folder for each task that wrote some, and a directory with a small row for
each shard: its range of keys and where its ids begin in the whole store. A
shard holds the raw little-endian ids of consecutive documents (2 bytes an id
where the vocabulary allows, else 4), their lengths, and an index: a minimal
perfect hash over the shard's keys maps a key to a slot, and the slot stores a
16-bit fingerprint and the document's place in the shard. A look-up finds the
shards in the directory and reads no other; in a shard it is one hash a level
and one comparison, whatever the size. The fingerprint rejects almost all
foreign keys before the key itself is compared. Spark's writer commits the
shards, so a lost task leaves nothing half written and any store that Spark
reads will do.

Documents are dealt out by ranges of (key, hash of the text) and sorted, so the
ids of the whole store are in ascending key order and a key that repeats often
does not land in one task.

Defined results: a null text is empty and gets the end id alone; null keys come
first, are stored and read back by a full read but cannot be looked up; rows
that share a key are stored each, next to each other, in the order of their
text hash, and a look-up returns all of them; an empty table gives an empty
store. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches_of, pick
from .tokens import encoder

#: Ids of one shard, in bytes.
SHARD_BYTES = 4 << 20
TEXT_BYTES = 4 << 20

SHARD = "part int, seq int, n_docs long, n_ids long, before long, first_key long, last_key long, width int, payload binary, lengths binary, keys binary, nulls long, mphf binary, prints binary, places binary"
_COLUMNS = [c.split(" ")[0] for c in SHARD.split(", ")]
#: The directory of a store: where each shard's ids begin, and its keys.
DIRECTORY = "part int, seq int, first_key long, last_key long, n_docs long, start long"
#: Single keys of a look-up that become filters of their own; more are one range of keys.
KEYS_PUSHED = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """SplitMix64 finaliser over the keys of one level."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash: on each level a key claims one bit, keys that collide go to the next
    level, and a key's slot is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # booleans
        self.base = np.cumsum([0] + [int(x.sum()) for x in levels])
        self.rank = [np.cumsum(x) - x for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray, load: float = 1.5) -> PerfectHash:
        """``keys``: distinct 64-bit numbers."""
        left, levels = keys.view(np.uint64), []
        while len(left):
            size = max(8, int(len(left) * load))
            at = (mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            once = np.bincount(at, minlength=size) == 1
            levels.append(once)
            left = left[~once[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key; -1 for keys that claim no bit (certainly foreign)."""
        keys = keys.view(np.uint64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            at = (mix(keys[open_], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.base[i] + self.rank[i][at[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *[len(x) for x in self.levels]], "<u4").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, blob: bytes) -> PerfectHash:
        n = int(np.frombuffer(blob, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(blob, "<u4", n, 4), 4 + 4 * n, []
        for size in sizes.tolist():
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)


def prints_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64), 1 << 20) >> np.uint64(48)).astype(np.uint16)


def shard_row(part: int, seq: int, before: int, keys: list[int | None], ids: list[bytes], width: int) -> list:
    """One shard of documents in key order (nulls first), with ``before`` ids before it in its part."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], np.int64)
    distinct, first = np.unique(known, return_index=True)
    mphf = PerfectHash.build(distinct)
    slots = mphf.slots(distinct)
    prints, places = np.zeros(len(distinct), np.uint16), np.zeros(len(distinct), np.uint32)
    prints[slots], places[slots] = prints_of(distinct), first + nulls
    lengths = np.array([len(x) // width for x in ids], np.uint32)
    edge = [int(known[0]), int(known[-1])] if len(known) else [None, None]
    return [part, seq, len(keys), int(lengths.sum()), before, *edge, width, b"".join(ids), lengths.tobytes(), known.tobytes(), nulls, mphf.to_bytes(), prints.tobytes(), places.tobytes()]


def write_store(spark: SparkSession, docs: DataFrame, path: str, *, tokenizer: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every whole text, append ``end_id``, and write the shards and their directory below ``path``."""
    types = pa.schema([(c.split(" ")[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split(" ")[1]]) for c in SHARD.split(", ")])

    def pack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seq, before = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        keys, ids, size = [], [], 0

        def shard() -> pa.RecordBatch:
            row = shard_row(part, seq, before, keys, ids, own.width)
            return pa.RecordBatch.from_pylist([dict(zip(_COLUMNS, row))], schema=types)

        for frame in frames:
            for lo, hi in batches_of(frame.column("text"), TEXT_BYTES):
                packed, rows = own.encode_array(frame.column("text").slice(lo, hi - lo), end_id)
                raw, edges = packed.tobytes(), (rows * own.width).tolist()
                for key, a, b in zip(frame.column("key").slice(lo, hi - lo).to_pylist(), edges[:-1], edges[1:]):
                    keys.append(key)
                    ids.append(raw[a:b])
                    size += b - a
                    if size >= shard_bytes:
                        yield shard()
                        keys, ids, size, seq, before = [], [], 0, seq + 1, before + size // own.width
        if keys:
            yield shard()

    rows = pick(docs, key="doc_id", text="text").select(F.col("key").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("body", F.xxhash64("text")).repartitionByRange("key", "body").sortWithinPartitions("key", "body")
    rows.select("key", "text").mapInArrow(pack, SHARD).write.partitionBy("part").parquet(f"{path}/shards")
    found = shards(spark, path)
    sizes = found.groupBy("part").agg(F.sum("n_ids").alias("ids")).orderBy("part").collect()  # a number for each task that wrote
    starts = np.cumsum([0] + [r["ids"] for r in sizes]).tolist()
    parts = spark.createDataFrame([(r["part"], s) for r, s in zip(sizes, starts)], "part int, of_part long")
    placed = found.join(parts, "part").withColumn("start", F.col("of_part") + F.col("before"))
    placed.select([c.split(" ")[0] for c in DIRECTORY.split(", ")]).write.parquet(f"{path}/directory")


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards, a folder of files for each part (the task that wrote it)."""
    return spark.read.schema(SHARD).parquet(f"{path}/shards")


def directory(spark: SparkSession, path: str) -> DataFrame:
    """A small row for each shard, without its ids."""
    return spark.read.schema(DIRECTORY).parquet(f"{path}/directory")


class Shard:
    """A shard's index over its raw ids."""

    def __init__(self, row: dict):
        self.keys = np.frombuffer(row["keys"], np.int64)
        self.nulls, self.width, self.payload = row["nulls"], row["width"], row["payload"]
        lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.mphf = PerfectHash.from_bytes(row["mphf"])
        self.prints, self.places = np.frombuffer(row["prints"], np.uint16), np.frombuffer(row["places"], np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of the first document of every key; -1 where the shard has none."""
        if not len(self.prints):
            return np.full(len(keys), -1, np.int64)
        slots = self.mphf.slots(keys)
        good = (slots >= 0) & (self.prints[slots] == prints_of(keys))
        place = np.where(good, self.places[slots], self.nulls).astype(np.int64)
        good &= self.keys[place - self.nulls] == keys
        return np.where(good, place, -1)

    def ids(self, place: int) -> bytes:
        """The ids of one document as little-endian 32-bit numbers."""
        raw = self.payload[self.starts[place] * self.width : self.ends[place] * self.width]
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4").tobytes()

    def run(self, place: int) -> range:
        """Places of all documents with the key found at ``place``."""
        stop = place + 1
        while stop - self.nulls < len(self.keys) and self.keys[stop - self.nulls] == self.keys[place - self.nulls]:
            stop += 1
        return range(place, stop)


DOCUMENT = "doc_id long, start long, ids binary"


def _documents(shard: Shard, start: int, places: list[tuple[int | None, int]]) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(places), 1024):
        part = places[lo : lo + 1024]
        at = [p for _, p in part]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.int64()), pa.array(shard.starts[at] + start, pa.int64()), pa.array([shard.ids(p) for p in at], pa.binary())], ["doc_id", "start", "ids"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document: each key of a shard is looked up in its index.

    Shards are read where they lie; what travels is one number for each part.
    """

    def unpack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                row = frame.slice(i, 1).to_pylist()[0]
                shard = Shard(row)
                distinct = np.unique(shard.keys)
                places = [(None, p) for p in range(shard.nulls)]
                for key, place in zip(distinct.tolist(), shard.find(distinct).tolist()):
                    places += [(key, p) for p in shard.run(place)]
                yield from _documents(shard, row["of_part"] + row["before"], places)

    firsts = directory(spark, path).filter("seq = 0").select("part", F.col("start").alias("of_part"))
    return shards(spark, path).join(F.broadcast(firsts), "part").mapInArrow(unpack, DOCUMENT)  # a row for each task that wrote


def found_shards(spark: SparkSession, path: str, keys: Sequence[int]) -> DataFrame:
    """Rows of the directory whose range of keys holds one of ``keys`` (sorted)."""
    first, last = F.col("first_key"), F.col("last_key")
    rows = directory(spark, path).filter((first <= keys[-1]) & (last >= keys[0]))
    if len(keys) <= KEYS_PUSHED:
        holds = [(first <= k) & (last >= k) for k in keys]
        return rows.filter(reduce(lambda a, b: a | b, holds))
    return rows.filter(F.exists(F.lit(keys), lambda k: (k >= first) & (k <= last)))


def look_up(spark: SparkSession, path: str, keys: Sequence[int]) -> DataFrame:
    """(doc_id, start, ids) of the documents with the given keys (a list the driver can hold).

    The directory gives the shards whose key range holds one of the keys, at most two a key but
    where a key's copies fill more; only the folders of those shards are read, and of them only the
    rows in the range. Inside a shard a key is one look-up in the perfect hash.
    """
    wanted = np.unique(np.array(sorted(keys), np.int64))
    if not len(wanted):
        return spark.createDataFrame([], DOCUMENT)
    hits = found_shards(spark, path, wanted.tolist()).select("part", "seq", "start").collect()
    if not hits:
        return spark.createDataFrame([], DOCUMENT)
    start_of = {(r["part"], r["seq"]): r["start"] for r in hits}
    parts, seqs = sorted({r["part"] for r in hits}), sorted({r["seq"] for r in hits})

    def unpack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                row = frame.slice(i, 1).to_pylist()[0]
                start = start_of.get((row["part"], row["seq"]))
                if start is not None:
                    shard = Shard(row)
                    yield from _documents(shard, start, [(k, q) for k, p in zip(wanted.tolist(), shard.find(wanted).tolist()) if p >= 0 for q in shard.run(p)])

    rows = shards(spark, path).filter(F.col("part").isin(parts) & F.col("seq").isin(seqs) & (F.col("first_key") <= int(wanted[-1])) & (F.col("last_key") >= int(wanted[0])))
    return rows.mapInArrow(unpack, DOCUMENT)
