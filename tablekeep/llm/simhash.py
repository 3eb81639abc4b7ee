"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint is 64 bits: bit b is set if it is set in over half the XXH64
values (seed 42) of a text's word shingles. Texts are linked if their
fingerprints differ in at most ``distance`` bits.

Two fingerprints at distance 2r have a common variant at distance r from each,
so every distinct fingerprint emits all variants within r of it and the
variants are shuffled. They travel in factored form: variants are dealt out by
their highest bits, and a fingerprint is sent once to each bucket in which it
has variants; the receiving task writes out the rest of the variants, the upper
half first and the lower half only where two or more share an upper half (a
variant that one fingerprint has alone cannot collide). The variants that meet
are the same as without factoring, in a fraction of the shuffled rows. Buckets
that hold very many variants are dealt out by more of the highest bits, so that
near copies of one template spread over many tasks; equal variants still meet.

All fingerprints that meet in one variant are within r of it and so within 2r
of each other. A variant's members are therefore linked as a star to its
smallest member, one verified pair a member, never as all pairs. Exact copies
share a fingerprint and are joined before any variant is made, so neither large
groups of copies nor of near copies grow faster than their size. Components
come from alternating star contraction with checkpoints.

Defined results: a null or empty text has fingerprint zero and links like any
other; fewer words than a shingle make one shingle; repeated rows are rows of
one component; a null id gets a component like any other, but is never the
smallest id unless the component has no other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, pick, written

HALF = 32
#: Shingles hashed at a time, which bounds the memory a very long text takes.
BLOCK = 1 << 15
#: Entries of one bucket that a task expands at a time.
EXPAND = 1 << 21
#: Variants of one bucket from which it is split over more tasks.
SPLIT = 1 << 24


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of one text over its word shingles, repeats included."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words, len(tokens))
    first, last = starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes, total = np.zeros(64, np.int64), len(first)
    for lo in range(0, total, BLOCK):
        part = zip(first[lo : lo + BLOCK], last[lo : lo + BLOCK])
        h = np.array([digest(joined[a:b], 42) for a, b in part], np.dtype("<u8"))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * votes > total).tolist()))


def fingerprints(docs: DataFrame, words: int, id_column: str = "doc_id") -> DataFrame:
    """(id, body, fp): ``body`` is a hash of the text, ``fp`` the fingerprint as a signed 64-bit number."""

    def make(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            text = frame.column("text")
            fps = np.fromiter((fingerprint(text[i].as_py(), words) for i in range(len(text))), np.uint64, len(text))
            yield pa.RecordBatch.from_arrays([frame.column("id"), frame.column("body"), pa.array(fps.view(np.int64))], ["id", "body", "fp"])

    rows = pick(docs, id=id_column, text="text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.withColumn("body", body_hash("text")).mapInArrow(make, f"id {kind}, body long, fp long")


@lru_cache(maxsize=64)
def flips(bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(masks of at most ``most`` of the lowest ``bits`` bits, number of bits of each)."""
    masks = [(sum(1 << b for b in c), k) for k in range(most + 1) for c in combinations(range(bits), k)]
    return np.array([m for m, _ in masks], np.uint64), np.array([k for _, k in masks], np.int64)


def counted(fps: DataFrame, radius: int, top: int) -> DataFrame:
    """(bucket, n0, n1, ...): how many fingerprints have a variant whose ``top`` highest bits are the
    bucket, by the number of their bits that differ from it. One row of a task for each bucket and number."""
    masks, cost = flips(top, radius)
    kinds = radius + 1

    def make(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for frame in frames:
            fp = frame.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            own = ((fp >> np.uint64(64 - top))[:, None] ^ masks[None]) * np.uint64(kinds) + cost.astype(np.uint64)[None]
            found, n = np.unique(own, return_counts=True)
            keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
            sizes = np.bincount(at, np.concatenate([sizes, n])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((keys // np.uint64(kinds)).view(np.int64)), pa.array((keys % np.uint64(kinds)).view(np.int64)), pa.array(sizes)], ["bucket", "spent", "n"])

    sizes = fps.select("fp").mapInArrow(make, "bucket long, spent long, n long").groupBy("bucket")
    return sizes.agg(*[F.sum(F.when(F.col("spent") == s, F.col("n")).otherwise(0)).alias(f"n{s}") for s in range(kinds)])


def completions(bits: int, radius: int) -> list[int]:
    """Number of variants that ``bits`` bits have, by the number of flips that are already spent."""
    return [sum(comb(bits, k) for k in range(radius - s + 1)) for s in range(radius + 1)]


def hot_buckets(fps: DataFrame, radius: int, top: int) -> dict[int, tuple[int, int]]:
    """(depth, parts) of the buckets of over ``SPLIT`` variants. They are split by their ``depth``
    highest bits, the fewest at which no piece can hold more variants than that, even if all
    fingerprints agree in them; the pieces are dealt over ``parts`` groups.

    There are at most all variants / ``SPLIT`` such buckets.
    """
    weights = completions(64 - top, radius)
    held = sum(F.col(f"n{s}") * w for s, w in enumerate(weights))
    out = {}
    for row in counted(fps, radius, top).filter(held > SPLIT).collect():
        fits = (d for d in range(top + 1, 64) if sum(row[f"n{s}"] * w for s, w in enumerate(completions(64 - d, radius))) <= SPLIT)
        out[row["bucket"]] = next(fits, 64), -(-sum(row[f"n{s}"] * w for s, w in enumerate(weights)) // SPLIT)
    return out


def shuffled(fps: DataFrame, radius: int, top: int, hot: dict[int, tuple[int, int]]) -> DataFrame:
    """(depth, bucket, part, keys, members): the fingerprints that have a variant whose ``top`` highest
    bits are the bucket. Those of a hot bucket come once for each variant of the ``depth`` highest
    bits; ``keys`` are these, with the other bits of the member.

    Each task packs the fingerprints of a bucket into one blob, so a bucket
    receives few rows.
    """
    masks, cost = flips(top, radius)
    split = np.array(sorted(hot), np.uint64)
    depths, parts = (np.array([hot[b][i] for b in sorted(hot)], np.uint64) for i in range(2))
    # rows whose entries are made at a time
    step = max(1, EXPAND // completions(max([top, *[d for d, _ in hot.values()]]), radius)[0])

    def blobs(depth: int, bucket: np.ndarray, part: np.ndarray, key: np.ndarray | None, member: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((part, bucket)) if key is not None else np.argsort(bucket, kind="stable")
        bucket, part, member = bucket[order], part[order], member[order]
        cut = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
        heads = np.concatenate([[0], cut])
        packs = lambda x: pa.array([y.tobytes() for y in np.split(x, cut)], pa.binary())
        keys = packs(key[order]) if key is not None else pa.nulls(len(heads), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(heads), depth, np.int32)), pa.array(bucket[heads].view(np.int64)), pa.array(part[heads].view(np.int64)), keys, packs(member)], ["depth", "bucket", "part", "keys", "members"])

    def make(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            every = frame.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(every), step):
                fp = every[lo : lo + step]
                bucket = ((fp >> np.uint64(64 - top))[:, None] ^ masks[None]).ravel()
                member = np.repeat(fp, len(masks))
                cold = np.ones(len(bucket), bool)
                if len(split):
                    at = np.minimum(np.searchsorted(split, bucket), len(split) - 1)
                    cold = split[at] != bucket
                    for d in np.unique(depths[at[~cold]]).tolist():
                        own = ~cold & (depths[at] == d)
                        key, who, _ = flipped(high(bucket[own], member[own], top), member[own], np.tile(cost, len(fp))[own], 64 - top, 64 - d, radius)
                        home = key >> np.uint64(64 - top)
                        with np.errstate(over="ignore"):
                            part = ((key >> np.uint64(64 - d)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % parts[np.searchsorted(split, home)]
                        yield blobs(d, home, part, key, who)
                if cold.any():
                    yield blobs(top, bucket[cold], np.zeros(cold.sum(), np.uint64), None, member[cold])

    return fps.select("fp").mapInArrow(make, "depth int, bucket long, part long, keys binary, members binary")


def high(bucket, fp: np.ndarray, top: int) -> np.ndarray:
    """``fp`` with the bits of ``bucket`` as its ``top`` highest."""
    return (bucket << np.uint64(64 - top)) | (fp & np.uint64((1 << (64 - top)) - 1))


def flipped(key: np.ndarray, member: np.ndarray, spent: np.ndarray, bits: int, rest: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variant, its member, flips spent) of the variants of ``key`` by flips that are left, in the
    lowest ``bits`` bits except the lowest ``rest``."""
    masks, cost = flips(bits - rest, radius)
    keys, members, costs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for s in range(radius + 1):
        usable, at = cost <= radius - s, np.flatnonzero(spent == s)
        if len(at):
            keys.append((key[at][:, None] ^ (masks[usable] << np.uint64(rest))[None]).ravel())
            members.append(np.repeat(member[at], usable.sum()))
            costs.append(np.tile(s + cost[usable], len(at)))
    return np.concatenate(keys), np.concatenate(members), np.concatenate(costs)


def meet(bucket: int, top: int, fp: np.ndarray, radius: int, distance: int) -> np.ndarray:
    """Verified pairs that connect all fingerprints sharing a variant whose ``top`` highest bits are ``bucket``."""
    fp = np.unique(fp)
    return meet_at(high(np.uint64(bucket), fp, top), fp, 64 - top, radius, distance)


def meet_at(key: np.ndarray, fp: np.ndarray, bits: int, radius: int, distance: int) -> np.ndarray:
    """Verified pairs that connect all fingerprints sharing a variant of their ``key`` by the lowest ``bits`` bits.

    A large group is taken in parts: variants that agree in their highest bits
    stay together, and a group that is too large by itself goes on by fewer
    bits. So every variant is made once, and the work grows with their number.
    """
    found = Forest()
    spent = np.bitwise_count(key ^ fp).astype(np.int64)
    order = np.flatnonzero(spent <= radius)
    order = order[np.argsort(key[order] >> np.uint64(bits), kind="stable")]
    todo = [(key[order], fp[order], spent[order], bits)]  # sorted by the key's bits above the lowest ``bits``
    while todo:
        key, member, spent, bits = todo.pop()
        rest = HALF if bits > HALF else 0
        size = np.array(completions(bits - rest, radius))[spent]
        if size.sum() > EXPAND and bits:
            group = key >> np.uint64(bits)
            heads = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1])
            if len(heads) > 1:
                turn = (np.cumsum(np.add.reduceat(size, heads)) - 1) // EXPAND
                cut = heads[np.flatnonzero(np.diff(turn)) + 1]
                if not len(cut):  # the first group alone is too large
                    cut = heads[1:2]
                todo += [(*part, bits) for part in zip(np.split(key, cut), np.split(member, cut), np.split(spent, cut))]
                continue
            n = np.bincount(spent, minlength=radius + 1)
            rest = next((r for r in range(rest, bits - 1) if n @ completions(bits - r, radius) <= EXPAND), bits - 1)
        key, member, spent = flipped(key, member, spent, bits, rest, radius)
        order = np.lexsort((member, key)) if not rest else np.argsort(key >> np.uint64(rest), kind="stable")
        key, member, spent = key[order], member[order], spent[order]
        same = key[1:] >> np.uint64(rest) == key[:-1] >> np.uint64(rest)
        shared = np.zeros(len(key), bool)
        shared[1:] |= same
        shared[:-1] |= same
        key, member, spent = key[shared], member[shared], spent[shared]
        if not len(key):
            continue
        if rest:
            todo.append((key, member, spent, rest))
            continue
        head = np.concatenate([[True], key[1:] != key[:-1]])
        smallest = member[np.flatnonzero(head)][np.cumsum(head) - 1]
        linked = (smallest != member) & (np.bitwise_count(smallest ^ member) <= distance)
        if linked.any():
            found.add(np.unique(np.stack([smallest[linked], member[linked]], 1), axis=0))
    return found.pairs()


class Forest:
    """Of the pairs that are added, those that connect what was not connected before."""

    def __init__(self):
        self.root: dict[int, int] = {}
        self.kept: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        root = self.root
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def add(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            x, y = self.find(a), self.find(b)
            if x != y:
                self.root[y] = x
                self.kept.append((a, b))

    def pairs(self) -> np.ndarray:
        return np.array(self.kept, np.uint64).reshape(-1, 2)


def links(spark: SparkSession, fps: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fp``, enough to connect every component."""
    if distance % 2:
        raise ValueError("the distance must be even: half of it is the radius of a ball")
    radius = distance // 2
    distinct = written(spark, fps.select("fp").distinct(), "simhash-fps")
    # about a million variants of the upper half a bucket: what one task holds stays the same at any size
    entries = distinct.count() * len(flips(HALF, radius)[0])
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = min(HALF - 2, max(least, entries >> 20).bit_length())

    def expand(key, frame: pd.DataFrame) -> pd.DataFrame:
        whole = lambda column: np.concatenate([np.frombuffer(x, np.uint64) for x in frame[column]])
        if key[0] == top:
            pairs = meet(int(key[1]), top, whole("members"), radius, distance)
        else:
            pairs = meet_at(whole("keys"), whole("members"), 64 - int(key[0]), radius, distance)
        return pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})

    blobs = shuffled(distinct, radius, top, hot_buckets(distinct, radius, top))
    return blobs.groupBy("depth", "bucket", "part").applyInPandas(expand, "a long, b long").distinct()


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the edges (a, b): alternating large-star and small-star steps."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            around = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).union(edges.select("b", "a"))
        else:
            around = edges.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("m"))
        least = around.groupBy("n").agg(F.min("m").alias("least")).select("n", F.least("n", "least").alias("root"))
        joined = around.join(least, "n")
        if large:
            moved = joined.filter("m > n").select(F.col("m").alias("a"), F.col("root").alias("b"))
        else:
            moved = joined.select(F.col("m").alias("a"), F.col("root").alias("b")).union(least.select(F.col("n").alias("a"), F.col("root").alias("b")))
        return moved.filter("a <> b").distinct()

    edges = written(spark, edges.select("a", "b"), "simhash-edges")
    before = None
    for _ in range(max_rounds):
        edges = written(spark, star(star(edges, True), False), "simhash-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def near_duplicates(spark: SparkSession, docs: DataFrame, *, words: int = 4, distance: int = 4, id_column: str = "doc_id") -> DataFrame:
    """(id, body, fp, root, component) of every row: ``body`` is a hash of the text, ``root`` names the
    component and ``component`` is the smallest id in it."""
    rows = written(spark, fingerprints(docs, words, id_column), "simhash-rows")
    owners = rows.groupBy("fp").agg(F.min("id").alias("least"))  # copies meet here, before any join
    roots = components(spark, links(spark, rows, distance)).withColumnRenamed("node", "fp")
    owners = owners.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    owners = written(spark, owners, "simhash-owners")
    smallest = owners.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(owners.join(smallest, "root").drop("least"), "fp").select("id", "body", "fp", "root", "component")


def keep_one(spark: SparkSession, docs: DataFrame, *, words: int = 4, distance: int = 4) -> DataFrame:
    """The documents without near copies: of each component the row of the smallest id stays (nulls
    last; of rows that share it, the smallest hash of the text; of equal rows, one)."""
    flat, names = packed(docs)
    key, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    found = near_duplicates(spark, docs, words=words, distance=distance)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "body")).alias("one"))
    repeated = found.groupBy("id", "body").count().filter("count > 1").select("id", "body", F.lit(True).alias("again"))
    match = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["body"] == b["body"])
    one = first.select("one.id", "one.body")
    one = one.join(repeated, match(one, repeated), "left").select(one["id"], one["body"], F.coalesce("again", F.lit(False)).alias("again"))
    body = flat.withColumn("body", body_hash(text))
    kept = body.join(one, body[key].eqNullSafe(one["id"]) & (body["body"] == one["body"])).select(body["*"], "again")
    kept = kept.filter("not again").unionByName(kept.filter("again").dropDuplicates([key, "body"]))
    return kept.drop("body", "again").toDF(*names)


def body_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def hex_digits(column: str):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
