"""Approximate nearest neighbours with randomly rotated one-bit codes.

Each vector is centred, rotated by a seeded random orthogonal matrix and kept
as the signs of its components, packed to bits, with two correction scalars:
its distance from the centre and the inner product of the unit vector with its
code. From these a query estimates every squared distance and an error bound;
a vector whose lower bound exceeds the exact distance of the k-th best so far
is passed over, the others are reranked with exact distances.

All vectors are indexed. The stated query set meets all vectors in blocks: the
vectors are dealt out in blocks of ``BASE_ROWS``, the queries in blocks of at
most ``QUERY_BYTES``, and a task holds one block of each; the large block of
queries keeps the copies of the vectors that travel few. Each block returns its k
best of each query, and the k best of all blocks are the answer.

Distances are double precision, added up in component order; ties go to the
smaller id.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do vectors of another length than the most common
one; repeated rows (same id and vector) count once, different vectors of one id
are one vector with the smaller distance; a null id takes no part; an empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, written

BASE_ROWS = 8192
QUERY_BYTES = 16 << 20
#: Standard deviations of the estimate that the error bound covers.
BOUND = 3.0
RESULT = "query_id long, vec_id long, score double"


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, distance from the centre, inner product of unit vector and code)."""
    dim = vectors.shape[1]
    moved = (vectors - centre) @ rotate
    norm = np.sqrt((moved * moved).sum(1))
    unit = moved / np.where(norm > 0, norm, 1)[:, None]
    bits = unit >= 0
    match = np.abs(unit).sum(1) / np.sqrt(dim)
    return np.packbits(bits, axis=1), norm, np.where(norm > 0, match, 1.0)


def exact(base: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, added up in component order."""
    total = np.zeros(len(base))
    for j in range(base.shape[1]):
        d = base[:, j] - query[j]
        total += d * d
    return total


def search_block(q_ids, queries, ids, codes, norm, match, base, centre, rotate, k: int) -> list[tuple[int, int, float]]:
    """The k nearest of each query within one block."""
    dim = base.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    signs /= np.sqrt(dim, dtype=np.float32)
    spread = BOUND * np.sqrt(np.maximum(1 - match**2, 0)) / match / np.sqrt(max(dim - 1, 1))
    out = []
    for lo in range(0, len(q_ids), 64):
        moved = (queries[lo : lo + 64] - centre) @ rotate
        inner = (signs @ moved.T.astype(np.float32)).astype(np.float64) / match[:, None]
        for i, query in enumerate(queries[lo : lo + 64]):
            length = np.sqrt((moved[i] ** 2).sum())
            near = norm**2 + length**2 - 2 * norm * inner[:, i]
            other = np.flatnonzero(ids != q_ids[lo + i])
            if not len(other):
                continue
            first = other[np.argpartition(near[other], k - 1)[:k]] if len(other) > k else other
            worst = exact(base[first], query).max() if len(other) > k else np.inf
            low = near[other] - 2 * norm[other] * spread[other] * length
            rest = other[low <= worst * (1 + 1e-5) + 1e-12]
            distance = np.sqrt(exact(base[rest], query))
            order = np.lexsort((ids[rest], distance))[:k]
            out += [(int(q_ids[lo + i]), int(ids[rest[o]]), float(distance[o])) for o in order]
    return out


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the rows that take part, once each, and their dimension (0: none)."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = pick(vectors, vec_id=id_column, v=vector_column).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", fine) & F.exists("v", lambda x: x != 0)).withColumn("vec_id", F.col("vec_id").cast("long"))
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    return rows.filter(F.size("v") == dim).dropDuplicates(["vec_id", "v"]), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, dim)


def centre_of(rows: DataFrame, dim: int) -> np.ndarray:
    """Mean vector: one row of sums for each batch, added up by Spark."""

    def sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            total = matrix(frame.column("v"), dim).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total), pa.array(np.full(dim, frame.num_rows))], ["at", "total", "n"])

    got = rows.select("v").mapInArrow(sums, "at int, total double, n long").groupBy("at").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    centre = np.zeros(dim)
    for row in got:  # one row for each component
        centre[row["at"]] = row["mean"]
    return centre


def nearest(spark: SparkSession, vectors: DataFrame, *, is_query, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which ``is_query(vec_id)`` holds."""
    rows, dim = usable(vectors, id_column, vector_column)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = written(spark, rows, "ann-vectors")
    n = rows.agg(F.count(F.lit(1)), F.count_if(is_query(F.col("vec_id")))).first()
    parts, blocks = -(-n[0] // BASE_ROWS), max(1, -(-n[1] * dim * 8 // QUERY_BYTES))
    # stored at the width of the column; measured in double precision
    kind = np.float32 if rows.schema["v"].dataType.elementType.typeName() == "float" else np.float64
    centre, rotate = centre_of(rows, dim), rotation(dim)

    def index(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            own = matrix(frame.column("v"), dim)
            codes, norm, match = encode(own, centre, rotate)
            yield pa.RecordBatch.from_arrays([frame.column("vec_id"), pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(norm), pa.array(match), pa.array([x.tobytes() for x in own.astype(kind)], pa.binary())], ["vec_id", "code", "norm", "fit", "v"])

    def search(key, queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        read = lambda column, kind: np.stack([np.frombuffer(x, kind) for x in column])
        found = []
        if len(queries) and len(base):
            found = search_block(queries["vec_id"].to_numpy(), read(queries["v"], kind).astype(np.float64), base["vec_id"].to_numpy(), read(base["code"], np.uint8), base["norm"].to_numpy(), base["fit"].to_numpy(), read(base["v"], kind).astype(np.float64), centre, rotate, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    codes = rows.mapInArrow(index, "vec_id long, code binary, norm double, fit double, v binary")
    spot = F.xxhash64("vec_id", "v")
    base = codes.withColumn("part", F.pmod(spot, F.lit(parts))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    asked = codes.filter(is_query(F.col("vec_id"))).select("vec_id", "v", F.pmod(spot, F.lit(blocks)).alias("block"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    found = asked.groupBy("part", "block").cogroup(base.groupBy("part", "block")).applyInPandas(search, RESULT)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
