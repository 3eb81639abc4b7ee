"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and its result is written as Parquet and
read again as the next stage's documents. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeep.llm import decontaminate, line_dedup, quality, sentencepiece_nbest, simhash
from tablekeep.llm.common import packed, read_table, written
from tablekeep.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.5)."""
    model = quality.train_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in ten documents or more; ``n_chars`` follows the text."""
    names = list(docs.columns)
    flat, _ = packed(line_dedup.dedup_lines(spark, docs, min_docs=10))
    columns = [F.col(f"c{i}") for i in range(len(names))]
    text, n_chars = names.index("text"), names.index("n_chars")
    columns[n_chars] = F.char_length(f"c{text}").cast(docs.schema.fields[n_chars].dataType).alias(f"c{n_chars}")
    return flat.select(*columns).toDF(*names)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(spark, docs, words=4, distance=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(spark, docs, read_table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids (little-endian 32-bit) of every document, their number and score, and how far the second best is."""
    out = sentencepiece_nbest.encode(docs, model=tokenizer_path("piece_bpe_32k.model"), n=2)
    return out.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), "score", (F.col("score") - F.get("scores", F.lit(1))).alias("margin"), "ids")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_common_lines),
    ("near_duplicates", keep_one_copy),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode_pieces),
]

#: Classifier, fingerprints and segmentation cannot be expressed in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
