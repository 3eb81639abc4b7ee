"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

``LineRuns`` keeps, in the shared work folder, runs of (h1, h2, n_docs): the
128-bit hash of a line's key and the number of documents that hold it, sorted
by hash. A batch of documents is counted, its keys that the runs already know
as common are removed by a merge anti join, and the rest is added as one sorted
run of level 0. When a level has ``fanout`` runs they are compacted into one
run of the next level, which adds up the counts; so there are few runs at any
time and a key is rewritten a logarithmic number of times.

A line's key is the line without white space at its ends, A-Z lower-cased. A key
found in at least ``min_docs`` documents is common, and all lines with a common
key go, in every document. Keys with fewer than ``min_chars`` code points
(the empty key at least) are never counted.

Counts are pre-aggregated before each shuffle, so a line of a third of all
documents is one row a task; a document's lines are dropped inside its row, and
no line text is shuffled on its own.

Defined results: a null or empty text is one empty line, and stays; a document
is a row, so repeated rows count each; a null id is a document like any other;
an empty table gives an empty result and no run. Extra columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from .common import packed, pick

#: White space that is stripped, and the letters that are lower-cased.
STRIP = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

RUN_SCHEMA = "h1 long, h2 long, n_docs long"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIP)), UPPER, UPPER.lower())


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def keyed_lines(docs: DataFrame, id_column: str = "doc_id", min_chars: int = 1) -> DataFrame:
    """(doc_id, h1, h2): each key of a document once."""
    rows = pick(docs, doc_id=id_column, text="text")
    keys = F.filter(F.array_distinct(F.transform(lines_of(F.col("text")), line_key)), lambda k: F.char_length(k) >= max(1, min_chars))
    return rows.select("doc_id", F.explode(F.transform(keys, key_hash)).alias("h")).select("doc_id", "h.h1", "h.h2")


@dataclass
class LineRuns:
    spark: SparkSession
    min_docs: int = 10
    fanout: int = 2
    root: str = ""
    levels: dict[int, list[str]] = field(default_factory=dict)
    made: int = 0

    def __post_init__(self):
        self.root = self.root or scratch(self.spark, "llm-line-runs")

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.root}/level{level}-{self.made:05d}"
        self.made += 1
        run.sortWithinPartitions("h1", "h2").write.parquet(path)
        self.levels.setdefault(level, []).append(path)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths)

    def paths(self) -> list[str]:
        return [p for level in sorted(self.levels) for p in self.levels[level]]

    def counts(self) -> DataFrame:
        """(h1, h2, n_docs) added up over all runs."""
        return self._read(self.paths()).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))

    def common(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``min_docs`` documents so far."""
        return self.counts().filter(F.col("n_docs") >= self.min_docs).select("h1", "h2")

    def add(self, keyed: DataFrame) -> None:
        """Count a batch (h1, h2 once a document) and add what is not yet common as a run."""
        batch = keyed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))
        if self.levels:
            batch = batch.join(self.common().hint("merge"), ["h1", "h2"], "left_anti")
        self._write(batch.select("h1", "h2", "n_docs"), 0)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            paths = self.levels.pop(level)
            merged = self._read(paths).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
            self._write(merged, level + 1)
            level += 1


def build_runs(spark: SparkSession, docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2) -> tuple[LineRuns, DataFrame]:
    """Runs over all documents, taken in ``batches`` batches by id; and the keyed lines."""
    path = scratch(spark, "llm-lines")
    keyed = keyed_lines(docs, min_chars=min_chars)
    keyed.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(path)
    keyed = spark.read.schema(f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, min_docs=min_docs, fanout=fanout)
    for batch in range(batches):
        runs.add(keyed.filter(F.col("batch") == batch))
    return runs, keyed


def dedup_lines(spark: SparkSession, docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1, batches: int = 4) -> DataFrame:
    """The documents with ``text`` replaced by the lines that stay, plus ``n_lines`` (before) and ``n_dropped``.

    Of each document only the hashes of its common lines are joined to it; the
    lines are then dropped inside the row.
    """
    runs, keyed = build_runs(spark, docs, min_docs=min_docs, min_chars=min_chars, batches=batches)
    bad = keyed.join(runs.common(), ["h1", "h2"], "left_semi").groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("bad"))
    flat, names = packed(docs)
    key, text = f"c{names.index('doc_id')}", F.col(f"c{names.index('text')}")
    joined = flat.join(bad, F.col(key).eqNullSafe(F.col("doc_id")), "left")
    lines = lines_of(text)
    kept = F.filter(lines, lambda line: ~F.array_contains(F.col("bad"), key_hash(line_key(line))))
    kept = F.when(F.col("bad").isNull(), lines).otherwise(kept)
    out = joined.withColumn("lines", lines).withColumn("kept", kept)
    values = [F.array_join("kept", "\n") if i == names.index("text") else F.col(f"c{i}") for i in range(len(names))]
    sizes = [F.size("lines").cast("long"), (F.size("lines") - F.size("kept")).cast("long")]
    return out.select(*[v.alias(f"o{i}") for i, v in enumerate(values + sizes)]).toDF(*names, "n_lines", "n_dropped")
