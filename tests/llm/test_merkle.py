"""The Merkle manifest against trees built in one piece, and against SQL."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
from pyspark.sql import functions as F

from tablekeep.llm import merkle
from tablekeep.llm import queries as Q
from tests.llm.conftest import clash, frame

SF = "/root/testdata/sf0.001"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    """(left, right) of every level."""
    out = []
    for nodes in levels[:-1]:
        lo = at // 16 * 16
        out.append(("".join(nodes[lo:at]), "".join(nodes[at + 1 : lo + 16])))
        at //= 16
    return out


def fold(node, path):
    out = [node]
    for left, right in path:
        out.append(H(left + out[-1] + right))
    return out


def brute(leaves):
    """Rows of the manifest, by group, for (id, group, leaf, tampered)."""
    groups = {}
    for row in sorted(leaves, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([r[2] for r in groups[g]]) for g in names}
    upper = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (i, _, leaf, tampered) in enumerate(groups[g]):
            path = siblings(trees[g], at) + siblings(upper, k)
            version = fold(tampered, path) if tampered else None
            out.append((i, g, at, leaf, trees[g][-1][0], upper[-1][0], "".join(a + b for a, b in path), version, fold(tampered or leaf, path)[-1]))
    return out


def shown(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


LEAF = "id long, source string, leaf string, tampered string"


def test_many_groups_and_rounds(spark):
    """A group beyond two rounds of blocks, groups that end at block borders, and many small ones."""
    sizes = {"hot": 9000, "full": 4096, "over": 4097, "": 16, "é": 1, None: 17, "Z": 257} | {f"g{i}": 1 + i % 3 for i in range(30)}
    leaves, i = [], 0
    for group, size in sizes.items():
        for _ in range(size):
            i = (i * 7919 + 13) % 1_000_003
            leaves.append((i, group, H(f"leaf{i}"), H(f"other{i}") if i % 5 == 0 else None))
    got = merkle.manifest(spark, spark.createDataFrame(leaves, LEAF).repartition(5)).collect()
    want = brute(leaves)
    assert shown(got) == shown(want)
    roots = {r["folded"] == r["root"] for r in got if r["version"] is None}
    assert roots == {True} and all(r["folded"] != r["root"] and r["version"][-1] == r["folded"] for r in got if r["version"])


def test_versions_share_all_but_the_path(spark):
    leaves = [(i, "s", H(str(i)), H("x") if i == 300 else None) for i in range(600)]
    row = [r for r in merkle.manifest(spark, spark.createDataFrame(leaves, LEAF)).collect() if r["version"]][0]
    old = tree([leaf for _, _, leaf, _ in leaves])
    new = tree([tampered or leaf for _, _, leaf, tampered in leaves])
    changed = [b for level, other in zip(old, new) for a, b in zip(level, other) if a != b]
    assert row["version"] == changed and len(changed) == len(old)


def test_ties_and_lone_groups(spark):
    leaves = [(5, "a", H("p"), H("q"))] * 3 + [(5, "a", H("b"), None), (None, "a", H("n"), None), (None, "a", H("m"), H("o"))]
    assert shown(merkle.manifest(spark, spark.createDataFrame(leaves, LEAF)).collect()) == shown(brute(leaves))
    one = [(1, None, H("one"), H("two"))]
    (row,) = merkle.manifest(spark, spark.createDataFrame(one, LEAF)).collect()
    assert row["root"] == row["subroot"] == row["leaf"] == H("one") and row["proof"] == "" and row["version"] == [H("two")]
    assert merkle.manifest(spark, spark.createDataFrame([], LEAF)).collect() == []


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def test_documents_of_odd_rows(spark, odd_texts):
    docs = clash(frame(spark, [*odd_texts, "ÀB", "TAMPER"])).withColumn("source", F.when(F.col("doc_id") % 3 != 0, F.col("source"))).withColumn("n_chars", F.when(F.col("doc_id") != 2, F.col("n_chars")))
    docs = docs.unionByName(docs.filter("doc_id = 10")).unionByName(docs.filter("doc_id = 4").selectExpr("cast(null as long) doc_id", "* except (doc_id)"))
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    upper = {c: c + 32 for c in range(65, 91)}
    leaves = [(i, s, H("".join(map(field, (i, s, lang, n, text)))), H("".join(map(field, (i, s, lang, n, text and text.translate(upper)))))) for i, s, lang, n, text in rows]
    got = merkle.documents_manifest(spark, docs, F.lit(True)).collect()
    assert shown(got) == shown(brute(leaves))


def test_query_matches_sql_and_crc(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(Q.ORACLES["op13_merkle"]).fetchall())
    got = sorted(tuple(r) for r in Q.QUERIES["op13_merkle"](spark, SF).collect())
    assert got == want
    changed = {r[0] for r in want if not r[-1]}
    lower = {i for i, text in con.execute("SELECT doc_id, text FROM documents").fetchall() if zlib.crc32(str(i).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in text or "")}
    assert changed == lower
