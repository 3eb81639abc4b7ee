"""The pipeline against its operators' brute-force versions, and the oracles of the queries."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline as P
from tablekeep.llm import quality
from tablekeep.llm import queries as Q
from tablekeep.llm import sentencepiece_nbest
from tablekeep.llm.common import read_table
from tests.llm.conftest import clash
from tests.llm.test_dedup import brute_components, brute_fingerprint, brute_lines
from tests.llm.test_search import brute_hits
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    rel = duck.sql(Q.ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of(rel.columns, rel.fetchall())


def test_pipeline_against_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    model = quality.train_quality(docs, read_table(spark, SF, "labels"))
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if scores[r["doc_id"]] >= 0.5}
    ids = sorted(texts)
    texts = {i: k for i, (k, _, _) in zip(ids, brute_lines([texts[i] for i in ids], 10))}
    group = brute_components({i: brute_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if group[i] == i}
    items = [tuple(r) for r in read_table(spark, SF, "benchmark").select("item_id", "text").collect()]
    texts = {i: t for i, t in texts.items() if not brute_hits(t, items)[1]}
    lattice = sentencepiece_nbest.Lattice(Q.tokenizer_path("piece_bpe_32k.model"))
    want = {i: lattice.encode([t], 1)[0][0] for i, t in texts.items()}
    got = {r["doc_id"]: (r["score"], bytes(r["ids"])) for r in P.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < 200


def test_stages_keep_the_columns(spark):
    docs = clash(read_table(spark, SF, "documents"))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        assert stage(spark, docs.limit(0), SF).collect() == [], name
    assert P.STAGES[-1][1](spark, docs.limit(0), SF).collect() == []


def test_registered_whole(spark):
    import __spark_entry__ as E

    assert set(Q.QUERIES) <= set(E.queries()) and set(Q.ORACLES) <= set(E.oracle_sql())
