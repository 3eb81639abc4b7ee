"""BPE encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablekeep.llm import bpe
from tablekeep.llm import queries as Q
from tablekeep.llm.common import read_table
from tests.llm.conftest import clash, frame

SF = "/root/testdata/sf0.001"
PATH = Q.tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(PATH)


def same(own, library, texts):
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    ids, rows = own.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])] == want
    signs, rows = bpe.offset_table(PATH).decode(ids, rows)
    assert [bytes(signs[a:b]).decode() for a, b in zip(rows[:-1], rows[1:])] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_mixed_signs(own, library):
    rng = random.Random(1)
    signs = ["a", "B", " ", "\n", ".", ",", "'", "s", "é", "1", "\t", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll", " the", "!", "日", "　", "\x85", "\x1c", "\0", "́", "İ", "ß", "Σ", "ǅ", "👍", "ᄒ", "ᅡ", "ᆫ", "\xa0", "²", "٣", "th", "in", "--", "À", "Ã©", "ÿ", "×", "µ"]
    same(own, library, ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(4000)] + [None, "", " ", None])


def test_merges_at_every_seam(own, library):
    rng = random.Random(2)
    pieces = [p.replace("</w>", "") for p in library.get_vocab() if p.isascii()]
    same(own, library, ["".join(rng.choice(pieces) for _ in range(rng.randint(2, 5))) for _ in range(4000)])
    same(own, library, ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(1500)])
    same(own, library, [c * n for c in "a-!x" for n in range(1, 90)])


def test_long_words_take_linear_time(own, library):
    same(own, library, ["x" * 20_000, "ab" * 10_000, "-" * 5_001, "é" * 3_000])
    ids, _ = own.encode(pa.array(["-" * 1_000_000]))
    assert len(ids) < 1_000_000


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 40)
    monkeypatch.setattr(bpe, "PAIRS", 10)
    small = bpe.Bpe(PATH)
    rng = random.Random(3)
    for _ in range(20):
        same(small, library, ["".join(rng.choice("abcde ") for _ in range(30)) for _ in range(9)])


def test_pieces_are_refused_unless_made_in_one_way():
    vocabulary = {t: i for i, t in enumerate(["a", "b", "a</w>", "b</w>", "ab", "aba", "ba"])}
    with pytest.raises(ValueError):
        bpe.Pieces(vocabulary, [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "ba")], "</w>")


def test_query_matches_the_library(spark, library):
    want = {}
    for doc_id, text in read_table(spark, SF, "documents").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    got = Q.QUERIES["op12_bpe"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want and len(got) == len(want)


def test_odd_rows(spark, odd_texts, library):
    docs = clash(frame(spark, [*odd_texts, "<|endoftext|>x"]))
    docs = docs.unionByName(docs.filter("doc_id = 3").selectExpr("cast(null as long) doc_id", "* except (doc_id)"))
    out = bpe.decode(bpe.encode(docs, tokenizer=PATH), tokenizer=PATH)
    assert out.columns == ["id", "ids", "text"]
    texts = dict(enumerate([*odd_texts, "<|endoftext|>x"])) | {None: "word"}
    rows = out.collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids and row["text"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), tokenizer=PATH).collect() == []
    stored = spark.createDataFrame([("x", None), ("y", bytearray(np.array([2**31, 1002, 60000, 3306], "<u4").tobytes()))], "id string, ids binary")
    assert [(r["id"], r["text"]) for r in bpe.decode(stored, tokenizer=PATH).collect()] == [("x", ""), ("y", "world</w> hello</w>")]
