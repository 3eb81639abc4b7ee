"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tablekeep.llm import periods
from tablekeep.llm import queries as Q
from tablekeep.llm.common import read_table
from tests.llm.conftest import clash, frame

SF = "/root/testdata/sf0.001"


def brute_runs(words, most=10**9):
    """Stretches of smallest period q, of max(6, 4q) words or more, that cannot be extended; every period
    up to ``most`` is tried."""
    out = {}
    n = len(words)
    for q in range(1, min(most, n // 4) + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j + q), q)  # a smaller period of the same stretch came before
            i = j + 1
    return sorted((a, q, b - a) for (a, b), q in out.items())


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def collapsed(words, runs):
    drop = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def texts_of(rng, count, longest):
    """Words of few kinds with repeats of many periods, nested and next to each other."""
    out = []
    for _ in range(count):
        words = []
        while len(words) < rng.randint(0, longest):
            unit = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 30, 70]))]
            if rng.random() < 0.3:
                unit = unit * rng.randint(2, 5) + [rng.choice("abcd")]
            stretch = unit * rng.randint(1, 7)
            words += stretch[: rng.randint(1, len(stretch))]
        out.append(" ".join(words))
    return out


def short_runs(texts):
    joined, found = periods.short_fragments(pa.array(texts))
    assert joined.to_pylist() == [" ".join(split(t)) for t in texts]
    return [sorted((f["start"], f["period"], f["stop"] - f["start"] + f["period"]) for f in rows) for rows in found]


def test_short_documents():
    texts = texts_of(random.Random(1), 400, 250) + [" ".join("ab"[i % 2] for i in range(n)) for n in range(20)] + [" ".join("a" * n) for n in range(15)]
    assert short_runs(texts) == [brute_runs(split(t)) for t in texts]


def test_fibonacci_words():
    a, b = "x", "xy"
    while len(b) < 900:
        a, b = b, b + a
    texts = [" ".join(b), " ".join(b * 2)]
    assert short_runs(texts) == [brute_runs(split(t)) for t in texts]


def test_z_function():
    rng = random.Random(5)
    for _ in range(500):
        text = [rng.choice([1, 2]) for _ in range(rng.randint(1, 30))]
        want = [next((k for k in range(len(text) - i) if text[k] != text[i + k]), len(text) - i) for i in range(len(text))]
        assert periods.z_function(text, len(text))[1:] == want[1:]


@pytest.fixture()
def small_tiles(monkeypatch):
    """Tiles of 64 words, so that small documents are long ones; tasks run in this process."""
    monkeypatch.setattr(periods, "WORDS", 64)


def tiled_runs(text):
    words = split(text)
    codes = np.unique(np.array(words), return_inverse=True)[1].astype(np.int64)
    parts = {}
    for low, high, start, core, core_stop, stop in periods.tiles_of(len(words)):
        own = codes[start:stop]
        for _, p, a, b in periods.solve(own, np.array([0, len(own)]), np.array([[core - start, core_stop - start]]), np.array([start]), periods.octaves_of(low, high)):
            parts.setdefault(p, []).append((a, b))
    out = []
    for p, found in parts.items():
        whole = []
        for a, b in sorted(found):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], b)
            else:
                whole.append([a, b])
        out += [(a, p, b - a + p) for a, b in whole]
    return sorted(out)


def test_runs_do_not_depend_on_tiles(small_tiles):
    rng = random.Random(2)
    texts = texts_of(rng, 60, 1500) + [" ".join(["w"] * 1000), " ".join(str(i % 211) for i in range(1500)), " ".join(str(i % 37) for i in range(1400)) + " q " + " ".join("ab" * 300)]
    for text in texts:
        assert tiled_runs(text) == brute_runs(split(text))
    tiles = list(periods.tiles_of(1500))
    assert len({t[:2] for t in tiles}) > 3 and len(tiles) > 40  # several octaves, several tiles each


def test_long_documents_travel_in_tiles(spark):
    """Documents beyond one tile: a run over many tiles, one of a long period, and none."""
    rng = random.Random(3)
    noise = [f"n{rng.randrange(5000)}" for _ in range(120_000)]
    long = [f"p{i}" for i in range(9000)]
    texts = [
        " ".join([*noise[:40_000], *(["again"] * 90_000), *noise[:10]]),
        "\t".join([*noise[:30_000], *long, *long, *long, *long, *long[:77], *noise[:5]]),
        "\n".join(noise),
        "a b a b a b a b",
    ]
    want = {0: [(40_000, 1, 90_000)], 1: [(30_000, 9000, 36_077)], 2: [], 3: [(0, 2, 8)]}
    docs = frame(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id = 0")).repartition(3)
    rows = periods.collapse_runs(spark, docs).collect()
    assert sorted(r["id"] for r in rows) == [0, 0, 1, 2, 3]
    for r in rows:
        runs = [(x["start"], x["period"], x["length"]) for x in r["runs"]]
        assert runs == want[r["id"]] and r["kept"] == collapsed(split(texts[r["id"]]), runs)


def test_query_matches_brute_force(spark):
    want = {}
    for doc_id, text in read_table(spark, SF, "documents").select("doc_id", "text").collect():
        words = split(text)
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[2], -r[0], -r[1]), default=None)
        top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
        text = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        want[doc_id] = (len(runs), *top, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    rows = Q.QUERIES["op11_periods"](spark, SF).collect()
    got = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"]) for r in rows}
    assert got == want and len(rows) == len(want) and sum(v[0] > 0 for v in want.values()) > 5


def test_odd_rows(spark, odd_texts):
    texts = [*odd_texts, "x x x x x x", "x x x x x", "r\x1cr r\x1cr r\x1cr r\x1cr r\x1cr r\x1cr", "é é é é é é é"]
    docs = clash(frame(spark, texts))
    docs = docs.unionByName(docs.filter("doc_id = 10")).unionByName(docs.filter("doc_id in (9, 12)").selectExpr("cast(null as long) doc_id", "* except (doc_id)"))
    rows = periods.collapse_runs(spark, docs).collect()
    assert len(rows) == len(texts) + 3 and rows[0].asDict().keys() == {"id", "kept", "runs"}
    known = dict(enumerate(texts))
    for r in rows:
        if r["id"] is not None:
            words = split(known[r["id"]])
            runs = brute_runs(words, 20)  # chance repeats of the long random text are short
            assert [(x["start"], x["period"], x["length"]) for x in r["runs"]] == runs and r["kept"] == collapsed(words, runs)
    assert sorted(r["kept"] for r in rows if r["id"] is None) == ["x", "é"]
    assert periods.collapse_runs(spark, docs.limit(0)).collect() == []
