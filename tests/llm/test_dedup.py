"""SimHash components and line dedup against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import xxhash

from tablekeep.llm import line_dedup, simhash
from tablekeep.llm import queries as Q
from tablekeep.llm.common import read_table
from tests.llm.conftest import clash, frame

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = [w.encode() for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_components(fps, distance=4):
    ids = sorted(fps)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if bin(fps[a] ^ fps[b]).count("1") <= distance]
    return roots(ids, edges)


def test_query_matches_brute_force(spark):
    rows = read_table(spark, SF, "documents").collect()
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    want = {i: (f"{fps[i]:016x}", c) for i, c in brute_components(fps).items()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in Q.QUERIES["op2_simhash"](spark, SF).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def near(rng, fp, bits):
    return fp ^ sum(1 << int(b) for b in rng.choice(64, bits, replace=False))


def test_ball_hashing_finds_every_link(spark):
    """Chains, a dense ball and far pairs; all buckets together give the components of all pairs."""
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(0, 2**63, 150)]
    fps += [near(rng, x, int(rng.integers(1, 7))) for x in fps[:100]]
    chain = [fps[0]]
    for _ in range(12):
        chain.append(near(rng, chain[-1], 4))
    fps += chain + [near(rng, 12345, 2) for _ in range(150)] + [0, 2**64 - 1]
    fps = sorted(set(fps))
    edges = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin(a ^ b).count("1") <= 4]
    want = roots(fps, edges)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    found = simhash.links(spark, spark.createDataFrame([(f,) for f in signed * 2], "fp long"), 4).collect()
    pairs = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in found]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in pairs)
    assert roots(fps, pairs) == want


def test_turns_do_not_change_the_result(monkeypatch):
    rng = np.random.default_rng(2)
    fp = np.unique(np.array([near(rng, 99, 2) for _ in range(200)], np.uint64))
    whole = simhash.meet(0, 4, fp, 2, 4)
    monkeypatch.setattr(simhash, "EXPAND", 5000)
    sliced = simhash.meet(0, 4, fp, 2, 4)
    members = lambda p: set(p.ravel().tolist())
    assert members(whole) == members(sliced)


def test_hot_buckets_are_split_and_lose_no_link(spark, monkeypatch):
    """Near copies of one template: no group of the shuffle keeps most of the work, and the components are those of all pairs."""
    rng = np.random.default_rng(6)
    fps = sorted({near(rng, 2**63 + 987654321, int(rng.integers(1, 6))) for _ in range(400)} | {int(x) for x in rng.integers(0, 2**63, 100)})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    monkeypatch.setattr(simhash, "SPLIT", 20_000)
    top = 6
    hot = simhash.hot_buckets(distinct, 2, top)
    assert len(hot) > 1 and all(d > top for d, _ in hot.values())

    def heaviest(hot):
        work = Counter()
        for r in simhash.shuffled(distinct, 2, top, hot).collect():
            fp = np.frombuffer(r["members"], np.uint64)
            key = simhash.high(np.uint64(r["bucket"]), fp, top) if r["keys"] is None else np.frombuffer(r["keys"], np.uint64)
            spent = np.bitwise_count(key ^ fp)
            work[r["depth"], r["bucket"], r["part"]] += int(np.array(simhash.completions(64 - r["depth"], 2))[spent].sum())
        assert sum(work.values()) == len(fps) * (1 + 64 + 64 * 63 // 2)  # every variant lies in one group
        return max(work.values())

    assert heaviest({}) > 100_000 and heaviest(hot) <= 60_000
    edges = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin(a ^ b).count("1") <= 4]
    pairs = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(spark, distinct, 4).collect()]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in pairs)
    assert roots(fps, pairs) == roots(fps, edges)


def test_work_of_a_large_group_grows_with_its_size(monkeypatch):
    """Variants are made once, however many parts a group is taken in."""
    rng = np.random.default_rng(8)
    made, flipped = [0], simhash.flipped

    def noted(*args):
        out = flipped(*args)
        made[0] += len(out[0])
        return out

    monkeypatch.setattr(simhash, "flipped", noted)
    monkeypatch.setattr(simhash, "EXPAND", 20_000)
    work = []
    for n in (500, 2000):
        made[0] = 0
        fps = np.array([near(rng, 99, 3) for _ in range(n)], np.uint64)
        pairs = simhash.meet(0, 4, fp=fps, radius=2, distance=4)
        assert (np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= 4).all()
        work.append(made[0] / len(np.unique(fps)))
    assert work[1] < 2 * work[0] < 20_000


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(spark, edges).collect()}
    assert {got[i] for i in range(1, 301)} == {0} and got[1001] == 1000
    assert simhash.components(spark, edges.limit(0)).collect() == []


def test_simhash_odd_rows(spark, odd_texts):
    docs = clash(frame(spark, odd_texts))
    docs = docs.unionByName(docs.filter("doc_id = 4"))  # a repeated row
    docs = docs.unionByName(docs.filter("doc_id = 3").selectExpr("cast(null as long) doc_id", "* except (doc_id)"))
    got = simhash.near_duplicates(spark, docs).collect()
    by_id = {r["id"]: r for r in got}
    assert len(got) == len(odd_texts) + 2
    assert by_id[0]["fp"] == by_id[1]["fp"] == by_id[2]["fp"] == 0 and by_id[2]["component"] == 0
    assert by_id[5]["component"] == 4 and by_id[None]["component"] == 3
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 4, 6, 7, 8]
    assert simhash.near_duplicates(spark, docs.limit(0)).collect() == []
    assert simhash.keep_one(spark, docs.limit(0)).collect() == []


def test_keep_one_with_an_id_for_different_texts(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (1, "one two three four five"), (2, "one two three four five")], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.keep_one(spark, docs).collect()) == ["alpha beta gamma delta", "one two three four five"]


WHITE = " \t\n\x0b\x0c\r"


def brute_lines(texts, least):
    low = lambda x: x.strip(WHITE).translate({c: c + 32 for c in range(65, 91)})
    seen = Counter(k for t in texts for k in {low(x) for x in (t or "").split("\n")} if k)
    kept = [[x for x in (t or "").split("\n") if not (low(x) and seen[low(x)] >= least)] for t in texts]
    return [("\n".join(k), len((t or "").split("\n")), len((t or "").split("\n")) - len(k)) for t, k in zip(texts, kept)]


def test_lines_against_brute_force(spark, odd_texts):
    texts = odd_texts + ["Common LINE\nown %d\n\x0b" % i for i in range(12)] + ["\tcommon line \r\n\n", "É\né", "É", "é"]
    docs = clash(frame(spark, texts))
    for least, batches in ((2, 3), (12, 5), (100, 1)):
        out = line_dedup.dedup_lines(spark, docs, min_docs=least, batches=batches)
        assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
        got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()}
        assert got == dict(enumerate(brute_lines(texts, least)))
    assert line_dedup.dedup_lines(spark, docs.limit(0)).collect() == []


def test_runs_are_compacted_and_add_up(spark):
    docs = frame(spark, [f"shared\nonly {i}" for i in range(40)])
    runs, _ = line_dedup.build_runs(spark, docs, min_docs=100, batches=8)
    assert len(runs.paths()) == 1 and list(k for k, v in runs.levels.items() if v) == [3]
    counts = sorted(r["n_docs"] for r in runs.counts().collect())
    assert counts == [1] * 40 + [40]
    early, _ = line_dedup.build_runs(spark, docs, min_docs=4, batches=8)
    assert early.common().count() == 1  # the anti join keeps a common key common


def test_line_dedup_stays_in_the_jvm(spark):
    plan = line_dedup.dedup_lines(spark, frame(spark, ["a\nb", "a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_kept_hash_of_the_query(spark):
    got = {r["doc_id"]: r["kept_sha256"] for r in Q.QUERIES["op3_line_dedup"](spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").collect()}
    ids = sorted(texts)
    want = {i: hashlib.sha256(k.encode()).hexdigest() for i, (k, _, _) in zip(ids, brute_lines([texts[i] for i in ids], 10))}
    assert got == want
