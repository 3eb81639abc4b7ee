"""Held-out accuracy, and defined results on odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tablekeep.llm import common, quality, toxicity
from tablekeep.llm import queries as Q
from tablekeep.llm.common import read_table
from tests.llm.conftest import DOC, clash, frame

SF = "/root/testdata/sf0.01"


def held_out(spark, name, label):
    scored = Q.QUERIES[name](spark, SF)
    return scored.join(read_table(spark, SF, "labels"), "doc_id").filter("held_out").select(label, "predicted").toPandas()


def test_quality_held_out(spark):
    got = held_out(spark, "op1_quality", "quality")
    assert len(got) > 80 and (got["quality"] == got["predicted"]).mean() >= 0.95
    assert Q.op1_quality(spark, SF).count() == 1000


def test_toxicity_held_out(spark):
    got = held_out(spark, "op6_toxicity", "toxic")
    assert (got["toxic"] == got["predicted"]).mean() >= 0.9
    assert got[got["toxic"] == 0]["predicted"].mean() <= 0.05  # clean documents are left alone


def test_toxic_stems_are_learned():
    rng = np.random.default_rng(0)
    names = [f"w{i}" for i in range(300)]
    make = lambda bad, i: " ".join([*rng.choice(names, 40), *(["grumbl" + "abcdefghijklmnop"[i % 16] * 2] if bad else [])])
    labels = np.arange(400) % 4 == 0
    texts = pa.array([make(b, i) for i, b in enumerate(labels)])
    ids, counts = toxicity.word_ids(texts)
    bags = np.split(ids, np.cumsum(counts)[:-1])
    model = toxicity.calibrate(toxicity.fit(bags[:300], labels[:300].astype(int)), bags[300:], labels[300:].astype(int), ["en"] * 100)
    fresh = model.score(pa.array(["w1 w2 grumblzz w3", "w1 w2 w3 w4", None, ""]))
    assert fresh[0] >= 0.5 > fresh[1] and fresh[2] == fresh[3] < 0.5


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_quality(p, passages):
    """Score of one document, passage by passage."""
    codes = [np.tanh(x @ p["W"] + p["b"]) for x in passages]
    power = np.array([p["a"] @ (np.tanh(h @ p["V"]) * sigmoid(h @ p["U"])) for h in codes])
    share = np.exp(power) / np.exp(power).sum()
    return sigmoid(sum(s * h for s, h in zip(share, codes)) @ p["c"] + p["d"][0])


def plain_toxicity(p, words):
    """Logit of one document, filter by filter and window by window; past its words there are empty ones."""
    vectors = [p["E"][row].sum(0) for row in words] or [np.zeros(toxicity.WIDTH)]
    total, n = p["d"][0], 0
    for k in toxicity.SPANS:
        for f in range(toxicity.FILTERS):
            windows = [sum(vectors[i + j] @ p[f"W{k}"][j][:, f] for j in range(k) if i + j < len(vectors)) for i in range(len(vectors))]
            total, n = total + p["c"][n] * max(0, max(windows) + p[f"b{k}"][f]), n + 1
    return total


def check_first_step(fit, loss, rate, seed):
    """The first Adam step from the start goes by ``rate`` against the sign of each derivative; derivatives are
    central differences of a plain loss in double precision, for entries of every parameter. Returns how many."""
    start, moved = (fit(epochs).p for epochs in (0, 1))
    rng, checked = np.random.default_rng(seed), {}
    for name in start:
        if name == "known":
            continue
        for at in rng.permutation(start[name].size)[:60]:
            sides = []
            for move in (1e-5, -1e-5):
                p = {k: x.astype(np.float64) if k != "known" else x for k, x in start.items()}
                p[name].flat[at] += move
                sides.append(loss(p))
            slope = (sides[0] - sides[1]) / 2e-5
            if abs(slope) > 1e-5:
                step = float(moved[name].flat[at]) - float(start[name].flat[at])
                assert step == pytest.approx(-rate * np.sign(slope), rel=0.15), (name, at, slope)
                checked[name] = checked.get(name, 0) + 1
    return checked


def test_quality_gradient_and_plain_scorer():
    rng = np.random.default_rng(1)
    bags = [rng.random((k, quality.DIMS)).astype(np.float32) for k in (1, 3, 2, 5)]
    y = np.array([1, 0, 1, 0])
    wide = [b.astype(np.float64) for b in bags]

    def loss(p):
        s = np.array([plain_quality(p, b) for b in wide])
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s)) + 0.5e-4 * (p["W"] ** 2).sum()

    checked = check_first_step(lambda epochs: quality.fit(bags, y, epochs=epochs, batch=4), loss, 0.0044, 2)
    assert set(checked) == {"W", "b", "V", "U", "a", "c", "d"} and sum(checked.values()) > 100
    model = quality.fit(bags, y, epochs=3, batch=2)
    texts = pa.array(["one two three", None, "", "word " * 700, "x" * 9000])
    x, counts = quality.passage_features(texts)
    want = [plain_quality(model.p, b) for b in np.split(x, np.cumsum(counts)[:-1])]
    assert np.allclose(model.score(texts), want, atol=1e-5)


def test_toxicity_gradient_and_plain_scorer():
    rng = np.random.default_rng(4)
    bags = [rng.integers(0, 25, (n, len(toxicity.PARTS))) for n in (7, 1, 12, 30, 4, 9, 15, 2, 40, 22, 5, 3)]
    y = np.arange(12) % 3 == 0
    weight = np.where(y, 2.0, 1.0)

    def loss(p):
        s = sigmoid(np.array([plain_toxicity(p, p["known"][b]) for b in bags]))
        return -np.mean(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))) + 0.5e-4 * (p["c"] ** 2).sum() + 1e-5 * (p["E"] ** 2).sum()

    checked = check_first_step(lambda epochs: toxicity.fit(bags, y.astype(int), epochs=epochs, batch=12), loss, 0.011, 5)
    assert {"E", "W1", "W2", "W3", "c", "d"} <= set(checked) and sum(checked.values()) > 150
    model = toxicity.fit(bags, y.astype(int), epochs=2, batch=4)
    texts = pa.array(["one two three", None, "", "word other " * 50, "Zz"])
    ids, counts = toxicity.word_ids(texts)
    want = [sigmoid(plain_toxicity(model.p, model.p["known"][b])) for b in np.split(ids, np.cumsum(counts)[:-1])]
    assert np.allclose(model.score(texts), want, atol=1e-5)


def test_attention_learns_a_few_bags():
    rng = np.random.default_rng(1)
    bags = [rng.random((k, quality.DIMS)).astype(np.float32) for k in (1, 3, 2)]
    y = np.array([1, 0, 1], np.float32)
    model = quality.fit(bags, y, epochs=1, batch=3)
    counts = np.array([len(b) for b in bags])
    before = model.bags(model.encode(np.concatenate(bags)), counts)["score"]
    more = quality.fit(bags, y, epochs=40, batch=3)
    after = more.bags(more.encode(np.concatenate(bags)), counts)["score"]
    loss = lambda s: -np.mean(y * np.log(s + 1e-9) + (1 - y) * np.log(1 - s + 1e-9))
    assert loss(after) < loss(before) and loss(after) < 0.1


def test_passages_cover_whole_texts():
    text = " ".join(["word"] * (quality.PASSAGE_WORDS * 3 + 1))
    x, counts = quality.passage_features(pa.array([text, None, "", "one"]))
    assert counts.tolist() == [4, 1, 1, 1] and x.shape == (7, quality.DIMS)
    alone, _ = quality.passage_features(pa.array([text]))
    assert np.array_equal(alone, x[:4])  # other texts of the batch change nothing


@pytest.mark.parametrize("train,score,label", [(quality.train_quality, quality.score_quality, "quality"), (toxicity.train_toxicity, toxicity.score_toxicity, "toxic")])
def test_odd_rows(spark, odd_texts, train, score, label):
    docs = clash(frame(spark, odd_texts)).unionByName(clash(frame(spark, ["no id"])).selectExpr("cast(null as long) doc_id", "* except (doc_id)"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = train(docs, none)
    got = {(r["doc_id"], r["score"]) for r in score(docs, model).collect()}
    assert len({s for _, s in got}) == 1 and len(got) == len(odd_texts) + 1
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(9)] + [(None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    scored = score(docs, train(docs, some)).collect()
    assert len(scored) == len(odd_texts) + 1 and all(0 <= r["score"] <= 1 for r in scored)
    by_id = {r["doc_id"]: r["score"] for r in scored}
    assert by_id[0] == by_id[1] and by_id[4] == by_id[5]
    empty = docs.limit(0)
    assert score(empty, train(empty, none)).collect() == []


@pytest.mark.parametrize("train,label", [(quality.train_quality, "quality"), (toxicity.train_toxicity, "toxic")])
def test_training_rows_may_pass_the_result_limit(spark, monkeypatch, train, label):
    """Long labelled texts whose features together exceed spark.driver.maxResultSize are all trained on."""
    rng = np.random.default_rng(3)
    docs = frame(spark, [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 12_000)) for _ in range(24)]).repartition(24)
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], f"doc_id long, {label} int")
    got = []
    fit = lambda bags, y, **_: got.append((sum(b.nbytes for b in bags), len(y), y.tolist()))
    module = quality if label == "quality" else toxicity
    monkeypatch.setattr(module, "fit", fit)
    monkeypatch.setattr(toxicity, "calibrate", lambda model, bags, y, langs: got.append((sum(b.nbytes for b in bags), len(y), y.tolist())))
    monkeypatch.setattr(common, "SPOOL_BYTES", 1 << 17)
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    conf.set("spark.driver.maxResultSize", "1m")
    try:
        train(docs, labels)
    finally:
        conf.set("spark.driver.maxResultSize", before)
    held = docs.filter(common.fold("doc_id", 3 if label == "quality" else 5) == (1 if label == "quality" else 0)).count()
    assert sum(n for _, n, _ in got) == 24 - held and sum(size for size, _, _ in got) > 1 << 20


def test_keep_quality_returns_all_columns(spark, odd_texts):
    docs = clash(frame(spark, odd_texts))
    kept = quality.keep_quality(docs, quality.AttentionModel({}, 0.9))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert quality.keep_quality(docs, quality.AttentionModel({}, 0.1)).count() == 0


def toxic_rows(spark, n):
    """Documents whose label hangs on one of two words, by id; German ones by another."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    rows, marks = [], []
    for i in range(n):
        toxic, german = int(rng.random() < 0.3), i % 4 == 0
        text = [words[j] for j in rng.integers(0, 60, 12)]
        text.insert(int(rng.integers(0, 12)), ("Dreckskerl" if german else "bastard") if toxic else ("Nachbar" if german else "neighbour"))
        rows.append((i, " ".join(text), "de" if german else "en", "s", 0))
        marks.append((i, toxic))
    return spark.createDataFrame(rows, DOC), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_toxicity_trains_on_every_label(spark, monkeypatch):
    """Beyond the driver's bound all training documents are counted, in each epoch and in the thresholds."""
    docs, labels = toxic_rows(spark, 900)
    monkeypatch.setattr(toxicity, "LOCAL_DOCS", 50)
    monkeypatch.setattr(toxicity, "GROUP_DOCS", 200)
    seen, weights, cells = [], [], []
    initial, averaged, set_thresholds = toxicity.initial, toxicity.averaged, toxicity.set_thresholds
    monkeypatch.setattr(toxicity, "initial", lambda counts, pos, neg, rng: (seen.append((pos, neg, counts.copy())), initial(counts, pos, neg, rng))[1])
    monkeypatch.setattr(toxicity, "averaged", lambda p, blocks: (weights.append([n for b, n, *_ in blocks if b < 0]), averaged(p, blocks))[1])
    monkeypatch.setattr(toxicity, "set_thresholds", lambda model, logit, spread, pos, total, langs: (cells.append((pos.sum(), total.sum())), set_thresholds(model, logit, spread, pos, total, langs))[1])
    model = toxicity.train_toxicity(docs, labels)
    known = labels.filter(common.fold("doc_id", 5) != 0)
    n, toxic = known.count(), known.filter("toxic = 1").count()
    (pos, neg, counts), (late_toxic, late) = seen[0], cells[0]
    assert (pos + late_toxic, pos + neg + late) == (toxic, n) and 0.1 * n < late < 0.3 * n
    assert weights == [[pos + neg]] * 4
    bastard, neighbour = (int(toxicity.word_ids(pa.array([w]))[0][0, 0]) for w in ("bastard", "neighbour"))
    assert counts[0, bastard] == 0 and counts[1, neighbour] == 0 and counts[:, [bastard, neighbour]].sum() > 0.5 * n  # three of four are English, a fifth is set aside
    assert set(model.thresholds) == {"de", "en"}
    right = labels.join(toxicity.score_toxicity(docs, model), "doc_id").filter("(score >= 0.5) = (toxic = 1)").count()
    assert right > 0.97 * 900
    again = toxicity.train_toxicity(docs.repartition(7), labels)
    assert all(np.array_equal(model.p[k], again.p[k]) for k in model.p) and model.thresholds == again.thresholds


def test_toxicity_groups_train_as_long_as_the_driver(spark, monkeypatch):
    """Beyond the driver's bound a group goes through all its documents as often, by as small steps and at the same
    rates as ``fit``."""
    docs, labels = toxic_rows(spark, 300)
    asked, steps, trained_parts, descend = [], [], toxicity.trained_parts, toxicity.descend
    monkeypatch.setattr(toxicity, "LOCAL_DOCS", 50)
    monkeypatch.setattr(toxicity, "trained_parts", lambda model, weight, **how: (asked.append((model, weight, how)), trained_parts(model, weight, **how))[1])
    toxicity.train_toxicity(docs, labels)
    # what the executors were asked for, once more in this process
    monkeypatch.setattr(toxicity, "descend", lambda p, opt, rows, y, *other, rate, batch: (steps.append((len(rows), y.tolist(), rate, batch)), descend(p, opt, rows, y, *other, rate=rate, batch=batch))[1])
    bags = [np.frombuffer(x, np.uint32).reshape(-1, 3) for x in toxicity.word_blobs(pa.array(["a b c", "", "bastard d", "e"] * 40))]
    y = np.array([0, 0, 1, 0] * 40)
    group = pa.RecordBatch.from_pydict({"g": [1] * len(bags), "y": y.tolist(), "x": [x.tobytes() for x in bags]})
    for model, weight, how in asked:
        out = pa.Table.from_batches(list(trained_parts(model, weight, **how)(iter([group]))))
        assert set(out.column("n").to_pylist()) == {len(bags)}
    of_groups = steps.copy()
    steps.clear()
    toxicity.fit(bags, y)
    assert of_groups == steps and len(steps) == 10


def test_toxicity_step_moves_every_row(monkeypatch):
    """Rows that no document of a step holds move by their decay and moments; slices of rows and words change nothing."""
    rng = np.random.default_rng(6)
    rows = [rng.integers(1, 20, (n, 3)) for n in (5, 0, 9, 1, 14)]
    y = np.array([1, 0, 1, 0, 0], np.float32)
    seen = np.full((2, 1 << toxicity.BITS), toxicity.MIN_DOCS * (np.arange(1 << toxicity.BITS) < 30))
    start = toxicity.initial(seen, 2, 3, np.random.default_rng(1))

    def trained():
        p = dict(start)
        opt, order = toxicity.Adam(p), np.random.default_rng(2)
        for _ in range(3):
            toxicity.descend(p, opt, rows, y, np.ones(5, np.float32), order, rate=0.01, batch=5)
        return p

    whole = trained()
    row = start["E"][25].astype(np.float64)
    m, v = np.zeros(toxicity.WIDTH), np.zeros(toxicity.WIDTH)
    for step in (1, 2, 3):
        g = 2e-5 * row
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        row = row - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    assert np.allclose(whole["E"][25], row, atol=1e-5) and not np.allclose(start["E"][25], row, atol=1e-4)
    monkeypatch.setattr(toxicity, "STEP_ROWS", 7)
    monkeypatch.setattr(toxicity, "SLICE_WORDS", 4)
    again = trained()
    assert all(np.array_equal(whole[k], again[k]) for k in whole)


def test_toxicity_beyond_the_driver_with_odd_rows(spark, odd_texts, monkeypatch):
    monkeypatch.setattr(toxicity, "LOCAL_DOCS", 1)
    docs = frame(spark, odd_texts)
    for marks in ([(i, i % 2) for i in range(9)], [(i, 1) for i in range(9)], [(i, 0) for i in range(9)]):
        model = toxicity.train_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
        scores = [r["score"] for r in toxicity.score_toxicity(docs, model).collect()]
        assert len(scores) == len(odd_texts) and all(0 <= s <= 1 for s in scores)
        if len({y for _, y in marks}) == 1:
            assert set(scores) == {float(marks[0][1])}


def test_best_threshold_is_that_of_trying_all():
    rng = np.random.default_rng(2)
    for _ in range(30):
        score, y = rng.integers(0, 12, 40) / 4, rng.integers(0, 2, 40)
        cut = np.unique(score)
        cut = np.concatenate([[cut[0]], (cut[1:] + cut[:-1]) / 2])
        f1 = np.array([2 * (y[score >= t] == 1).sum() / max(1, (score >= t).sum() + (y == 1).sum()) for t in cut])
        good = np.flatnonzero(f1 >= f1.max() - 1e-12)
        assert toxicity.best_threshold(score, y, np.ones(40, int)) == cut[good[len(good) // 2]]
