"""Toxicity, mixing and language: held-out accuracy, fitted totals, odd rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillflow.llm import lang_gru, linear, mixing, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def _plain_features(text):
    """Counts of buckets, and words, one word after the other."""
    raw = (text or "").encode()
    runs = [x[:5] for x in raw.translate(bytes(linear._LETTER)).split(b"\0") if x]
    words = [x for x in re.split(rb"[\x20\x09-\x0D]+", raw) if x]
    keys = [int.from_bytes(x, "little") for x in runs]
    keys += [w[-1] | (w[-2] if len(w) > 1 else 0) << 8 | 1 << 40 for w in words]
    return Counter(k * int(linear._SPREAD) % 2**64 >> 64 - linear.BITS for k in keys), len(words)


@pytest.mark.parametrize("portion", [1, 40, 1 << 20])
def test_features_equal_a_plain_count(monkeypatch, portion):
    monkeypatch.setattr(linear, "PORTION_BYTES", portion)
    texts = ["The cat, the CAT; don't!", None, "", "  \n", "É!", "naïve «q» longerwords longerword", "a\tb" * 50]
    row, at, count, words = linear.features(pa.array(texts))
    for k, text in enumerate(texts):
        here = row == k
        assert (dict(zip(at[here].tolist(), count[here].tolist())), words[k]) == _plain_features(text)
    assert [len(x) for x in linear.features(pa.array([], pa.string()))] == [0] * 4


def _whole(text):
    row, at, count, _ = linear.features(pa.array([text]), whole=True)
    return dict(zip(at.tolist(), count.tolist()))


def test_all_bytes_of_a_run_are_seen():
    assert _whole("worth") != _whole("worthless") != _whole("worthwhile") and _whole("cat one") == _whole("CAT ONE")
    assert _whole("ÉTÉ ДОБРОЕ") == _whole("été доброе")
    plain = "这是一个很长的句子没有空格也没有标点符号" * 3
    inside = plain[:20] + "恶毒的话" + plain[20:]
    assert set(_whole("恶毒的话")) & set(_whole(inside)) - set(_whole(plain))
    for k in range(len(plain)):
        assert _whole(plain[:k] + "恶" + plain[k + 1 :]) != _whole(plain)


@pytest.mark.parametrize("portion", [1, 40, 1 << 20])
def test_whole_features_do_not_depend_on_portions(monkeypatch, portion):
    texts = ["longerwords longerword", None, "", "доброе утро", "这是一个很长的句子", "x", "naïve Überraschung " * 9]
    want = [_whole(t) for t in texts]
    monkeypatch.setattr(linear, "PORTION_BYTES", portion)
    row, at, count, _ = linear.features(pa.array(texts), whole=True)
    assert [dict(zip(at[row == k].tolist(), count[row == k].tolist())) for k in range(len(texts))] == want
    grams = linear.features(pa.array(["abcdefg"]), whole=True)[2].sum()
    assert grams == 1 + 1 + 1 + 5  # start, end, whole run, grams


def test_toxicity_on_held_out_rows(spark):
    """Over 4,000 labelled rows; sf0.01 has some 240, too few to learn from."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where("doc_id % 4 = 0")
    scored = toxicity.scored(docs.join(labels, "doc_id", "left_semi"), labels.where("doc_id % 4 != 0"))
    rows = scored.withColumnRenamed("toxic", "found").join(held, "doc_id").collect()
    found = {(r.found, bool(r.toxic)): 0 for r in rows}
    for r in rows:
        found[r.found, bool(r.toxic)] += 1
    assert found[True, True] >= 0.9 * (found[True, True] + found.get((False, True), 0))
    assert found.get((True, False), 0) <= 0.01 * len(rows)


def test_toxicity_odd_rows(spark, labels):
    df = spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "x")], "doc_id long, text string")
    out = toxicity.scored(df, labels.limit(0)).collect()
    assert len(out) == 4 and {(r.p_toxic, r.toxic) for r in out} == {(0.5, False)}
    assert toxicity.scored(df.limit(0), labels).collect() == []


def test_rates_meet_the_targets(docs, labels):
    out = mixing.assigned(docs, labels)
    share = out.agg(*[F.sum(F.expr(f"rate * n_tokens * p_{d}")) / F.sum("n_tokens") for d in mixing.DOMAINS]).first()
    assert np.allclose(share, [mixing.TARGETS[d] for d in mixing.DOMAINS], atol=0.005)
    assert out.where("rate < 0 OR abs(copies - rate) >= 1").isEmpty() and out.count() == docs.count()


def test_rates_equal_a_plain_solution(spark):
    rng = np.random.default_rng(1)
    p, n = rng.dirichlet([1, 1, 1], 40), rng.integers(1, 50, 40)
    rows = [(k, int(a), [float(y) for y in x]) for k, (a, x) in enumerate(zip(n, p))]
    df = spark.createDataFrame(rows, "k int, n_words long, p array<double>")
    got = np.array([r.rate for r in mixing.with_rates(df, mixing.TARGETS).orderBy("k").collect()])
    share, want = (n[:, None] * p).sum(0) / n.sum(), np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    r = np.ones(40)
    for _ in range(mixing.STEPS):
        miss = ((r * n) @ p / n.sum() - want) / share
        r = np.maximum(0, r - (p @ miss + mixing.PULL * (r - 1)) / (1 + mixing.PULL))
    assert np.allclose(got, r, atol=1e-3)


@pytest.mark.parametrize("soft", [(2, 1, 1), (8, 2, 1), (20, 5, 2)])
@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_are_settled(spark, soft, most):
    """The conditions of the optimum hold: each rate follows from the misses that all rates make."""
    rng = np.random.default_rng(3)
    p, n = rng.dirichlet(soft, 400), rng.integers(1, 50, 400)
    rows = [(k, int(a), [float(y) for y in x]) for k, (a, x) in enumerate(zip(n, p))]
    df = spark.createDataFrame(rows, "k int, n_words long, p array<double>")
    out = mixing.with_rates(df, mixing.TARGETS, most, None if most is None else "clean")
    got = np.array([r.rate for r in out.orderBy("k").collect()])
    share, want = (n[:, None] * p).sum(0) / n.sum(), np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    want = want if most is None else want * share[0] / want[0]
    miss = ((got * n) @ p / n.sum() - want) / share
    assert np.allclose(got, np.clip(1 - p @ miss / mixing.PULL, 0, most), atol=1e-3)


def test_rates_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 1)
    df = spark.createDataFrame([(5, [0.5, 0.3, 0.2]), (3, [0.2, 0.2, 0.6])], "n_words long, p array<double>")
    with pytest.raises(RuntimeError, match="not settled"):
        mixing.with_rates(df, mixing.TARGETS)


def test_mixed_keeps_columns_and_clean_documents(docs, labels):
    wide = docs.withColumn("rate", F.lit("own")).withColumn("p", F.lit(1))
    out = mixing.mixed(wide, labels)
    assert out.columns == wide.columns
    clean = labels.where("quality = 1 AND toxic = 0")
    assert out.join(clean, "doc_id").count() >= 0.98 * docs.join(clean, "doc_id").count()
    assert out.count() < docs.count() and mixing.mixed(docs.limit(0), labels).count() == 0


def test_mixed_keeps_every_clean_document(spark, docs, labels, monkeypatch):
    clean = labels.where("quality = 1 AND toxic = 0")
    assert mixing.mixed(docs, labels).join(clean, "doc_id").count() == docs.join(clean, "doc_id").count()
    p = {k: [0.76, 0.14, 0.10] if k < 870 else [0.2, 0.7, 0.1] if k < 970 else [0.1, 0.1, 0.8] for k in range(1000)}
    rows = [(k, f"text {k}", 50, x) for k, x in p.items()]
    soft = spark.createDataFrame(rows, "d0 int, d1 string, n_words long, p array<double>")
    monkeypatch.setattr(mixing, "posteriors", lambda *_: soft)
    known = spark.createDataFrame([(k, 1, 0) for k in range(990, 1000)], "doc_id int, quality int, toxic int")
    left = {r.doc_id for r in mixing.mixed(soft.selectExpr("d0 AS doc_id", "d1 AS text"), known).collect()}
    assert left >= {*range(870), *range(990, 1000)} and len(left) < 950


def test_language_on_held_out_rows(docs):
    rows = lang_gru.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_beyond_64_are_learned(spark, monkeypatch):
    """Languages of one letter each, the rarest with few rows."""
    monkeypatch.setattr(lang_gru, "train", lambda x, y, n: (n, sorted(set(y.tolist()))))
    rows = [(k * 100 + j, chr(0x4E00 + k) * 9, f"l{k}") for k in range(80) for j in range(6 if k == 79 else 9)]
    names, (n, learned) = lang_gru.fitted(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert set(names) == {f"l{k}" for k in range(80)} and n == 80 and learned == list(range(80))


def test_language_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !!", None), (3, "123 !!", None), (None, "some words", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [r.lang_pred for r in lang_gru.predicted(df).collect()] == ["und"] * 5
    assert lang_gru.predicted(df.limit(0)).collect() == []


def test_every_window_of_the_chosen_rows_can_be_drawn(spark, monkeypatch):
    text = "".join(chr(97 + k % 26) for k in range(64 * 50 + 7))
    known = spark.createDataFrame([("x", text, 1), ("x", "é", 2), ("y", text[:70], 3)], "lang string, text string, id long")
    counts = {"x": 2, "y": 1}
    rows = lang_gru.training_windows(known, counts).collect()
    whole = [text[k : k + 64].encode() for k in range(0, len(text), 64)]
    assert sorted(bytes(r.part) for r in rows if r.lang == "x") == sorted([*whole, "é".encode()])
    assert sorted(bytes(r.part) for r in rows if r.lang == "y") == sorted([text[:64].encode(), text[64:70].encode()])
    monkeypatch.setattr(lang_gru, "windows_per_lang", lambda n: 5)
    few = lang_gru.training_windows(known, counts).collect()
    assert sum(r.lang == "x" for r in few) == 5 and sum(r.lang == "y" for r in few) == 2
    assert {(r.lang, bytes(r.part)) for r in few} <= {(r.lang, bytes(r.part)) for r in rows}


def test_repeated_ids_keep_their_labels(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (2, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    data = linear.sample(docs, labels, F.array("toxic"), "doc_id", "text")
    assert sorted(data.labels[:, 0].tolist()) == [0, 1, 1]
    assert np.bincount(data.row, minlength=3).tolist() in ([0, 4, 4], [4, 0, 4], [4, 4, 0])


def test_gradients_match_differences():
    x, y = lang_gru.windows(b"hello world some bytes", 8), np.array([0, 1, 2])
    net = lang_gru.Network(4)

    def loss():
        p, there = net.labels(x), x.T != lang_gru.PAD
        return -(np.log(p[:, np.arange(3), y]) * there).sum() / there.sum()

    for param, grad, at in zip(net.params(), net.gradients(x, y), [(101, 20), (111, 3), (2, 9), (2, 18), (1, 1), (2,)]):
        old, step = param[at], 1e-2
        param[at] = old + step
        up = loss()
        param[at] = old - step
        assert (up - loss()) / (2 * step) == pytest.approx(grad[at], abs=2e-4)
        param[at] = old


def test_network_equals_a_plain_recurrence():
    """One state at a time, by loops over units."""
    import math

    net, size = lang_gru.Network(3, seed=5), lang_gru.HIDDEN
    raw = b"caf\xc3\xa9 und so"
    sigma = lambda v: 1 / (1 + math.exp(-v))

    def states(way):
        h, out = [0.0] * size, {}
        for t in range(len(raw) - 1, -1, -1) if way else range(len(raw)):
            gates = net.table[way][raw[t]].tolist()
            fed = [sum(h[i] * float(net.loop[way][i, j]) for i in range(size)) for j in range(3 * size)]
            z = [sigma(gates[j] + fed[j]) for j in range(size)]
            r = [sigma(gates[size + j] + fed[size + j]) for j in range(size)]
            new = [math.tanh(gates[2 * size + j] + r[j] * fed[2 * size + j]) for j in range(size)]
            h = [(1 - z[j]) * new[j] + z[j] * h[j] for j in range(size)]
            out[t] = h
        return out

    both, total = [states(0), states(1)], np.zeros(3)
    for t in range(len(raw)):
        score = [sum(h * float(net.head[j, k]) for j, h in enumerate(both[0][t] + both[1][t])) + float(net.base[k]) for k in range(3)]
        e = np.exp(np.array(score) - max(score))
        total += e / e.sum()
    assert np.allclose(lang_gru._pooled(net, [raw.decode()])[0], total / len(raw), atol=1e-5)


def test_chain_equals_a_plain_score(spark, labels):
    """Probabilities by loops over the features of each text, earlier odds fed to the later model."""
    import math

    texts = ["you are a nice person", "Worthless trash", "", None, "plain words here", "Ärger über straße"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = train.select("doc_id", "text").unionByName(docs.withColumn("doc_id", docs.doc_id - 100))
    known = toxicity.default_categories().values()
    data = linear.sample(both, labels, F.array(*[c.cast("int") for c in known]), "doc_id", "text")
    models = toxicity.chain(data)
    got = {r.doc_id: r for r in toxicity.scored(both, labels).where("doc_id < 0").collect()}
    for k, text in enumerate(texts):
        row, at, count, _ = linear.features(pa.array([text], pa.string()), whole=True)
        odds, p = [], 0.5
        for model in models:
            score = [float(c) + sum(o * float(model.dense[j, y]) for j, o in enumerate(odds)) for y, c in enumerate(model.constant)]
            for b, n in zip(at.tolist(), count.tolist()):
                where = np.flatnonzero(model.buckets == b)
                for y in (0, 1):
                    score[y] += sum(float(model.weights[w, y]) for w in where) * math.log1p(n)
            p = 1 / (1 + math.exp(score[0] - score[1]))
            odds.append(math.log(p / (1 - p)))
        assert got[k - 100].p_toxic == pytest.approx(p, abs=1e-9) and got[k - 100].toxic == (p > 0.5)


def test_clashing_columns_and_empty_tables(spark, docs, labels):
    wide = docs.limit(30).selectExpr("doc_id", "text", "lang", "1 AS label", "2 AS p", "3 AS n_words", "4 AS key", "5 AS score", "6 AS chosen")
    assert toxicity.scored(wide, labels).count() == 30
    assert mixing.assigned(wide, labels).count() == 30 and lang_gru.predicted(wide).count() == 30
    none = wide.limit(0)
    assert toxicity.scored(none, labels).count() == mixing.assigned(none, labels).count() == lang_gru.predicted(none).count() == 0


def test_a_very_long_text(spark):
    text = "the quick words and then " * 40_000 + "é"
    df = spark.createDataFrame([(k, text if k % 2 else "das ist der Text und " * 20, "en" if k % 2 else "de") for k in range(12)], "doc_id long, text string, lang string")
    got = lang_gru.predicted(df).collect()
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "de") for r in got)
