"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tillflow.llm import periodic_runs


def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                part = w[i : i + length]
                if all(part[d:] != part[: length - d] for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    rest = b" ".join(x for i, x in enumerate(w) if i not in dropped)
    listed = "".join("%d,%d,%d\n" % r for r in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def shapes():
    r = random.Random(5)
    for k in range(250):
        letters = r.choice([1, 2, 2, 3, 5])
        yield [r.randrange(letters) for _ in range(r.randrange(0, 140))]
    for k in range(250):  # repeated blocks, blocks of blocks, edges that agree for a while
        out = []
        for _ in range(r.randrange(1, 4)):
            block = [r.randrange(3) for _ in range(r.randrange(1, 60))]
            if r.random() < 0.3:
                block = block[: r.randrange(1, 9)] * r.randrange(1, 9) + block
            out += block * r.randrange(1, 7) + block[: r.randrange(0, len(block) + 1)]
        yield out
    a, b = [0] * 20 + [1], [0] * 30 + [1]
    yield (a + b) * 4  # neighbouring occurrences of 16 words are never a period apart


def test_runs_equal_a_plain_search():
    for ids in shapes():
        assert periodic_runs.runs_of(np.array(ids, np.int64)) == plain_runs(ids), ids


def test_long_texts_stay_linear():
    same = np.zeros(300_000, np.int64)
    assert periodic_runs.runs_of(same) == [(0, 300_000, 1)]
    r = np.random.default_rng(1)
    block = r.integers(0, 1000, 50_000)
    ids = np.concatenate([r.integers(0, 50, 1000) + 5000, np.tile(block, 5), block[:77], [9999]])
    assert periodic_runs.runs_of(ids) == [(1000, 250_077, 50_000)]
    license_text = r.integers(0, 90, 40)
    gaps = [np.concatenate([license_text, 100 + r.integers(0, 9000, r.integers(1, 9))]) for _ in range(5000)]
    assert periodic_runs.runs_of(np.concatenate(gaps)) == []


def test_query_equals_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    own = {r.doc_id: r.text for r in docs.collect() if len((r.text or "").split()) < 1200}
    docs = docs.where(docs.doc_id.isin(list(own)))
    got = sorted(map(tuple, periodic_runs.digests(docs).collect()))
    assert got == sorted(plain_row(*x) for x in own.items())
    assert sum(r[1] > 0 for r in got) > len(own) // 20


ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (None, "a " * 40), (5, "x y " * 30), (5, "x y " * 30),
    (6, "é b c\x0bd " * 12), (7, "w"), (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, r[0]) for r in ROWS], "doc_id long, text string, n_runs long")
    got = sorted(map(tuple, periodic_runs.digests(df).collect()), key=repr)
    assert got == sorted((plain_row(*r) for r in ROWS), key=repr)
    assert periodic_runs.digests(df.limit(0)).collect() == []
    assert "n_runs" in periodic_runs.digests(df.limit(0)).columns


def test_outputs(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, runs int")
    out = periodic_runs.detected(df)
    assert out.columns == ["doc_id", "text", "runs", "_runs"]
    for r in out.collect():
        assert [tuple(x) for x in r._runs] == plain_runs((r.text or "").encode().split())
    texts = {(r.doc_id, r.text) for r in periodic_runs.collapsed(df).collect()}
    assert (None, "a") in texts and (5, "x y") in texts and (1, None) in texts and (3, " \t\n") in texts


@pytest.mark.parametrize("q", [1, 8, 9, 15, 16, 17, 31, 32, 33, 64])
def test_shortest_run_of_each_period(q):
    block = list(range(q))
    need = max(24, 3 * q)
    ids = [1000] + (block * need)[:need] + [1001]
    assert periodic_runs.runs_of(np.array(ids)) == [(1, need, q)]
    assert periodic_runs.runs_of(np.array(ids[:-2] + [1001])) == []
