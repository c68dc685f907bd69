"""Spelling variants against a plain comparison of all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tillflow.llm import spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def plain(counts):
    near = {w: [] for w in counts}
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def many_words():
    r = random.Random(3)
    counts = {}
    for _ in range(60):
        w = "".join(r.choice("abcdé") for _ in range(r.randrange(6, 12)))
        n = r.choice([5, 25, 30, 700, 20_000])
        for _ in range(12):
            counts[w] = max(5, n)
            k, c = r.randrange(len(w)), r.choice("abcdéz")
            w = r.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
            w = w if len(w) >= 6 else w + "aaaa"
            n = max(5, n // r.choice([1, 5, 6]))
    for k in range(6):  # ties, repeated letters, a chain, words beyond LONG
        counts["a" * (6 + k)] = 5 ** (k + 1)
        counts["b" * 40 + "xyz"[k % 3] + "c" * k] = 7
    counts["a" * 3000], counts["a" * 3001], counts["a" * 1500 + "b" + "a" * 1499] = 5, 25, 25
    return counts


@pytest.mark.parametrize("bits, most", [(14, 32 << 20), (1, 32 << 20), (14, 64)])
def test_groups_equal_a_plain_comparison(spark, monkeypatch, bits, most):
    monkeypatch.setattr(spelling_variants, "BITS_PER_WORD", bits)
    monkeypatch.setattr(spelling_variants, "MOST_BYTES", most)
    counts = many_words()
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    expected = plain(counts)
    assert rows_of(spelling_variants.grouped(words)) == expected
    assert max(len(r[0]) for r in expected if r[1]) == 3000 and sum(r[1] is not None for r in expected) > 50
    assert any(r[1] and r[2] != r[1] for r in expected)


def test_filters_are_bounded_and_selective(spark, monkeypatch):
    counts = many_words()
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    known = spelling_variants.filters(words)
    for length, rows in spelling_variants._by_length(list(counts)):
        own = [list(counts)[i] for i in rows.tolist()]
        hashes = spelling_variants._hashes(spelling_variants._points(own, length))
        assert known.hits(min(length, 32), hashes).all()
        assert known.hits(min(length, 32), hashes + 12345).mean() < 0.1 + 1 / len(own)
    monkeypatch.setattr(spelling_variants, "MOST_BYTES", 1024)
    small = spelling_variants.filters(words).blocks.values()
    assert sum(x.nbytes for x in small) <= 1024 + 64 * len(small)


def test_query_equals_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    expected = plain(plain_counts(rows))
    assert rows_of(spelling_variants.variants(docs)) == expected and len(expected) > 100
    assert any(r[4] for r in expected)


def test_odd_tables(spark):
    rows = [(1, None), (2, ""), (2, "12 34 -"), (None, "Straße STRASSE strasse " * 3), (3, "STRASSE " * 5)]
    rows += [(k, "École École École École ÉCOLES écoles ×÷×÷×÷ " * 4) for k in range(4, 30)] * 2
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    assert rows_of(spelling_variants.variants(df)) == plain(plain_counts(rows))
    assert spelling_variants.variants(df.limit(0)).collect() == []
    assert spelling_variants.variants(df.where("doc_id < 3")).collect() == []
