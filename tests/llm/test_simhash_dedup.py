"""SimHash against a plain version that compares all pairs."""

from __future__ import annotations

import re

import pytest
import xxhash

from tillflow.llm import components, simhash_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] > group[j]:
                    group[i], changed = group[j], True
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return sorted(
        ((d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, group)), key=repr
    )


def ours(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, simhash_dedup.assigned(df).collect()), key=repr)


BASE = " ".join(f"word{i % 37}x{i * i % 101}" for i in range(300))
ROWS = [
    (7, BASE), (3, BASE.upper()), (9, BASE + " tail"), (4, BASE.replace("word5x25", "other", 1)),
    (1, None), (2, ""), (2, ""), (None, "one"), (5, "One"), (6, "one two"), (8, " \t\n"),
    (10, "a b c a b c a b c"), (11, "a b c"), (12, "é È é x y z"), (None, "é lone"),
]


def test_small(spark):
    assert ours(spark, ROWS) == brute(ROWS)


def test_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = sorted(map(tuple, simhash_dedup.assigned(df).collect()), key=repr)
    assert got == brute(rows)


def test_empty(spark):
    assert ours(spark, []) == []


@pytest.mark.parametrize("chunk", [2, 7])
def test_hot_bucket_is_cut_without_losing_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash_dedup, "CHUNK", chunk)
    chain = [sum(1 << b for b in range(k)) for k in range(0, 60, 3)]
    prints = [x - (1 << 64) if x >> 63 else x for x in chain]
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    found = components.components(simhash_dedup.links(df)).collect()
    assert {r.node for r in found} == set(prints) and len({r.root for r in found}) == 1


def test_distinct_keeps_one_and_all_columns(spark):
    df = spark.createDataFrame(
        [(d, t, k) for k, (d, t) in enumerate(ROWS)], "doc_id long, text string, row_no int"
    )
    left = simhash_dedup.distinct(df)
    assert left.columns == df.columns
    groups = {(f, c) for _, f, c in brute(ROWS)}
    assert left.count() == len({c if c is not None else f for f, c in groups})


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
