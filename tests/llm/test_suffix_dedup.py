"""Repeated byte strings against a plain version that looks at every window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tillflow.llm import suffix_dedup


def brute(rows):
    raw = [(t or "").encode() for _, t in rows]
    n = suffix_dedup.LENGTH
    seen = Counter(x[i : i + n] for x in raw for i in range(len(x) - n + 1))
    out = []
    for (doc_id, _), x in zip(rows, raw):
        gone = bytearray(len(x))
        for i in range(len(x) - n + 1):
            if seen[x[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((doc_id, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest(), any(gone)))
    return sorted(out, key=repr)


def ours(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    return sorted(map(tuple, suffix_dedup.digests(df).collect()), key=repr)


def prose(rng, n):
    return "".join(rng.choice(["the ", "and ", "é", "ing", "x", "tion ", "\n", "日本"]) for _ in range(n))


def fixture():
    rng = random.Random(2)
    passages = [prose(rng, k) for k in (150, 180, 200, 300)]
    rows = []
    for i in range(40):
        parts = [prose(rng, rng.randrange(5, 200)) for _ in range(3)]
        for p in rng.sample(passages, rng.randrange(3)):
            cut = rng.randrange(0, 20)
            parts.insert(rng.randrange(3), p[cut : len(p) - rng.randrange(0, 20)])
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1][:-30] + "changed"), (102, None), (103, ""), (104, "short")]
    rows += [(105, "a" * 401), (106, "ab" * 500), (107, "b" * 400), (None, rows[5][1]), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("hot", [4000, 2])
def test_all_windows(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = fixture()
    assert ours(spark, rows) == brute(rows)


def test_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(map(tuple, suffix_dedup.digests(df).collect()), key=repr) == brute(rows)


def test_empty(spark):
    assert ours(spark, []) == []


def test_rows_keep_their_numbers_whatever_the_splits(spark, monkeypatch, tmp_path):
    """Scans are split anew after each stored step, as when executors come and go."""
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.repartition(12).write.parquet(str(tmp_path / "docs"))
    true, sizes, old = suffix_dedup.stored, iter("4k 512m 1k 64k 8k 2k 512m 1k".split()), "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(old)

    def stored(*args):
        out = true(*args)
        spark.conf.set(old, next(sizes))
        return out

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    try:
        docs = spark.read.parquet(str(tmp_path / "docs"))
        assert sorted(map(tuple, suffix_dedup.digests(docs).collect()), key=repr) == brute(rows)
    finally:
        spark.conf.set(old, before)


def test_clashing_columns(spark):
    rows = [(1, "a" * 500, 7, 8), (2, None, 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_no int, spans int")
    assert sorted(map(tuple, suffix_dedup.digests(df).collect())) == brute([r[:2] for r in rows])


def test_parts_of_a_long_text_share_their_borders(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PLACE", 10)
    monkeypatch.setattr(suffix_dedup, "_LIMIT", 1 << 10)
    import numpy as np

    rng = random.Random(8)
    passage, long = prose(rng, 160), prose(rng, 900)
    for at in (100, 560, 624, 700, 1250):
        raw = (long[:at] + passage + long[at:]).encode()
        first, count, anchor, _ = suffix_dedup._anchored(raw)
        starts = np.concatenate([np.arange(a, a + n) for a, n in zip(first, count)])
        assert sorted(set(starts.tolist())) == list(range(len(raw) - 400 + 1))
        for a, n, p in zip(first.tolist(), count.tolist(), anchor.tolist()):
            assert a + n - 1 <= p <= a + 400 - suffix_dedup.GRAM


def test_texts_are_stored_packed_and_steps_deleted(spark, sf_dir, monkeypatch, tmp_path):
    """What a run leaves on disk until its result is read: packed texts and spans."""
    from tillflow.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    result = suffix_dedup.digests(docs)
    left = {p.name: sum(f.stat().st_size for f in p.glob("*.parquet")) for p in tmp_path.iterdir()}
    raw = sum(len((r.text or "").encode()) for r in docs.select("text").collect())
    assert set(left) == {"suffix-rows", "suffix-spans"}
    assert left["suffix-rows"] < 0.55 * raw
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, result.collect()), key=repr) == brute(rows)


def test_spans_of_plain_rows(spark):
    rows = [(0, "xy" + "é" * 210), (1, "é" * 200 + "z"), (2, "")]
    found = suffix_dedup.spans(spark.createDataFrame(rows, "row_no long, text string"))
    gone = {(r.row_no, k) for r in found.collect() for k in range(r.start, r.stop)}
    assert gone == {(0, k) for k in range(2, 422)} | {(1, k) for k in range(400)}


def test_only_runs_asked_for_need_all_their_marks():
    import numpy as np

    rng = random.Random(4)
    for _ in range(20):
        texts = [prose(rng, 300).encode()[:768] for _ in range(3)]
        pieces, places, starts = [], [], []
        for _ in range(12):
            a = rng.randrange(369)
            n = rng.randrange(1, 370 - a)
            x = bytearray(texts[rng.randrange(3)])
            x[368:400] = texts[0][368:400]  # the anchor's gram
            if rng.random() < 0.5:
                x[rng.randrange(368)] ^= 1
            pieces.append(bytes(x[a : a + n - 1 + 400]))
            places.append(368 - a)
            starts.append(n)
        places, starts = np.array(places), np.array(starts)
        windows = [{(k - p + 368, x[k : k + 400]) for k in range(n)} for x, p, n in zip(pieces, places, starts)]
        seen = Counter(w for x in windows for w in x)
        want = np.zeros((12, 369), bool)
        for i, x in enumerate(windows):
            for at, text in x:
                want[i, at] = seen[at, text] > 1
        asked = np.array([rng.random() < 0.5 for _ in pieces])
        assert (suffix_dedup.repeated_starts(pieces, places, starts) == want).all()
        got = suffix_dedup.repeated_starts(pieces, places, starts, asked)
        assert (got[asked] == want[asked]).all() and not (got & ~want).any()
