"""Quality rules and exact dedup against plain versions, and the stages of the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from tillflow.llm import exact_dedup, quality_rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PROSE = " ".join(f"the word{i % 50} of x{i} and" for i in range(60))
ROWS = [
    (1, None, "en"), (2, "", None), (2, "", None), (None, "a b c a b c a b c", "en"), (4, PROSE, "en"),
    (5, "Line one\nline two\nLine one\n\n \n\nLine one", "de"), (6, "#$ %&|<> **\t é x", "fr"),
    (7, ("w " * 200).strip(), "en"), (8, PROSE.upper(), "en"), (9, "%%% &&& " + "!!X$$$ " * 90, "en"),
    (4, PROSE, "en"),
]


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    again = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed)


def test_base_figures(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = ROWS + [(r.doc_id + 1000, r.text, r.lang) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality_rules.judged(df, ["doc_id"]).collect()
    assert sorted(((r[0], *r[1:7]) for r in got), key=repr) == sorted(((d, *base(t)) for d, t, _ in rows), key=repr)
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_odd_tables(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, lang string, kept int")
    out = quality_rules.accepted(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} <= {4, 8, 9}
    assert quality_rules.judged(df.limit(0), ["doc_id"]).collect() == []


def test_copies(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    sha = lambda t: hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()
    groups = Counter(sha(t) for _, t, _ in ROWS)
    keep = {}
    for d, t, _ in ROWS:
        keep[sha(t)] = max(keep.get(sha(t), -1), -1 if d is None else d)
    got = exact_dedup.assigned(df).collect()
    assert sorted((r.text_sha256, r.group_size) for r in got) == sorted((sha(t), groups[sha(t)]) for _, t, _ in ROWS)
    assert all(r.keep_id == keep[r.text_sha256] for r in got if keep[r.text_sha256] >= 0)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(groups.keys())
    wide = df.withColumn("digest", df.doc_id)
    assert exact_dedup.distinct(wide).count() == len(groups) and exact_dedup.distinct(wide).columns == wide.columns
    assert exact_dedup.assigned(df.limit(0)).collect() == []


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns and 0 < docs.count() <= rows, name
        rows = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == rows and last.where("n_tokens != size(ids)").isEmpty()


def plain_judged(rows):
    """The verdict of each row: distances to the means of its language, by plain loops."""
    import math
    import regex

    outside = [r"[\p{Lu}\p{Lt}]", r"\p{Nd}", r"[.,;:'\"()\-–—’“”„«»¿¡]"]
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    words = {}
    for _, text, lang in rows:
        words.setdefault(lang or "", Counter()).update(w for w in split((text or "").lower()) if regex.search(r"\p{L}", w))
    top = {k: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: quality_rules.COMMON]] for k, c in words.items()}
    figures = []
    for _, text, lang in rows:
        text = text or ""
        left = re.sub("[a-z ]+", "", text)
        counts = [len(regex.findall(p, left)) for p in outside]
        counts.append(len(regex.findall(r"[^\p{L}\p{M}\p{Nd}\s.,;:'\"()\-–—’“”„«»¿¡]", left)))
        w = split(text)
        spaces = len(text) - sum(map(len, w))
        classes = [*counts, spaces, len(text) - spaces - sum(counts)]
        own = Counter(x.lower() for x in w)
        common = [own[x] for x in top[lang or ""]]
        common += [0] * (quality_rules.COMMON - len(common)) + [len(w) - sum(common)]
        figures.append((base(text)[-1], len(text), len(w), classes, common))
    share = lambda x: [v / sum(x) for v in x]
    means = {}
    for lang in {r[2] or "" for r in rows}:
        good = [f for f, r in zip(figures, rows) if (r[2] or "") == lang and not f[0]]
        if good:
            means[lang] = [[sum(c) / len(good) for c in zip(*(share(f[k]) for f in good))] for k in (3, 4)]

    def distance(p, q):
        part = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x > 0)
        return math.sqrt(max(0.0, (part(p, q) + part(q, p)) / 2))

    out = []
    for f, (doc_id, _, lang) in zip(figures, rows):
        ref = means.get(lang or "")
        by_class = distance(share(f[3]), ref[0]) if ref and f[1] >= 300 else None
        by_word = distance(share(f[4]), ref[1]) if ref and f[2] >= 120 else None
        far = (by_class or 0) > 0.25 or (by_word or 0) > 0.32
        out.append((doc_id, not f[0] and not far, by_class, by_word))
    return out


def test_verdicts_equal_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = ROWS + [(r.doc_id + 1000, r.text, r.lang) for r in docs.collect()]
    rows.append((9000, "zz qq " * 100 + " ".join(f"y{k}" for k in range(200)), "en"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(((r.doc_id, r.kept, r.class_distance, r.word_distance) for r in quality_rules.judged(df, ["doc_id"]).collect()), key=repr)
    want = sorted(plain_judged(rows), key=repr)
    near = lambda a, b: (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
    key = lambda r: (repr(r[0]), r[1], round(r[2] or 0, 6), round(r[3] or 0, 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and near(a[2], b[2]) and near(a[3], b[3]), (a, b)
    assert any(not k and w is not None and w > 0.32 for _, k, _, w in got)


def test_words_come_from_every_language(spark):
    """A language that no list knows has common words of its own, and word salad in it is rejected."""
    rng, known = random.Random(6), "się nie na to jest w że do".split()
    draw = lambda: rng.choice(known) if rng.random() < 0.6 else f"słowo{rng.randrange(900)}"
    rows = [(k, " ".join(draw() for _ in range(300)), "pl") for k in range(40)]
    rows.append((99, " ".join(f"xq{k % 97} zr{k % 89}" for k in range(400)), "pl"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (top,) = quality_rules.common_words(df).collect()
    assert set(top.common[:8]) == set(known)
    found = {r.doc_id: r for r in quality_rules.judged(df, ["doc_id"]).collect()}
    assert found[99].word_distance > 0.5 and not found[99].kept
    assert max(found[k].word_distance for k in range(40)) < 0.32
