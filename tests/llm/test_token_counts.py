"""Token counts against the tokenizers library on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillflow.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > 2048))
    return sorted(out, key=repr)


def ours(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, token_counts.counted(df, PATH).collect()), key=repr)


PARTS = ["a", "The", " ", "  ", "\n", "it's", "'ll", "é", "É", "中", "😀", "1", "23", "!!",
         "<|endoftext|>", "<|startof", "text|>", "\x85", "\xa0", "İ", "Σ", "longerword"]


def test_chunks_of_any_text(spark, library, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", 60)
    monkeypatch.setattr(token_counts, "OVERLAP_CHARS", 6)
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices(PARTS, k=rng.randrange(1, 150)))) for i in range(120)]
    rows += [(500, "x" * 900), (501, "no space " + "y1" * 200), (None, " " * 300), (3, None), (3, ""), (3, "")]
    assert ours(spark, rows) == expected(library, rows)


def test_documents(spark, sf_dir, library):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    rows.append((-1, " ".join(t or "" for _, t in rows)))
    assert ours(spark, rows) == expected(library, rows)


def test_empty(spark):
    assert ours(spark, []) == []


@pytest.mark.parametrize("most", [200_000, 5])
def test_words_of_any_text(spark, library, monkeypatch, most):
    monkeypatch.setattr(token_counts, "MOST_WORDS", most)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 300)
    rng = random.Random(10)
    parts = [*PARTS, "\x0b", "\x0c", "\r\n", "\x1c", "\x00", "́", " ", "　", "ﬁ", "<|startoftext|>"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(1, 80)))) for i in range(400)]
    assert ours(spark, rows) == expected(library, rows)


def test_a_clashing_column_and_another_tokenizer(spark, library):
    rows = [(1, "some Words here"), (2, None)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_tokens int")
    assert sorted(map(tuple, token_counts.counted(df, PATH).collect())) == expected(library, rows)
    with pytest.raises(ValueError, match="white space"):
        token_counts._tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
