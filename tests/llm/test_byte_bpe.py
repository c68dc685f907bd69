"""Byte-level BPE against the tokenizers library, and back."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillflow.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        out.append((doc_id, len(ids), *sha))
    return sorted(out, key=repr)


PARTS = ["a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "é", "中", "😀", "́", "1", "²", "!!",
         "<|endoftext|>", "<|end", "|>", "\x1c", "\x85", "\xa0", "　", "aaaaaaa", "\r\n",
         "\x00", "ing", "zz"]


def test_random_texts(spark, library):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices(PARTS, k=rng.randrange(60)))) for i in range(400)]
    rows += [(None, "no id"), (3, None), (3, ""), (3, ""), (4, "x" * 3000), (5, "ab" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, byte_bpe.digests(df, PATH).collect()), key=repr) == expected(library, rows)


def test_documents(spark, sf_dir, library):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(map(tuple, byte_bpe.digests(df, PATH).collect()), key=repr) == expected(library, rows)


def test_portions_do_not_matter(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PORTION_CHARS", 10)
    rows = [(i, f"some words {i} aaaa") for i in range(50)]
    texts = [t for _, t in rows]
    whole = byte_bpe.Codes(byte_bpe.vocabulary(PATH), texts)
    each = [byte_bpe.Codes(byte_bpe.vocabulary(PATH), [t]) for t in texts]
    for k, x in enumerate(each):
        assert [whole.ids[p] for p in whole.pieces[k]] == [x.ids[p] for p in x.pieces[0]]


def test_ids_and_back_with_clashing_columns(spark):
    rows = [(1, "Hello <|endoftext|> wörld", 9), (2, None, 8), (3, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = byte_bpe.encoded(df, PATH)
    assert out.columns == ["doc_id", "text", "ids", "_ids"]
    back = {r.doc_id: r.back for r in out.withColumn("back", byte_bpe.decoded(F.col("_ids"), PATH)).collect()}
    assert back == {1: rows[0][1], 2: "", 3: ""}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.digests(df, PATH).collect() == []
