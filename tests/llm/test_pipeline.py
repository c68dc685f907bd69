"""The pipeline's stages, one after the other, against plain versions of each."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_rules_and_copies import LOWER, plain_judged
from test_simhash_dedup import brute as plain_prints
from tillflow.llm.common import documents


def test_each_stage_equals_a_plain_version(spark, sf_dir):
    docs = documents(spark, sf_dir)
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = sorted(texts)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name == "byte_bpe":
            break
        assert out.columns == docs.columns
        got = sorted(r.doc_id for r in out.collect())
        if name == "quality_rules":
            judged = plain_judged([(d, *texts[d]) for d in ids])
            expected = sorted(d for d, kept, *_ in judged if kept)
        elif name == "exact_dedup":
            last = {(texts[d][0] or "").translate(LOWER): d for d in ids}  # the largest doc_id
            expected = sorted(last.values())
        elif name == "simhash_dedup":
            expected = sorted({root for _, _, root in plain_prints([(d, texts[d][0]) for d in ids])})
        elif name == "mixing":
            clean = {d for d in ids if d in labels and labels[d].quality == 1 and labels[d].toxic == 0}
            assert clean <= set(got) < set(ids)
            expected = got
        assert got == expected, name
        docs, ids = out, got
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == ids
    for r in rows:
        code = library.encode(texts[r.doc_id][0] or "", add_special_tokens=False)
        assert list(r.ids) == code.ids and r.n_tokens == len(code.ids)
