"""The whole pipeline against a brute-force version over the same decisions, one document at a time."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from ledgerloom.llm import language_id, sentencepiece_codec
from test_mixing import plain_mix
from test_ngram_join import plain_groups


@pytest.fixture(scope="module")
def result(spark, small_folder):
    return [r.asDict() for r in corpus_pipeline.run(spark, small_folder).collect()]


def test_run_equals_brute_force(spark, small_folder, result):
    docs = [r.asDict() for r in spark.read.parquet(f"{small_folder}/documents.parquet").collect()]
    model = language_id.fit(spark.read.parquet(f"{small_folder}/documents.parquet").select("doc_id", "text", "lang"))
    rejected = model.predict([(d["text"] or "").encode() for d in docs])[2]
    docs = [d for d, gone in zip(docs, rejected) if not gone]

    by_text: dict[bytes, dict] = {}
    for d in docs:
        key = (d["text"] or "").encode().lower()
        if key not in by_text or d["doc_id"] > by_text[key]["doc_id"]:
            by_text[key] = d
    docs = list(by_text.values())

    stays = {c for _, _, c in plain_groups([(d["doc_id"], d["text"]) for d in docs])}
    docs = [d for d in docs if d["doc_id"] in stays]

    copies = plain_mix([(d["doc_id"], d["source"], d["text"]) for d in docs])
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_codec.MODEL))
    told = defaultdict(int)
    for d in docs:
        ids = library.encode(d["text"] or "", add_bos=True, add_eos=True)
        packed = np.array(ids, "<u4").tobytes()
        told[(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"], packed, len(ids), library.decode(ids))] += copies[d["doc_id"]]
    got = defaultdict(int)
    for r in result:
        got[(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], bytes(r["token_ids"]), r["n_tokens"], r["decoded"])] += 1
    assert got == {k: n for k, n in told.items() if n}


def test_stages_return_the_columns_of_documents(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small_folder).columns == docs.columns
        assert stage(spark, docs.limit(0), small_folder).count() == 0
