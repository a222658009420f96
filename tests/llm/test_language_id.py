from __future__ import annotations

import zlib

import numpy as np

from ledgerloom.llm import language_id as li
from ledgerloom.llm.common import QUERIES


def trained(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return li.fit(docs.where(~li.held_out()).select("doc_id", "text", "lang"))


def test_held_out_accuracy_and_split(spark, small_folder):
    lang = {d.doc_id: d.lang for d in spark.read.parquet(f"{small_folder}/documents.parquet").collect()}
    got = QUERIES["op7_language_id"](spark, small_folder).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_one_document_at_a_time_gives_the_same(spark, small_folder):
    model = trained(spark, small_folder)
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, small_folder).collect()}
    for d in spark.read.parquet(f"{small_folder}/documents.parquet").limit(40).collect():
        names, scores, rejected = model.predict([d.text.encode()])
        r = got[d.doc_id]
        assert (r.lang_pred, r.rejected) == (names[0], rejected[0])
        assert abs(r.score - scores[0]) < 1e-5


def test_hard_texts(spark, small_folder):
    model = trained(spark, small_folder)
    names, scores, rejected = model.predict([b"", b" 12 !\n", "漢字".encode() * 500, b"the"])
    assert names[:2] == ["und", "und"] and scores[:2] == [0.0, 0.0] and rejected == [True, True, True, False]
    assert set(names) <= {"und", "en", "de", "fr", "es"}


def test_counts_of_a_long_text_are_those_of_its_words():
    text = ("Grüße aus 3 Wäldern " * 120_000).encode()
    assert len(text) > 1 << 20
    words, total = text.split(), li.counts(text)
    once = li.counts(b" ".join(words[:4]))
    assert np.array_equal(total, once * 120_000)


def test_null_rows_and_no_training_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", 0.5), (2, "", None, 0.1), (None, "words here", None, 0.2)],
        "doc_id bigint, text string, lang string, score double",
    )
    model = li.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in li.identify(docs, model).collect()}
    assert got == {1: ("und", 0.0, True), 2: ("und", 0.0, True), None: ("und", 0.0, False)}
    assert li.identify(docs.limit(0), model).columns == ["doc_id", "text", "lang"] + ["lang_pred", "score", "rejected"]
