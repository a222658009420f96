from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ledgerloom.llm import sentencepiece_codec as sc


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sc.MODEL))


@pytest.fixture(scope="module")
def own():
    return sc.Codec(public_tokenizers.path(sc.MODEL))


def texts() -> list[str]:
    rng = random.Random(5)
    alphabets = ["ab ", "aeinst ", "abcdefghijklmnopqrstuvwxyz  .,\n\t", "éèêßüñ▁ ", "日本語テスト。", "<s>/[INST]0x",
                 "\U0001f600‍̀a \x00\r", "01289 ", "=-_#* "]
    made = ["", " ", "  ", "▁", " ▁ ", "\n", "a", " a", "</s>", "<0x0A>", "<unk>", "�", "a" * 5000, " " * 300,
            "ab" * 3000, "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(3000))]
    for _ in range(3000):
        alphabet = rng.choice(alphabets)
        made.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))))
    return made


def test_ids_and_texts_are_the_library_s(library, own):
    given = texts()
    packed = own.encode(given)
    told = library.encode(given, add_bos=True, add_eos=True)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == told
    assert own.decode(packed) == [library.decode(t) for t in told]


def test_any_ids_decode_as_in_the_library(library, own):
    rng = random.Random(7)
    lists = [[rng.randrange(32000) for _ in range(rng.randrange(12))] for _ in range(2000)]
    lists += [[rng.randrange(3, 259) for _ in range(rng.randrange(8))] for _ in range(2000)]
    lists += [[1], [1, 2], [2, 1, 29871], [29871, 29871], [259, 259], [1, 235, 306]]
    packed = [np.array(x, "<u4").tobytes() for x in lists]
    assert own.decode(packed) == [library.decode(x) for x in lists]


def test_null_empty_and_extra_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "two words", None)],
        "doc_id bigint, text string, n_tokens string",
    )
    got = sorted((str(r.doc_id), r.n_tokens, r.decoded) for r in sc.encode_and_decode(docs).collect())
    assert got == [("1", 2, ""), ("2", 2, ""), ("2", 2, ""), ("None", 4, "two words")]
    assert sc.encode_and_decode(docs.limit(0)).count() == 0


def test_query_equals_the_library(spark, small_folder, library):
    import hashlib

    got = {r.doc_id: r for r in sc.QUERIES["op1_sentencepiece"](spark, small_folder).collect()}
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").collect()
    assert len(docs) == len(got)
    for d in docs:
        ids = library.encode(d.text or "", add_bos=True, add_eos=True)
        row = got[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("text", [
    " " * 1_000_000, "the" * 300_000, "a" * 1_000_000, "ab" * 400_000, "=-" * 300_000, "-" * 500_000,
    "x" + " " * 500_001 + "the" + " " * 17, "\n" * 300_000, "日本語" * 100_000,
], ids=lambda t: repr(t[:3]))
def test_a_megabyte_of_one_word_takes_seconds(library, own, text):
    began = time.perf_counter()
    packed = own.encode([text])
    took = time.perf_counter() - began
    assert np.frombuffer(packed[0], "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert took < 20
    assert own.decode(packed) == [library.decode(np.frombuffer(packed[0], "<u4").tolist())]


def test_runs_of_any_length_are_the_library_s(library, own):
    given = [before + c * n + after for c in " -=*#.a\n" for n in range(1, 70) for before, after in (("", ""), ("x", "y"), ("the", "  the"), (" ", "="))]
    own.words.clear()
    told = library.encode(given, add_bos=True, add_eos=True)
    assert [np.frombuffer(p, "<u4").tolist() for p in own.encode(given)] == told

