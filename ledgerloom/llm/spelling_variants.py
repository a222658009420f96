"""Grouping of spelling variants by PartEnum signatures over letter multisets.

1. Words are counted over all texts; tasks combine before the shuffle.
2. A word's letters, each with its number among equal letters, are a set, that is a binary vector. An inserted or
   deleted letter changes one of its places, a replaced one two at most: near words are within Hamming distance two.
3. PartEnum: the places are dealt by hash into ``BLOCKS`` blocks, two differences touch two of them at most, and every
   choice of the others is a signature: near words agree in one of them at least. A signature is joined with one half of
   the spelling, because one edit leaves the first or the last half as it is; so anagrams don't meet.
4. Words that share a signature are joined and verified by edit distance. Nothing is lost, by construction.

A word's form is its near word of largest count (ties: the first by code points), if that has ``TIMES`` its own count;
its root is found by following forms, in rounds that double the length of the path. Null and empty texts have no
words; texts and words may be of any length; equal rows count each; a null id counts as an empty one. An empty table
gives an empty result. Only the two named columns of the input are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import Scratch, query, stored, table

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
# Every DROP-th run of a document by its checksum loses one letter.
DROP = 31
BLOCKS, APART = 4, 2
_RUN = re.compile("[a-zÀ-ÿ]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def words_of(ident: object, text: str, drop: int = DROP) -> Counter:
    """Words of one document and how often each occurs."""
    runs = Counter(_RUN.findall(text.encode().lower().decode()))  # A-Z only
    before = zlib.crc32(f"{'' if ident is None else ident}:".encode())
    found: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), before)
        if h % drop == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        found[run] += n
    return found


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, drop: int = DROP) -> DataFrame:
    """``word, n``: how often each word occurs over all ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for ident, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text:
                    for word, n in words_of(ident, text, drop).items():
                        if len(word) >= least_length:
                            found[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def signatures(words: list[str]) -> np.ndarray:
    """A row of signatures for each word: one for each choice of blocks that two differences leave alone."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    letter = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((letter, owner))
    letter, owner = letter[order], owner[order]
    # The number of a letter among the equal ones of its word.
    fresh = np.ones(len(letter), bool)
    fresh[1:] = (letter[1:] != letter[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    number = np.arange(len(letter)) - np.repeat(first, np.diff(first, append=len(letter)))
    place = _mixed((letter << np.uint64(32) | number.astype(np.uint64)) * _ODD)
    # A block's part of a set is the sum of its places' hashes: equal sets, equal sums.
    sums = np.zeros((len(words), BLOCKS), np.uint64)
    np.add.at(sums, (owner, (place >> np.uint64(40)) % np.uint64(BLOCKS)), place)
    chosen = list(combinations(range(BLOCKS), BLOCKS - APART))
    made = np.empty((len(words), len(chosen)), np.uint64)
    for k, blocks in enumerate(chosen):
        key = np.full(len(words), k + 1, np.uint64)
        for b in blocks:
            key = _mixed(key * _ODD + sums[:, b])
        made[:, k] = key
    return made


def halves(word: str) -> list[int]:
    """Hashes of the halves that a near word shares: its first or last letters, by half of the longer one's length less one."""
    made = []
    for h in {(len(word) - 1) // 2, len(word) // 2}:  # this word is the longer one, or one letter shorter
        for side, part in ((0, word[:h]), (1, word[len(word) - h:])):
            made.append(xxhash.xxh64_intdigest(part.encode(), 2 * h + side))
    return made


def keyed(words: DataFrame) -> DataFrame:
    """``key, word``: every signature of a word with every half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            if not words:
                continue
            half = [halves(w) for w in words]
            size = np.fromiter(map(len, half), np.int64, len(half))
            side = np.fromiter((h for hs in half for h in hs), np.uint64, int(size.sum()))
            signs = signatures(words)
            owner = np.repeat(np.arange(len(words)), size)
            key = _mixed(side[:, None] * _ODD + signs[owner])
            # A word's equal keys stand for one.
            flat = np.unique(np.stack([np.repeat(owner, key.shape[1]).astype(np.uint64), key.ravel()], 1), axis=0)
            owner, key = flat[:, 0].astype(np.int64), np.ascontiguousarray(flat[:, 1]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("word").take(pa.array(owner))], names=["key", "word"])

    return words.select("word").mapInArrow(run, "key bigint, word string")


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``a, b`` with ``a < b``: words that differ by exactly one inserted, deleted or replaced code point."""
    rows = scratch.stored(keyed(words), "keys")
    left, right = rows.select("key", F.col("word").alias("a")), rows.select("key", F.col("word").alias("b"))
    near = F.expr("abs(char_length(a) - char_length(b)) <= 1 AND levenshtein(a, b, 1) = 1")
    return left.join(right, (left["key"] == right["key"]) & F.expr("a < b")).where(near).select("a", "b").distinct()


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` for every ``word, form``: paths are doubled until none grows."""
    now = scratch.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = scratch.stored(
            now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("grown")),
            "roots",
        )
        if not now.where("grown").take(1):
            return now.drop("grown")


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES, drop: int = DROP,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of the vocabulary."""
    scratch = Scratch(docs.sparkSession, "variants")
    words = scratch.stored(vocabulary(docs, least_length, least_count, drop), "vocabulary")
    pairs = scratch.stored(near_pairs(words, scratch), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The largest count first, then the first word: one least value, combined before the shuffle.
    other = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    told = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("b").alias("near"))).alias("best"))
    told = scratch.stored(
        words.join(told, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.near", (-F.col("best.less")).alias("near_n"))
        .select("word", "n", "n_near", F.expr(f"CASE WHEN near_n >= {times} * n THEN near END AS form"),
                F.expr(f"CASE WHEN near_n >= {times} * n THEN near_n END AS form_n")),
        "forms",
    )
    found = roots(told.where("form IS NOT NULL"), scratch)
    result = stored(told.join(found, "word", "left").withColumn("root", F.coalesce("root", "word")), "variants-found")
    scratch.drop()
    return result


# The checksum's table from its rule; runs by document; near words by equal spellings with one letter left out.
SQL = f"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) r(i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zà-ÿÀ-ß]+')) AS run FROM documents
), own AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(b), 2),
      lambda i: 16 * instr('123456789ABCDEF', b[i]) + instr('123456789ABCDEF', b[i + 1]))),
    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]))) AS h
  FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS b FROM own), t
), kept AS (
  SELECT CASE WHEN h % {DROP} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM hashed
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), gap AS (
  SELECT word, 0 AS i, word AS less FROM v
  UNION ALL SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), near AS (
  SELECT DISTINCT a.word, b.word AS other FROM gap a JOIN gap b ON a.less = b.less AND a.word <> b.word
  WHERE a.i = b.i OR a.i = 0 OR b.i = 0
), best AS (
  SELECT near.word, count(*) AS n_near, min({{'less': -v.n, 'other': near.other}}) AS best
  FROM near JOIN v ON v.word = near.other GROUP BY near.word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.less >= {TIMES} * v.n THEN best.other END AS form, CASE WHEN -best.less >= {TIMES} * v.n THEN -best.less END AS form_n
  FROM v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, w.root
FROM forms f JOIN walk w ON f.word = w.word JOIN forms e ON w.root = e.word WHERE e.form IS NULL
"""


@query("op11_spelling_variants", SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return variants(table(spark, folder, "documents").select("doc_id", "text"))
