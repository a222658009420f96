"""Language identification by nearest centroid.

A text becomes a vector of hashed letter n-grams (one to three letters, lower-cased; anything that is
no letter separates words): logarithmic counts times inverse document frequencies, normalised.
Document frequencies cover every training document; centroids are fitted on a bounded sample of them
(``SAMPLE`` expected per language, chosen by a hash of id and text, equal ones once): ``CENTROIDS`` per language by spherical
k-means. A text gets the language of the centroid with the largest cosine. It is rejected if that
cosine is below ``SLACK`` times the first percentile of the language's own training cosines; a text
with fewer than ``FULL`` different n-grams can't come as near, so its bound shrinks with their root.

Whole texts are scored. Null text, and text without a letter, is ``und`` with score 0 and rejected.
Without any training document every text is ``und``, and those with letters are not rejected. Repeated rows and ties: same text, same answer;
of equal cosines the first language in order wins. Columns of the input that bear the name of a
result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import batches_with, query, table, utf8_values

DIMENSIONS = 4096
SAMPLE = 600
CENTROIDS = 4
ROUNDS = 12
SLACK = 0.5
FULL = 200
UNKNOWN = "und"
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_LETTERS: list[np.ndarray] = []


def letter_codes() -> np.ndarray:
    """Code point -> lower-cased letter, or 0 if it is no letter."""
    if not _LETTERS:
        codes = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                codes[i] = ord(low) if len(low) == 1 else i
        _LETTERS.append(codes)
    return _LETTERS[0]


def counts(text: bytes) -> np.ndarray | None:
    """How often each hashed n-gram occurs; None without a letter."""
    total = None
    for at in range(0, len(text), 1 << 20):  # a long text a mebibyte at a time, cut before a blank
        total = _counts(text, at, total)
    return total


def _cut(text: bytes, at: int) -> int:
    """The first blank at or after ``at``, so that no letter run is cut."""
    if at <= 0 or at >= len(text):
        return max(0, min(at, len(text)))
    found = text.find(b" ", at)
    return len(text) if found < 0 else found


def _counts(text: bytes, at: int, total: np.ndarray | None) -> np.ndarray | None:
    part = text[_cut(text, at):_cut(text, at + (1 << 20))].decode()
    codes = letter_codes()[np.frombuffer(part.encode("utf-32-le"), np.uint32)]
    codes = np.concatenate([np.zeros(1, np.uint32), codes, np.zeros(1, np.uint32)])
    codes = codes[(codes != 0) | np.append(True, codes[:-1] != 0)]  # one separator between words
    if len(codes) < 2 or not codes.any():
        return total
    mixed = codes * _PRIMES[0]
    one = mixed[codes != 0]
    two = mixed[:-1] ^ (codes[1:] * _PRIMES[1])
    three = mixed[:-2] ^ (codes[1:-1] * _PRIMES[1]) ^ (codes[2:] * _PRIMES[2])
    three = three[codes[1:-1] != 0]
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    grams = np.concatenate([x * np.uint32(0x27D4EB2F) >> shift for x in (one, two, three)])
    found = np.bincount(grams, minlength=DIMENSIONS)
    return found if total is None else total + found


def vectors(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    v = np.log1p(np.stack(rows).astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    languages: list[str]
    centroids: np.ndarray  # one row per centroid
    owner: np.ndarray  # language of each centroid
    floor: np.ndarray  # rejection cosine of each language
    idf: np.ndarray

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float], list[bool]]:
        names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if not len(self.languages):
            return names, scores, [counts(t) is None for t in texts]
        for at in range(0, len(texts), 256):
            found = [(i, c) for i in range(at, min(at + 256, len(texts))) if (c := counts(texts[i])) is not None]
            if not found:
                continue
            near = vectors([c for _, c in found], self.idf) @ self.centroids.T
            best = near.argmax(1)
            for (i, c), b, s in zip(found, best.tolist(), near.max(1).tolist()):
                names[i] = self.languages[self.owner[b]]
                scores[i] = min(1.0, max(0.0, s))
                evidence = min(1.0, np.count_nonzero(c) / FULL) ** 0.5
                rejected[i] = bool(s < self.floor[self.owner[b]] * evidence)
        return names, scores, rejected


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from rows far from one another."""
    chosen = [int((x @ x.mean(0)).argmax())]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(1).argmin()))
    centres = x[chosen]
    for _ in range(ROUNDS):
        owner = (x @ centres.T).argmax(1)
        sums = np.stack([x[owner == j].sum(0) if (owner == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """From rows of ``doc_id, text, lang``. The driver gets one number per dimension, one count per
    language and the vectors of the sample."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")

    def frequencies(batches):
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for text in utf8_values(batch.column("text")):
                if (c := counts(text)) is not None:
                    total[:-1] += c > 0
                    total[-1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIMENSIONS + 1)), pa.array(total)], names=["gram", "n"])

    seen = np.zeros(DIMENSIONS + 1, np.float32)
    of_grams = rows.select("text").mapInArrow(frequencies, "gram bigint, n bigint")
    for gram, n in of_grams.groupBy("gram").agg(F.sum("n")).collect():
        seen[gram] = n
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1

    sizes = dict(rows.groupBy("lang").count().collect())
    languages = sorted(sizes)
    if not languages or not seen[-1]:
        return Model([], np.zeros((0, DIMENSIONS)), np.zeros(0, int), np.zeros(0), idf)
    share = F.create_map(*[F.lit(v) for n in languages for v in (n, min(1.0, sample / sizes[n]))])
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def gathered(batches):
        for batch in batches:
            texts, langs = utf8_values(batch.column("text")), batch.column("lang").to_pylist()
            found = [(g, c) for t, g in zip(texts, langs) if (c := counts(t)) is not None]
            if found:
                packed = [np.minimum(c, 65535).astype("<u2").tobytes() for _, c in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for g, _ in found]), pa.array(packed, pa.binary())], names=["lang", "v"])

    drawn = rows.select("doc_id", "text", "lang").where(place < share[F.col("lang")])
    got = drawn.select("text", "lang").mapInArrow(gathered, "lang string, v binary").distinct().collect()
    got.sort(key=lambda r: (r["lang"], bytes(r["v"])))  # the same model whatever the order of tasks
    centroids, owner, floor, learned = [], [], [], []
    for name in languages:
        own = [np.frombuffer(r["v"], "<u2") for r in got if r["lang"] == name]
        if not own:
            continue
        x = vectors(own, idf)
        c = _k_means(x, CENTROIDS)
        centroids.append(c)
        owner += [len(learned)] * len(c)
        floor.append(SLACK * float(np.quantile((x @ c.T).max(1), 0.01)))
        learned.append(name)
    return Model(learned, np.concatenate(centroids), np.array(owner), np.array(floor), idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of centroids and dimensions

    def work(texts: list[bytes]) -> dict[str, list]:
        names, scores, rejected = held.value.predict(texts)
        return {"lang_pred": names, "score": scores, "rejected": rejected}

    return batches_with(
        docs, "text", {"lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_()},
        {"lang_pred": "string", "score": "double", "rejected": "boolean"}, work,
    )


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 5 == 0


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )
