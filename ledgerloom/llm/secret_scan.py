r"""Secret scans: fixed patterns, and strings that a tokenizer finds hard to compress.

Three patterns give the base spans (``assign``, ``access``, ``hex``). The method adds ``random`` spans: runs of 20
or more key characters with a letter whose characters per token, under a public byte-pair
vocabulary, stay below ``MOST_PER_TOKEN`` (letters of one case alone: ``MOST_OF_ONE_CASE``). Words of any language, even invented ones, compress better. Known
digests (hexadecimal of a digest's length), UUIDs, dates and numbers with separators, and identifiers whose
words all compress are excluded, and so is what overlaps a base span. A run that isn't random as a whole is looked at between
its separators (``= / _ -``), so that neither a name nor a path around a secret hides it.

Offsets are code points, end exclusive. Whole texts are scanned; null text counts as empty. A run beyond
``PIECE`` characters is measured piece by piece, all of it. Equal texts give equal spans. Columns of the
input that bear the name of a result column are replaced.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import batches_with, query, table

VOCABULARY = "byte_bpe_50k.tiktoken"
MOST_PER_TOKEN = 1.9
MOST_OF_ONE_CASE = 1.8
PIECE = 4096
SHORTEST = 20
KINDS = ["assign", "access", "hex", "random"]
# The base patterns; the least length applies to the group.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
_WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "api_key", "apikey")
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # the matches of HEX that are long enough

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}(?![A-Za-z0-9+/=_-])")
_LETTER, _DIGIT, _ALNUM = re.compile("[A-Za-z]"), re.compile("[0-9]"), re.compile("[A-Za-z0-9]")
_DIGEST = re.compile(r"(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})")
_UUID = re.compile(r"(?i:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})")
# Possessive throughout: one way to match, so the time is linear.
_STAMP = re.compile(r"[0-9]++(?:[-_/T=][0-9]++)*+Z?")
# Inside a run: what stands between separators, words, and known things.
_BETWEEN, _WORD = re.compile("[A-Za-z0-9+]+"), re.compile("[A-Za-z]{3,}")
_UUID_INSIDE = re.compile(rf"(?<![A-Za-z0-9]){_UUID.pattern}(?![A-Za-z0-9])")
# A whole run of numbers and separators, whatever follows it: every later start would end in the same place.
_STAMP_RUN = re.compile(r"(?<![A-Za-z0-9])[0-9]++(?:[-_/T=][0-9]++)*+")
_NUMBER = re.compile("[0-9]+")
# Words of three letters and more, joined by one separator or by case, with short numbers at their ends.
_PART = r"(?:[A-Z]?[a-z]{3,}+|[A-Z]{3,}+)[0-9]{0,4}+"
_IDENTIFIER = re.compile(rf"{_PART}(?:{_PART}|[-_/=](?:{_PART}|v?[0-9]{{1,4}}+))*+")


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def per_token(text: str, vocabulary: tiktoken.Encoding) -> float:
    pieces = [text[i:i + PIECE] for i in range(0, len(text), PIECE)]
    return len(text) / sum(len(vocabulary.encode_ordinary(p)) for p in pieces)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS_OF_ASSIGN):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return found


def known(run: str, vocabulary: tiktoken.Encoding) -> bool:
    """Digests, numbers, and identifiers whose words all compress like words: no secrets by themselves."""
    if any(p.fullmatch(run) for p in (_DIGEST, _UUID, _STAMP)):
        return True
    return bool(_IDENTIFIER.fullmatch(run)) and all(
        per_token(w, vocabulary) >= MOST_PER_TOKEN for w in _WORD.findall(run)
    )


def random(run: str, vocabulary: tiktoken.Encoding) -> bool:
    if not _LETTER.search(run):
        return False
    # Letters of one case alone have to be harder to compress.
    plain = not _DIGIT.search(run) and (run.islower() or run.isupper())
    limit = MOST_OF_ONE_CASE if plain else MOST_PER_TOKEN
    return per_token(run, vocabulary) < limit and not known(run, vocabulary)


def stamps(run: str) -> list[tuple[int, int]]:
    """Dates and times inside a run: three numbers or more, with nothing but a Z glued to them."""
    found = []
    for m in _STAMP_RUN.finditer(run):
        end = m.end() + (run[m.end():m.end() + 1] == "Z")
        if not _ALNUM.match(run, end) and len(_NUMBER.findall(m[0])) > 2:
            found.append((m.start(), end))
    return found


def hidden(run: str, taken: list[tuple[int, int]], vocabulary: tiktoken.Encoding) -> list[tuple[int, int]]:
    """Random stretches of a run that isn't random as a whole, between separators.

    From each part, the fewest parts that make up ``SHORTEST`` characters are judged on their own; hits that
    overlap are one. What begins or ends in a word, or touches ``taken``, a UUID, a date or a digest, isn't tried.
    """
    barred = taken + [m.span() for m in _UUID_INSIDE.finditer(run)] + stamps(run)
    barred.sort()
    parts, closed, word, at = [], [], [], 0
    for m in _BETWEEN.finditer(run):
        while at < len(barred) and barred[at][1] <= m.start():
            at += 1
        parts.append(m.span())
        closed.append(any(True for _ in _begun(barred, at, m.end(), m.start())) or bool(_DIGEST.fullmatch(m[0])))
        word.append(bool(_WORD.fullmatch(m[0])) and per_token(m[0], vocabulary) >= MOST_PER_TOKEN)
    found: list[tuple[int, int]] = []
    for i, (start, _) in enumerate(parts):
        if closed[i] or word[i]:
            continue
        for j in range(i, len(parts)):
            if closed[j]:
                break
            end = parts[j][1]
            if end - start >= SHORTEST:
                if not word[j] and random(run[start:end], vocabulary):
                    if found and start <= found[-1][1]:
                        start = found.pop()[0]
                    found.append((start, end))
                break
    return found


def random_spans(text: str, base: list[tuple[str, int, int]], vocabulary: tiktoken.Encoding):
    taken = sorted((a, b) for _, a, b in base)
    at = 0
    for m in CANDIDATE.finditer(text):
        run, start = m[0], m.start()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        # Spans of different kinds may nest, so later ones are looked at too while they begin inside.
        over = [(a - start, b - start) for a, b in _begun(taken, at, m.end(), start)]
        if not over and random(run, vocabulary):
            yield ("random", *m.span())
        elif over or not known(run, vocabulary):
            for a, b in hidden(run, over, vocabulary):
                yield ("random", start + a, start + b)


def _begun(taken: list[tuple[int, int]], at: int, end: int, start: int):
    """Those of ``taken`` from ``at`` on that overlap ``start`` to ``end``."""
    while at < len(taken) and taken[at][0] < end:
        if taken[at][1] > start:
            yield taken[at]
        at += 1


def spans(text: str, vocabulary: tiktoken.Encoding) -> list[tuple[str, int, int]]:
    """All spans by start, then kind."""
    base = base_spans(text)
    return sorted([*base, *random_spans(text, base, vocabulary)], key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``kind, start, end``. ``vocabulary`` is a path that executors can open."""

    def work(texts: list[bytes]) -> dict[str, list]:
        v = encoding(vocabulary or public_tokenizers.path(VOCABULARY))
        return {"secrets": [
            [{"kind": k, "start": a, "end": b} for k, a, b in spans(t.decode(), v)] for t in texts
        ]}

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return batches_with(
        docs, "text", {"secrets": kind}, {"secrets": "array<struct<kind:string,start:bigint,end:bigint>>"}, work,
    )


def listed(secrets: Column) -> Column:
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op10_secret_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents").select("doc_id", "text"))
    secrets = F.col("secrets")
    of = lambda kind: F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(listed(F.filter(secrets, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        listed(secrets).alias("spans"),
    )
