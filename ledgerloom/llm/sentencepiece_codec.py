"""SentencePiece encoding and decoding by vectorised merge rounds.

Texts split into words where no piece of the vocabulary can span: first before a blank that follows
another character, then, for words not met before, between characters that no piece holds side by
side. All new words of a batch are merged together: one flat array of symbols, the rank of each
neighbouring pair, the smallest rank per word by a segmented minimum, all leftmost pairs of that rank
merged at once, arrays compacted; until no pair remains. A pair is merged alone if its
result could form a better pair with a neighbour, so that the order of merges is that of the
library. Symbols outside the vocabulary become bytes. Decoding gathers the bytes of all ids at once.

The model must be BPE with byte fallback, identity normalisation, a dummy prefix and white space
kept; others are refused. Null text counts as empty; empty text gives the begin and end ids alone.
Words are remembered between batches up to ``REMEMBERED`` of them, which bounds a worker's memory.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import QUERIES, batches_with, query, table

__all__ = ["QUERIES", "Codec", "codec", "encode_and_decode"]

MODEL = "piece_bpe_32k.model"
REMEMBERED = 200_000
BLOCK = 1 << 19
BLANK = "▁"
_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NO_RANK = np.int32(2**31 - 1)
# Pieces of one symbol alone are no longer than this, or their runs are merged as any text.
_LONGEST_RUN = 64
# Above the code points; a pair of symbols is one 64-bit key.
_SHIFT = 22


def _each_bad_byte(error: UnicodeDecodeError):
    return "�", error.start + 1


codecs.register_error("each-bad-byte", _each_bad_byte)


@dataclass(frozen=True)
class Run:
    """What a run of one symbol becomes if all its pairs have the same rank.

    The leftmost pair is merged until the piece at the left is ``longest``, with which no pair begins; then the rest is a
    run of its own. Shorter than twice that, ``ends`` says what becomes of it: places and pieces.
    """

    reached: list[int]
    longest: int
    width: int
    ends: list[tuple[list[int], list[int]]]

    @staticmethod
    def merged(one: int, count: int, pairs: dict[tuple[int, int], int]) -> tuple[list[int], list[int]]:
        symbols, places = [one] * count, list(range(count))
        while True:
            hit = next((i for i in range(len(symbols) - 1) if (symbols[i], symbols[i + 1]) in pairs), None)
            if hit is None:
                return places, symbols
            symbols[hit:hit + 2] = [pairs[symbols[hit], symbols[hit + 1]]]
            del places[hit + 1]

    @classmethod
    def of(cls, one: int, reached: list[int], pairs: dict[tuple[int, int], int]) -> "Run | None":
        places, symbols = cls.merged(one, 4 * _LONGEST_RUN, pairs)
        longest = symbols[0]
        if len(places) < 4 or any((longest, x) in pairs for x in reached):
            return None
        return cls(reached, longest, places[1], [cls.merged(one, n, pairs) for n in range(2 * places[1])])

    def filled(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        whole = max(0, count // self.width - 1)
        places, symbols = self.ends[count - whole * self.width]
        return (np.concatenate([np.arange(whole) * self.width, np.array(places, np.int64) + whole * self.width]).astype(np.int64),
                np.array([self.longest] * whole + symbols, np.int64))


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if (
            model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback
            or norm.precompiled_charsmap or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
            or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        ):
            raise ValueError(f"{path}: not a byte-fallback BPE model without normalisation")
        self.size = len(model.pieces)
        if self.size + 0x110000 >= 1 << _SHIFT:
            raise ValueError(f"{path}: vocabulary too large")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        if any(BLANK in p.lstrip(BLANK) for p in normal):
            raise ValueError(f"{path}: pieces span words")
        self.bos, self.eos = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.byte_ids = np.zeros(256, np.uint32)
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        self._merges(model, normal)
        self._decoding(model)
        self.words: dict[str, bytes] = {}

    def _merges(self, model, normal: dict[str, int]) -> None:
        scores = np.array([p.score for p in model.pieces], np.float64)
        own = np.array(sorted(normal.values()))
        order = np.unique(-scores[own], return_inverse=True)[1]
        rank = np.full(self.size, _NO_RANK, np.int32)
        rank[own] = order  # equal scores share a rank: the leftmost pair wins

        # Symbols are ids of pieces, or size + code point for characters that are no piece.
        self.first = np.arange(0x110000, dtype=np.int64) + self.size
        for piece, i in normal.items():
            if len(piece) == 1:
                self.first[ord(piece)] = i
        symbol = lambda s: normal.get(s, self.size + ord(s) if len(s) == 1 else -1)
        keys, made, beside = [], [], set()
        for piece, i in normal.items():
            beside.update((ord(a) << _SHIFT) | ord(b) for a, b in pairwise(piece))
            for cut in range(1, len(piece)):
                a, b = symbol(piece[:cut]), symbol(piece[cut:])
                if a >= 0 and b >= 0:
                    keys.append((a << _SHIFT) | b)
                    made.append(i)
        by_key = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[by_key]
        self.made = np.array(made, np.int64)[by_key]
        self.ranks = rank[self.made]
        self.beside = np.array(sorted(beside), np.int64)
        # Best rank of any pair that has a piece on one side.
        best = np.full(self.size, _NO_RANK, np.int32)
        for side in (self.keys >> _SHIFT, self.keys & ((1 << _SHIFT) - 1)):
            inside = side < self.size
            np.minimum.at(best, side[inside], self.ranks[inside])
        self.alone = best <= rank
        self.chains = self._chains()

    def _decoding(self, model) -> None:
        surfaces = []
        for p in model.pieces:
            if p.type == _CONTROL:
                surfaces.append(b"")
            elif p.type == _BYTE:
                surfaces.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == _UNKNOWN:
                surfaces.append(" ⁇ ".encode())
            else:
                surfaces.append(p.piece.replace(BLANK, " ").encode())
        self.lengths = np.array([len(s) for s in surfaces], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.led = np.array([p.type == _NORMAL and p.piece.startswith(BLANK) for p in model.pieces])
        self.control = np.array([p.type == _CONTROL for p in model.pieces])

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging neighbours."""
        key = (left << _SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NO_RANK), self.made[at]

    def _rough(self, hit, symbol, part, rank, made) -> np.ndarray:
        """Hits that would make a pair of their own rank or better with a neighbour as it is, or as merged with them.

        Such a pair comes before the hits to its right. The others can be merged together.
        """
        rough = np.zeros(len(hit), bool)
        at = np.flatnonzero(self.alone[made[hit]])
        if not len(at):
            return rough
        h, last = hit[at], len(symbol) - 1
        new, bound = made[h], rank[h]
        before, after = hit[np.maximum(at - 1, 0)] == h - 2, hit[np.minimum(at + 1, len(hit) - 1)] == h + 2
        left, right = np.maximum(h - 1, 0), np.minimum(h + 2, last)
        inside_left, inside_right = (h > 0) & (part[left] == part[h]), (h + 2 <= last) & (part[right] == part[h])
        for there, one, two in (
            (inside_left, symbol[left], new), (inside_left & before, made[np.maximum(h - 2, 0)], new),
            (inside_right, new, symbol[right]), (inside_right & after, new, made[right]),
        ):
            rough[at] |= there & (self._pairs(one, two)[0] <= bound)
        return rough

    def _chains(self) -> dict[int, "Run"]:
        """Symbols whose runs give pieces of one rank only: there the leftmost pair wins over and over."""
        same = np.flatnonzero(self.keys >> _SHIFT == self.keys & ((1 << _SHIFT) - 1))
        found = {}
        for k in same.tolist():
            one, bound = int(self.keys[k] >> _SHIFT), int(self.ranks[k])
            reached, pairs = [one], {}
            for a in reached:  # grows as it goes
                for b in list(reached):
                    for x, y in ((a, b), (b, a)):
                        r, m = self._pairs(np.array([x]), np.array([y]))
                        if r[0] != _NO_RANK:
                            pairs[x, y] = (int(r[0]), int(m[0]))
                            if int(m[0]) not in reached:
                                reached.append(int(m[0]))
                if len(reached) > _LONGEST_RUN or any(r != bound for r, _ in pairs.values()):
                    break
            else:
                if len(reached) > 2 and (run := Run.of(one, reached, {p: m for p, (_, m) in pairs.items()})):
                    found[one] = run
        return found

    def _even_runs(self, symbol, part, rank, least) -> np.ndarray | None:
        """Merge whole runs of a symbol in place; positions that stay, or None without such runs."""
        keep = None
        for one, run in self.chains.items():
            inside = symbol == one
            begin = inside.copy()
            begin[1:] &= ~(inside[:-1] & (part[1:] == part[:-1]))
            start = np.flatnonzero(begin)
            if not len(start):
                continue
            length = np.bincount(np.cumsum(begin)[inside] - 1, minlength=len(start))
            end, last = start + length, len(symbol) - 1
            left, right = np.maximum(start - 1, 0), np.minimum(end, last)
            beside_left, beside_right = (start > 0) & (part[left] == part[start]), (end <= last) & (part[right] == part[start])
            chosen = (length > 1) & (rank[start] == least[start])
            for piece in run.reached:
                new = np.full(len(start), piece)
                chosen &= ~(beside_left & (self._pairs(symbol[left], new)[0] != _NO_RANK))
                chosen &= ~(beside_right & (self._pairs(new, symbol[right])[0] != _NO_RANK))
            start, length = start[chosen], length[chosen]
            if not len(start):
                continue
            keep = np.ones(len(symbol), bool) if keep is None else keep
            for n in np.unique(length).tolist():
                at, made = run.filled(n)
                own = start[length == n]
                stays = np.zeros(n, bool)
                stays[at] = True
                keep[(own[:, None] + np.flatnonzero(~stays)).ravel()] = False
                symbol[(own[:, None] + at).ravel()] = np.tile(made, len(own))
                rank[(own[:, None] + np.arange(n)).ravel()] = _NO_RANK
        return keep

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word, packed as little-endian unsigned 32-bit integers."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        symbol = self.first[points]
        near = (points[:-1] << _SHIFT) | points[1:]
        at = np.minimum(np.searchsorted(self.beside, near), len(self.beside) - 1)
        joined = (self.beside[at] == near) & (word[1:] == word[:-1])
        part = np.concatenate([[0], np.cumsum(~joined)])  # segments that nothing can span
        place = np.arange(len(points))
        done_place, done_symbol = [], []
        rank, made = self._pairs(symbol[:-1], symbol[1:])
        rank = np.append(np.where(joined, rank, _NO_RANK), _NO_RANK).astype(np.int32)
        made = np.append(made, 0)
        while len(symbol):
            start = np.flatnonzero(np.diff(part, prepend=-1))
            least = np.minimum.reduceat(rank, start)
            size = np.diff(start, append=len(part))
            live = np.repeat(least != _NO_RANK, size)
            if not live.all():  # compaction: finished segments leave
                done_place.append(place[~live])
                done_symbol.append(symbol[~live])
                symbol, part, place, rank, made = (x[live] for x in (symbol, part, place, rank, made))
                if not len(symbol):
                    break
                keep = least != _NO_RANK
                least, size = least[keep], size[keep]
            hit = np.flatnonzero(rank == np.repeat(least, size))
            # Of overlapping hits every other one, counted from the left.
            run = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            step = np.arange(len(hit)) - np.repeat(run, np.diff(run, append=len(hit)))
            hit = hit[step % 2 == 0]
            rough = self._rough(hit, symbol, part, rank, made)
            if rough.any():
                keep = self._even_runs(symbol, part, rank, np.repeat(least, size))
                if keep is not None:
                    symbol, part, place, rank, made = (x[keep] for x in (symbol, part, place, rank, made))
                    continue
                # Of a segment, the hits up to the first one that makes a pair as good.
                first = np.diff(part[hit], prepend=-1) != 0
                before = np.cumsum(rough) - rough
                hit = hit[before == before[first][np.cumsum(first) - 1]]
            symbol[hit] = made[hit]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            now = hit - np.arange(len(hit))  # where the merged symbols are after compaction
            symbol, part, place, rank, made = (x[keep] for x in (symbol, part, place, rank, made))
            changed = np.unique(np.concatenate([now, now[now > 0] - 1]))
            rank[changed] = _NO_RANK
            changed = changed[changed + 1 < len(symbol)]
            changed = changed[part[changed] == part[changed + 1]]
            rank[changed], made[changed] = self._pairs(symbol[changed], symbol[changed + 1])
        place, symbol = np.concatenate(done_place), np.concatenate(done_symbol)
        order = np.argsort(place)
        return self._packed(symbol[order], word[place[order]], len(words))

    def _packed(self, symbol: np.ndarray, word: np.ndarray, count: int) -> list[bytes]:
        strange = symbol >= self.size
        if strange.any():
            ids, owner = [], []
            for s, w in zip(symbol.tolist(), word.tolist()):
                new = [s] if s < self.size else self.byte_ids[list(chr(s - self.size).encode())].tolist()
                ids += new
                owner += [w] * len(new)
            symbol, word = np.array(ids), np.array(owner)
        packed = symbol.astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(word, minlength=count))
        return [packed[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text with begin and end ids."""
        split = [_WORD.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        new = list({w for words in split for w in words if w not in self.words})
        if new:
            self.words.update(zip(new, self.merge(new)))
        begin, end = (int(x).to_bytes(4, "little") for x in (self.bos, self.eos))
        known = self.words.__getitem__
        return [b"".join([begin, *map(known, words), end]) for words in split]

    def decode(self, packed: list[bytes]) -> list[str]:
        """Texts of packed ids: control ids vanish, and so does one blank at the start."""
        counts = np.array([len(p) // 4 for p in packed], np.int64)
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        if not len(ids):
            return ["" for _ in packed]
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1])) - np.repeat(ends - lengths - self.starts[ids], lengths)
        flat = self.surface[at].tobytes()
        stops = np.cumsum(counts)
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], stops])]
        # The first id of each text that is no control id.
        spoken = np.append(np.flatnonzero(~self.control[ids]), len(ids))
        lead = spoken[np.searchsorted(spoken, stops - counts)]
        strip = (lead < stops) & self.led[ids[np.minimum(lead, len(ids) - 1)]]
        return [
            flat[a + s:b].decode("utf-8", "each-bad-byte")
            for a, b, s in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strip.tolist())
        ]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of whole texts of about ``BLOCK`` bytes: the lists of words and the arrays stay small."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= BLOCK:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_and_decode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` with ``token_ids`` (packed little-endian uint32), ``n_tokens`` and ``decoded``.

    ``model`` is a path that every executor can open; by default the installed public vocabulary.
    """

    def work(texts: list[bytes]) -> dict[str, list]:
        c = codec(model or public_tokenizers.path(MODEL))
        packed, decoded = [], []
        for block in blocks(texts):
            packed += c.encode([t.decode() for t in block])
            decoded += c.decode(packed[len(decoded):])
        return {"token_ids": packed, "n_tokens": [len(p) // 4 for p in packed], "decoded": decoded}

    return batches_with(
        docs, "text",
        {"token_ids": pa.binary(), "n_tokens": pa.int64(), "decoded": pa.string()},
        {"token_ids": "binary", "n_tokens": "bigint", "decoded": "string"}, work,
    )


@query("op1_sentencepiece")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode_and_decode(docs).select(
        "doc_id", "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
