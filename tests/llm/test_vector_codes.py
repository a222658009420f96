from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

import oracle
from ledgerloom.llm import vector_codes as vc
from ledgerloom.llm.common import ORACLES, QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain_codes(rows, parts, entries, rounds):
    """Loops over Python integers: every part against every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    length = -(-max([1, *(len(r[1]) for r in kept)]) // parts) * parts
    width = length // parts
    cut = []
    for r in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        v = [math.floor(256 * x) for x in r[1]] + [0] * (length - len(r[1]))
        cut.append((r[0], r[2], [v[p * width:(p + 1) * width] for p in range(parts)]))
    books = [[c[2][p] for c in cut[:entries]] for p in range(parts)]

    def best(p, s):
        return min((sum((a - b) ** 2 for a, b in zip(s, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        made = [[list() for _ in b] for b in books]
        for _, _, ps in cut:
            for p, s in enumerate(ps):
                made[p][best(p, s)[1]].append(s)
        books = [[[sum(x) // len(m) for x in zip(*m)] if m else old for m, old in zip(mp, bp)] for mp, bp in zip(made, books)]
    out = []
    for ident, label, ps in cut:
        found = [best(p, s) for p, s in enumerate(ps)]
        out.append((ident, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def test_query_equals_sql(spark, small_folder):
    name = "op12_vector_codes"
    problems, rows = oracle.compare(spark, oracle.connect(small_folder), QUERIES[name], ORACLES[name], small_folder)
    assert not problems and rows


def hard_rows():
    rng = random.Random(4)
    # Few distinct values: ties between entries and equal entries are frequent.
    rows = [(i, [rng.choice([-0.5, -0.01, 0.0, 0.25]) for _ in range(8)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(400, None, 1), (401, [0.1] * 7 + [float("nan")], 1), (402, [float("inf")] + [0.0] * 7, 2),
             (403, [None] + [0.0] * 7, 2), (5, [9.0] * 8, 1), (5, [9.0] * 8, 1), (None, [0.3] * 8, 7),
             (500, [], None), (501, [1.0, 2.0, 3.0], 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts,entries,rounds", [(4, 16, 2), (3, 64, 1), (1, 1, 2)])
def test_equals_plain_loops(spark, parts, entries, rounds):
    rows = hard_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    books = vc.fit(frame, parts=parts, entries=entries, rounds=rounds)
    got = sorted((str(r.vec_id), str(r.label), r.code, r.error) for r in vc.encode(frame, books).collect())
    told, digest = plain_codes(rows, parts, entries, rounds)
    assert got == sorted((str(i), str(l), c, e) for i, l, c, e in told)
    assert books.digest() == digest


def test_orchard_finds_what_all_distances_find():
    rng = np.random.default_rng(1)
    for spread in (2, 50, 5000):
        books = vc.Codebooks(rng.integers(-spread, spread, (3, 64, 4)), 12)
        points = rng.integers(-2 * spread, 2 * spread, (400, 3, 4))
        entry, gap = vc.nearest(points, books)
        every = ((points[:, :, None, :] - books.entries[None]) ** 2).sum(3)
        assert (entry == every.argmin(2)).all() and (gap == every.min(2)).all()


def test_huge_numbers_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(1, [1e300, -1e300], 1, "kept"), (2, [0.0, 0.0], 1, "too")], SCHEMA + ", code string")
    got = vc.encode(frame, vc.fit(frame, parts=2, entries=1))
    assert got.columns == ["vec_id", "embedding", "label", "code", "error"]
    assert all(r.error >= 0 for r in got.collect())
    none = frame.where("false")
    assert vc.fit(none) is None and vc.encode(none, None).count() == 0
    assert vc.encode(none, None).columns == got.columns


def test_decode_gives_back_the_entries(spark):
    frame = spark.createDataFrame([(i, [i / 8, -i / 4, 0.5, 1.0], 0) for i in range(9)], SCHEMA)
    books = vc.fit(frame, parts=2, entries=16)
    for r in vc.encode(frame, books).collect():
        assert r.error == 0 and vc.decode(r.code, books) == [math.floor(256 * x) for x in r.embedding]
