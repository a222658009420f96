from __future__ import annotations

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash_dedup as sd
from ledgerloom.llm.common import QUERIES


def plain_fingerprint(text: str | None, width: int) -> int:
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split(" ")
    for space in "\t\n\v\f\r":
        words = [x for w in words for x in w.split(space)]
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(values: np.ndarray, most: int) -> list[int]:
    """Smallest position reached, by comparing all pairs of blocks of rows."""
    label = np.arange(len(values))
    changed = True
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= most
    while changed:
        new = np.where(near, label[None, :], len(values)).min(1)
        changed = bool((new != label).any())
        label = new
    return label.tolist()


def clustered(rng, count: int) -> np.ndarray:
    """Random words, tight balls and chains."""
    centres = rng.integers(0, 2**64, 12, dtype=np.uint64)
    made = [rng.integers(0, 2**64, count // 2, dtype=np.uint64)]
    for c in centres:
        flips = rng.integers(0, 6, count // 24)
        for n in flips:
            x = int(c)
            for b in rng.choice(64, n, replace=False):
                x ^= 1 << int(b)
            made.append(np.array([x], np.uint64))
    chain = [int(centres[0])]
    for i in range(30):
        chain.append(chain[-1] ^ (0b1111 << (2 * i % 60)))
    return np.unique(np.concatenate([*made, np.array(chain, np.uint64), np.arange(60, dtype=np.uint64)]))


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_chain(seed):
    rng = np.random.default_rng(seed)
    values = clustered(rng, 700)
    rng.shuffle(values)
    found = sd.link(np.zeros(len(values), np.int64), values, 4)
    told = plain_classes(values, 4)
    assert len(set(zip(found.tolist(), told))) == len(set(found.tolist())) == len(set(told))


def test_buckets_of_one_call_stay_apart():
    values = np.array([0, 1, 3, 0, 1, 3], np.uint64)
    found = sd.link(np.array([0, 0, 0, 7, 7, 7]), values, 4)
    assert set(found[:3]) <= {0, 1, 2} and set(found[3:]) <= {3, 4, 5}


@pytest.mark.parametrize("count", [10, 2**20, 2**30, 2**40])
def test_some_key_holds_all_close_pairs(count):
    rng = np.random.default_rng(1)
    choices = sd.first_masks(count, 4)
    for _ in range(2000):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not flips & m for m in choices)


@pytest.mark.parametrize("hot", [sd.HOT_BUCKET, 20])
def test_components_equal_brute_force(spark, hot):
    rng = np.random.default_rng(9)
    values = clustered(rng, 600).view(np.int64)
    prints = spark.createDataFrame([(int(v),) for v in values], "fp bigint")
    links = sd.bucket_links(sd.bucketed(prints, len(values), 4, hot), 4)
    roots = {r.node: r.root for r in sd.components(links).collect()}
    found = [roots.get(int(v), int(v)) for v in values]
    told = plain_classes(values.view(np.uint64), 4)
    assert len(set(zip(found, told))) == len(set(found)) == len(set(told))


def test_query_equals_brute_force(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").collect()
    prints = np.array([plain_fingerprint(d.text, 4) for d in docs], np.uint64)
    label = plain_classes(prints, 4)
    least: dict[int, int] = {}
    for d, c in zip(docs, label):
        least[c] = min(least.get(c, d.doc_id), d.doc_id)
    told = {(d.doc_id, f"{int(p):016x}", least[c]) for d, p, c in zip(docs, prints, label)}
    got = QUERIES["op9_simhash_dedup"](spark, small_folder).collect()
    assert len(got) == len(docs)
    assert {tuple(r) for r in got} == told


def test_null_empty_short_and_repeated_texts(spark):
    docs = spark.createDataFrame(
        [(5, None, "a"), (4, "", "b"), (3, " \n", "c"), (9, "One two", "d"), (8, "ONE two", "e"),
         (8, "ONE two", "e"), (7, "One zwei", "f"), (None, "none of it", "g")],
        "doc_id bigint, text string, fp string",
    )
    got = {(r.doc_id, r.component_id) for r in sd.near_duplicates(docs).collect()}
    assert got == {(5, 3), (4, 3), (3, 3), (9, 8), (8, 8), (7, 7), (None, None)}
    kept = sd.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "7", "8", "8", "None"]
    assert sd.near_duplicates(docs.limit(0)).count() == 0


def test_components_need_no_round_to_see_stars(spark):
    names = []

    def stored(frame, name):
        names.append(name)
        return sd.stored(frame, name)

    links = spark.createDataFrame([(k, 1) for k in range(2, 9)] + [(12, 11), (13, 12)], "u bigint, v bigint")
    roots = {r.node: r.root for r in sd.components(links, stored).collect()}
    assert roots == {**{k: 1 for k in range(2, 9)}, 12: 11, 13: 11}
    assert names.count("components-large") == 1
