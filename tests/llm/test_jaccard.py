from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import samples

from tillmark.llm import jaccard
from tillmark.llm.graph import components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text):
    words = (text or "").encode().translate(_LOWER).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def roots(pairs, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def plain(rows):
    sets = {i: shingles(t) for i, t in rows}
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), root) for i, root in roots(pairs, sets).items()}


def corpus():
    texts = samples.prose(11, 40, vocabulary=3000, words=90)
    passage = " ".join(samples.prose(12, 1, words=30))
    rows = list(texts)
    for i, text in enumerate(texts[:25]):
        rows += [samples.edited(text, k, 7 * i + k) for k in range(4)]  # chains of near copies
        rows.append(text.upper())
    last = texts[0]
    for k in range(12):  # each close to the one before, the ends far apart
        last = samples.edited(last, 2, k)
        rows.append(last)
    rows += [passage + " " + t for t in texts[25:35]]  # a shared passage links nothing
    rows += [None, "", "   ", "one", "one", "ONE", "one two three", "one two three four five"]
    random.Random(2).shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [2000, 3])
def test_same_components_as_all_pairs(spark, block):
    rows = corpus()
    got = jaccard.link_groups(samples.documents(spark, rows), block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(rows)
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    for r in got:
        same = [i for i in sets if sets[i] == sets[r["doc_id"]]] if sets[r["doc_id"]] else [r["doc_id"]]
        assert r["class_id"] == min(same)


def test_every_similar_pair_shares_a_key():
    draw = np.random.default_rng(5)
    for size in [4, 5, 7, 9, 12, 20, 33, 47, 64, 90, 130, 250, 420, 800, 1700]:
        for _ in range(40):
            union = draw.integers(0, 1 << 63, size, dtype=np.uint64)
            gone = size // 5
            split = int(draw.integers(0, gone + 1))
            a, b = np.unique(union[split:]), np.unique(union[: size - (gone - split)])
            assert 100 * len(np.intersect1d(a, b)) >= 80 * size
            both = set(jaccard.bands_of(len(a))) & set(jaccard.bands_of(len(b)))
            assert any(
                set(jaccard.keys_of(a, n).tolist()) & set(jaccard.keys_of(b, n).tolist()) for n in both
            )


def test_sketch_is_a_lower_bound():
    draw = np.random.default_rng(6)
    for size in (10, 100, 1000):
        pool = draw.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
        a, b = pool[:size], pool[size // 3 : size + size // 3]
        number = jaccard.bands_of(size)[0]
        bits = [np.frombuffer(jaccard.bit_sketch(s, number), np.uint64) for s in (a, b)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_one_row_per_group(spark):
    rows = corpus() + [(500, "a text of its own with words"), (500, "a text of its own with words"),
                       (None, "one"), (None, "words that stand nowhere else at all")]
    kept = jaccard.one_per_group(samples.documents(spark, rows))
    assert kept.columns == samples.empty(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    wanted = [i for i, (_, root) in plain(corpus()).items() if i == root]
    assert sorted(i for i in ids if i is not None) == sorted([*wanted, 500])
    assert ids.count(None) == 1  # "one" stands under ids too


def test_rows_without_ids_link_like_others(spark):
    text = samples.prose(3, 1, words=200)[0] + " and so on to the end of it"
    near = [text, samples.edited(text, 1, 1), samples.edited(text, 1, 2)]
    lone = samples.prose(4, 1, words=200)[0]
    rows = [(None, near[0]), (7, near[1]), (None, near[2]), (None, lone), (None, lone), (None, None)]
    got = jaccard.link_groups(samples.documents(spark, rows)).collect()
    ids = sorted(((r["doc_id"], r["component_id"], r["n_shingles"] > 0) for r in got), key=repr)
    assert ids == sorted(
        [(None, 7, True), (7, 7, True), (None, 7, True), (None, None, True), (None, None, True),
         (None, None, False)], key=repr,
    )
    kept = jaccard.one_per_group(samples.documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"]) == [(7, near[1])]
    assert sorted(map(str, [r["text"] for r in kept if not r["doc_id"]])) == sorted(["None", lone])


@pytest.mark.parametrize("rounds, crowd", [(0, 8), (3, 2)])
def test_rounds_change_no_component(spark, rounds, crowd):
    rows = corpus()
    own = jaccard._named(samples.documents(spark, rows), "doc_id", "text")
    got = jaccard._linked(own, jaccard.PERCENT, jaccard.BLOCK, rounds, crowd).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(rows)


def test_empty(spark):
    assert jaccard.link_groups(samples.empty(spark)).collect() == []


def test_components(spark):
    draw = random.Random(8)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (2000, 5), (5, 2000)]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    ids = {i for p in pairs for i in p if p[0] != p[1]}
    assert {r["id"]: r["root"] for r in got} == roots(pairs, ids) and len(got) == len(ids)


def test_pairs_are_named_once():
    """Sets that share many keys are named at the smallest one only."""
    sets = {1: [3, 5, 8], 2: [3, 5, 8], 3: [5, 8], 4: [8]}  # 4 is in the group of 1
    rows = [(key, i) for i, keys in sets.items() for key in keys]
    sketch = jaccard.bit_sketch(np.arange(100, dtype=np.uint64), 8)
    batch = pa.RecordBatch.from_pylist(
        [
            {"key": key, "low_block": 0, "high_block": 0, "block": 0, "id": i, "grouped": i % 3,
             "size": 100, "sketch": sketch, "least": sets[i]}
            for key, i in sorted(rows)
        ]
    )
    pairs = [(r["a"], r["b"]) for out in jaccard._near(80)([batch]) for r in out.to_pylist()]
    assert sorted(pairs) == [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]


def test_batches_of_sets_equal_single_ones():
    rows = [t.encode() for t in [*samples.prose(31, 30, words=60), "", "one", "a b", "a b a b a b a b a b"]]
    together = jaccard.shingle_sets(rows)
    for i, row in enumerate(rows):
        alone = jaccard.shingle_sets([row])
        assert together[i].tolist() == alone[0].tolist() == sorted(set(alone[0].tolist()))
        assert jaccard.set_hashes(together)[i] == jaccard.set_hashes(alone)[0]
        assert len(alone[0]) == len(shingles(row.decode()))
