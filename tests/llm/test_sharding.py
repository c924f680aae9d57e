from __future__ import annotations

import hashlib
import zlib

import pytest
import samples

from tillmark.llm import sharding


def smallest(sizes, shards):
    """The minimax capacity by trying each one."""
    capacity = max(sizes)
    while True:
        used, room = 1, capacity
        for size in sizes:
            if size > room:
                used, room = used + 1, capacity
            room -= size
        if used <= shards:
            return capacity
        capacity += 1


def rows():
    texts = samples.prose(31, 120, words=12)
    texts += [texts[0]] * 40 + [None, "", "", "x" * 3000, "é" * 50]
    return list(enumerate(texts))


@pytest.mark.parametrize("shards", [1, 3, 8])
@pytest.mark.parametrize("fetched", [50_000, 2])
def test_minimax(spark, shards, fetched):
    table = rows()
    got = sharding.pack_shards(
        samples.documents(spark, table), shards=shards, driver_groups=fetched
    ).collect()
    assert len(got) == len(table)
    texts = dict(table)
    totals, by_text, slots = {}, {}, {}
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
        by_text.setdefault(data, set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for _, text in table:
        data = (text or "").encode()
        digest = hashlib.sha256(data).digest()
        groups[digest] = groups.get(digest, 0) + len(data) + 1
    assert max(totals.values()) == smallest([groups[d] for d in sorted(groups)], shards)


def test_fewer_groups_than_shards(spark):
    got = sharding.pack_shards(samples.documents(spark, [(1, "a"), (2, "a"), (None, "b")])).collect()
    assert len(got) == 3 and len({r["shard"] for r in got}) == 2


def test_empty(spark):
    out = sharding.pack_shards(samples.empty(spark))
    assert out.collect() == []
    assert out.dtypes == [
        ("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
        ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int"),
    ]
