from __future__ import annotations

import hashlib

import numpy as np
import pytest
import samples

from tillmark.llm import repeats
from tillmark.llm.ordered import with_again


def plain(texts: list[str], length: int) -> list[bytes]:
    """What stays, by marking every string that was seen before; texts in order of their ids."""
    seen, kept = set(), []
    for text in texts:
        data = (text or "").encode()
        mark = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                mark[i : i + length] = b"\1" * length
            seen.add(data[i : i + length])
        kept.append(bytes(b for b, m in zip(data, mark) if not m))
    return kept


def result(frame, **options):
    return {r["doc_id"]: r for r in repeats.without_repeats(frame, **options).collect()}


def corpus():
    texts = samples.prose(1, 14)
    passage = "the very same passage of many words " * 4
    texts += [texts[0], samples.edited(texts[1], 2, 5), texts[2] + passage, passage + texts[3]]
    texts += [None, "", "short", "a" * 700, "ab" * 400, "short", texts[4] * 3, passage * 2]
    return texts


@pytest.mark.parametrize("limit", [8000, 3])
@pytest.mark.parametrize("anchors", [10_000, 0])
def test_same_as_marking(spark, limit, anchors):
    texts = corpus()
    frame = samples.documents(spark, list(enumerate(texts)))
    got = result(frame, group_limit=limit, table_anchors=anchors)
    for i, kept in enumerate(plain(texts, 100)):
        row, data = got[i], (texts[i] or "").encode()
        assert bytes(row["kept"]) == kept
        assert row["n_bytes"] == len(data) and row["n_removed"] == len(data) - len(kept)
        assert sum(s["end"] - s["start"] for s in row["removed"]) == row["n_removed"]


def test_other_length(spark):
    texts = corpus()
    got = result(samples.documents(spark, list(enumerate(texts))), length=37, gram=9)
    assert [bytes(got[i]["kept"]) for i in range(len(texts))] == plain(texts, 37)


def test_ids_that_repeat_or_are_null(spark):
    text, other = samples.prose(2, 2, words=100)
    rows = [(None, text), (None, text), (3, text), (4, other), (4, other), (4, text + "!")]
    got = repeats.without_repeats(samples.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    kept = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in got}
    assert kept[None, len(text.encode())] == 0  # a null id comes first
    assert kept[3, len(text.encode())] == len(text.encode())
    assert kept[4, len(other.encode())] == 0
    assert kept[4, len(text.encode()) + 1] == len(text.encode())


def test_empty_table(spark):
    assert repeats.without_repeats(samples.empty(spark)).collect() == []


def test_longest_previous_factor():
    draw = np.random.default_rng(0)
    for _ in range(10):
        rows, places = draw.integers(0, 2, (120, 6)).astype(np.uint8), draw.permutation(120)
        wanted = [
            max(
                (int(np.argmin(np.append(a == b, False))) for b, q in zip(rows, places) if q < p),
                default=0,
            )
            for a, p in zip(rows, places)
        ]
        assert repeats.longest_previous(rows, places).tolist() == wanted


def test_long_texts_choose_the_same_anchors():
    draw = np.random.default_rng(3)
    data = draw.integers(97, 99, (1 << 20) + 500).astype(np.uint8).tobytes()
    keys, place, first, last = repeats.anchors(data)
    tail = repeats.anchors(data[-5000:])
    shift = len(data) - 5000
    inner = [(k, p + shift) for k, p in zip(tail[0].tolist(), tail[1].tolist())][2:]
    assert set(inner) <= set(zip(keys.tolist(), place.tolist()))


def test_passage_with_thousands_of_copies(spark):
    """More places of one anchor than a group may hold, against plain marking."""
    passage = " ".join(samples.prose(9, 3, words=40))[:260]
    texts = [hashlib.sha256(b"%d" % i).hexdigest() + passage + hashlib.md5(b"%d" % i).hexdigest()
             for i in range(4500)]
    texts += ["b" * 20_000, passage, passage * 3]
    got = result(samples.documents(spark, list(enumerate(texts))))
    wanted = plain(texts, 100)
    assert [bytes(got[i]["kept"]) for i in range(len(texts))] == wanted


def test_rows_that_repeat_an_earlier_one(spark, partitions):
    rows = [(i % 3 if i % 2 else 7, bytes([i % 2]), i) for i in range(400)]
    frame = spark.createDataFrame(rows, "a long, b binary, place long").repartition(5)
    got = {r["place"]: r["again"] for r in with_again(frame, ["a", "b"], ["place"]).collect()}
    seen, wanted = set(), {}
    for a, b, place in rows:
        wanted[place] = (a, b) in seen
        seen.add((a, b))
    assert got == wanted
    assert with_again(frame.filter("false"), ["a", "b"], ["place"]).collect() == []


def test_strings_of_hot_anchors_grow_with_their_places(spark, monkeypatch):
    passage = " ".join(samples.prose(51, 1, words=12))
    real, made = repeats._single_strings, []

    def counted(length):
        def convert(batches):
            for batch in real(length)(batches):
                rows.add(batch.num_rows)
                yield batch

        rows = spark.sparkContext.accumulator(0)
        made.append(rows)
        return convert

    monkeypatch.setattr(repeats, "_single_strings", counted)
    for places in (40, 80, 160):
        around = samples.prose(52, 2 * places, words=25)
        rows = [(i, f"{around[2 * i]} {passage} {around[2 * i + 1]}") for i in range(places)]
        options = {"group_limit": 10, "length": 40, "gram": 16}
        repeats.without_repeats(samples.documents(spark, rows), **options).collect()
    few, more, most = (rows.value for rows in made)
    assert 0 < few and more < 2.5 * few and most < 2.5 * more
