from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import documents, empty

from tillmark.llm import spelling


def edits(word, alphabet):
    found = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for letter in alphabet:
        found |= {word[:i] + letter + word[i:] for i in range(len(word) + 1)}
        found |= {word[:i] + letter + word[i + 1 :] for i in range(len(word))}
    return found - {word}


def plain_counts(rows, shortest=7, fewest=2, every=31):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if every:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                n[run] += 1
    return {word: k for word, k in n.items() if k >= fewest}


def plain_variants(n, ratio=10):
    alphabet = set("".join(n))
    near = {word: edits(word, alphabet) & n.keys() for word in n}
    form = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda w: (-n[w], w))
            if n[best] >= ratio * n[word]:
                form[word] = best
    rows = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        own = form.get(word)
        rows.append((word, own, root, n[word], len(near[word]), n[own] if own else None))
    return sorted(rows, key=repr)


def words_of(seed, count, letters="abcdeé"):
    draw = random.Random(seed)
    base = ["".join(draw.choice(letters) for _ in range(draw.randint(5, 12))) for _ in range(count)]
    found = set(base)
    for word in base:
        found |= set(draw.sample(sorted(edits(word, letters)), 3))
    return sorted(w for w in found if len(w) >= 4)


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzäöüß"])
def test_near_pairs(spark, letters):
    words = words_of(3, 150, letters)
    frame = spark.createDataFrame([(w, 1 + i) for i, w in enumerate(words)], "word string, n long")
    got = sorted((r["a"], r["b"]) for r in spelling.near_pairs(frame).collect())
    known = set(words)
    wanted = {tuple(sorted((w, o))) for w in words for o in edits(w, letters) & known}
    assert got == sorted(wanted) and wanted
    numbers = {w: 1 + i for i, w in enumerate(words)}
    assert all(
        (r["a_n"], r["b_n"]) == (numbers[r["a"]], numbers[r["b"]])
        for r in spelling.near_pairs(frame).collect()
    )


def test_pivots_are_the_cheapest_disjoint_pair():
    draw = np.random.default_rng(5)
    counts = draw.integers(1, 30, (200, 9))
    allowed = draw.random((200, 9)) < 0.6
    first, second = spelling.pivots(counts, allowed)
    for row in range(200):
        pairs = [
            counts[row, i] + counts[row, j]
            for i in range(9)
            for j in range(i + 2, 9)
            if allowed[row, i] and allowed[row, j]
        ]
        if pairs:
            i, j = first[row], second[row]
            assert j >= i + 2 and allowed[row, i] and allowed[row, j]
            assert counts[row, i] + counts[row, j] == min(pairs)


def corpus():
    draw = random.Random(11)
    words = words_of(7, 60, "abcdefgé") + ["Ünïtàrÿword", "ÀÉÎÕÜàéî", "a×b÷caaaa"]
    weight = [draw.choice((1, 1, 2, 30)) for _ in words]
    rows = [
        (i, " ".join(w.upper() if draw.random() < 0.1 else w for w in draw.choices(words, weight, k=80)))
        for i in range(60)
    ]
    chain = "waterfalls " * 2000 + "waterfall " * 150 + "waterfal " * 12 + "watrfal " * 2
    long = "z" * 3000
    return rows + [
        (100, chain),
        (101, f"{long} {long}y {long}"),
        (101, f"{long} {long}y {long}"),
        (102, None),
        (103, ""),
        (None, "nullness nullness nullnes"),
        (None, "1234 --- Ābcdefghi日本語 shortly"),
        (104, "dup dup " * 10),
        (105, chain),
        (106, chain),
    ]


def test_variants_of_a_corpus(spark, partitions):
    rows = corpus()
    words = spelling.word_counts(documents(spark, rows), slip_every=31)
    wanted = plain_counts(rows)
    assert {r["word"]: r["n"] for r in words.collect()} == wanted
    got = sorted((tuple(r) for r in spelling.variants(words).collect()), key=repr)
    assert got == plain_variants(wanted)


def test_roots_follow_forms(spark):
    text = "waterfalls " * 2000 + "waterfall " * 150 + "waterfal " * 12 + "watrfal waterfa "
    words = spelling.word_counts(documents(spark, [(1, text), (None, "Watrfal\twaterfa")]))
    got = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in spelling.variants(words).collect()}
    assert got == {
        "waterfalls": (None, "waterfalls", 1),
        "waterfall": ("waterfalls", "waterfalls", 2),
        "waterfal": ("waterfall", "waterfalls", 3),
        "watrfal": (None, "watrfal", 1),
        "waterfa": (None, "waterfa", 1),
    }


def test_hot_bigrams_and_equal_numbers(spark):
    """A third of all words share their beginning; all numbers are equal but one."""
    words = [f"common{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    frame = spark.createDataFrame([(w, 2) for w in words] + [("commonaax", 20)], "word string, n long")
    got = sorted((tuple(r) for r in spelling.variants(frame).collect()), key=repr)
    assert got == plain_variants({**dict.fromkeys(words, 2), "commonaax": 20})


def test_no_words(spark):
    words = spelling.word_counts(empty(spark))
    assert words.collect() == [] and spelling.variants(words).collect() == []
    one = spelling.word_counts(documents(spark, [(1, "lonesome lonesome")]))
    assert [tuple(r) for r in spelling.variants(one).collect()] == [
        ("lonesome", None, "lonesome", 2, 0, None)
    ]
