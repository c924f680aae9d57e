from __future__ import annotations

import random

import pytest
import samples

from tillmark.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def wanted(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def strings():
    draw = random.Random(4)
    yield from samples.prose(9, 60)
    for _ in range(800):
        pool = draw.choice(["aab \n\t'stx0123.,!  ", "abcdefghijklmnop", "éüßñ漢字 \x1c  "])
        yield "".join(draw.choice(pool) for _ in range(draw.randint(0, 60)))
    yield from ["", " ", "x<|endoftext|>  y", "<|endoftext|><|endoftext|>", "a" * 5000, "\x00�"]
    yield "=" * 3000 + " -" * 1000


def test_same_ids_as_the_library():
    own = bpe.Vocabulary(PATH)
    texts = list(strings())
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == wanted(text)
        assert own.decode(ids) == LIBRARY.decode(wanted(text), skip_special_tokens=False)


def test_accepted_proposals_are_what_merging_gives():
    own = bpe.Vocabulary(PATH)
    own.learn({w for t in strings() for w in t.split()})
    assert all(ids == own.merge(word.encode()) for word, ids in own.words.items())


def test_long_texts_run_by_run(monkeypatch):
    monkeypatch.setattr(bpe, "RUN_CHARS", 64)
    own = bpe.Vocabulary(PATH)
    text = " ".join(samples.prose(3, 20))
    assert own.encode([text])[0].tolist() == wanted(text)


def test_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    own = bpe.Vocabulary(PATH)
    texts = samples.prose(5, 30)
    for text in texts:
        assert own.encode([text])[0].tolist() == wanted(text)


def test_frames(spark):
    rows = [(1, "some text"), (2, None), (3, ""), (1, "some text"), (None, "x<|endoftext|>")]
    got = bpe.round_trip(samples.documents(spark, rows), PATH).collect()
    assert [(r["doc_id"], list(r["ids"]), r["decoded"]) for r in got] == [
        (i, wanted(t or ""), t or "") for i, t in rows
    ]
    assert bpe.round_trip(samples.empty(spark), PATH).count() == 0


def test_latin_words_are_those_of_the_full_pattern():
    draw = random.Random(6)
    letters = [chr(i) for i in range(256)]
    kinds = ["a", "Z", "é", "ß", "µ", "0", "²", "¼", " ", " ", "\n", "\xa0", "\x85", "\x1c", "'", "s", "'ll", ".", "×"]
    texts = [a + b + c for a in letters for b in letters for c in (" ", "a")]
    texts += ["".join(draw.choice(kinds) for _ in range(40)) for _ in range(3000)]
    for text in texts:
        assert bpe._words(text) is bpe._LATIN_WORDS
        assert bpe._LATIN_WORDS.findall(text) == bpe._WORDS.findall(text)
    assert bpe._words("a’b") is bpe._WORDS
