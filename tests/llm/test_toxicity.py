from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import samples

from tillmark.llm import toxicity

BAD = ["stinker", "blockhead", "numbskull", "rubbishy"]


def corpus(count=900, seed=0):
    draw = random.Random(seed)
    rows = []
    for i, text in enumerate(samples.prose(41, count, vocabulary=600, words=40)):
        words, toxic = text.split(" "), i % 4 == 0
        for _ in range(2 + len(words) // 30) if toxic else ():
            words.insert(draw.randrange(len(words) + 1), draw.choice(BAD))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    rows = corpus()
    docs = samples.documents(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 10] + [(7, 0, None)],
                                   "doc_id long, quality int, toxic int")
    return rows, docs, labels


@pytest.fixture(scope="module")
def model(frames):
    return toxicity.learn(frames[1], frames[2])


def test_held_out_accuracy(frames, model):
    rows, docs, _ = frames
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(got[i] >= 0.5, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([p == bool(y) for p, y in held]) > 0.9


def test_unseen_misspellings_and_long_texts(frames, model):
    clean = [r[1] for r in frames[0] if not r[2]]
    bad = ["you stinkerr and blokhead", "what a numbskul, rubbishyy numbskulll"]
    bad.append(" ".join(clean[:40]) + " stinker blockhead numbskull " + " ".join(clean[40:80]))
    assert (toxicity.logits([t.encode() for t in bad], model) > 0).all()
    assert (toxicity.logits([t.encode() for t in clean[:100]], model) < 0).mean() > 0.95
    assert toxicity.logits([b""], model)[0] < 0


def test_labels_of_held_out_rows_are_not_used(frames, spark):
    _, docs, labels = frames
    flipped = labels.withColumn(
        "toxic",
        toxicity.F.when(
            toxicity.is_held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")
        ).otherwise(toxicity.F.col("toxic")),
    )
    small = dict(toxic_rows=60, clean_rows=60)
    one, two = toxicity.learn(docs, labels, **small), toxicity.learn(docs, flipped, **small)
    assert np.array_equal(one.subwords, two.subwords) and one.bias == two.bias


def test_odd_rows(spark, frames, model):
    rows = [(1, None), (2, ""), (3, "   \n"), (3, "   \n"), (None, "stinker blockhead numbskull"),
            (5, "stinker " * 30_000)]
    docs = samples.documents(spark, rows)
    got = [tuple(r) for r in toxicity.score(docs, model).collect()]
    assert [i for i, _ in got] == [i for i, _ in rows]
    assert all(0 <= s <= 1 for _, s in got) and got[0][1] == got[1][1] == got[2][1] < 0.5
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()][:4] == [1, 2, 3, 3]
    assert toxicity.score(samples.empty(spark), model).count() == 0


def test_without_both_classes(spark, frames):
    docs = frames[1]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scores = toxicity.score(docs.limit(5), toxicity.learn(docs, none)).collect()
    assert all(r["score"] < 0.01 for r in scores)


def plain_logit(text, model):
    """The largest window of a text, word by word."""
    own = [w for w in text.encode().translate(toxicity.words.SPACES).split(b" ") if w]
    values = []
    for word in own:
        pairs = toxicity._subwords(toxicity.words.split([word], toxicity.words.SPACES))
        buckets = np.concatenate([bucket for _, bucket in pairs])
        # The word itself, and its n-grams of three to five bytes.
        assert len(buckets) == 1 + sum(max(len(word) - n + 1, 0) for n in (3, 4, 5))
        values.append(float(np.mean([float(model.subwords[b]) for b in buckets])))
    size, number = toxicity.WINDOW, max(len(own) // toxicity.WINDOW, 1)
    windows = []
    for i in range(number):
        end = len(own) if i == number - 1 else (i + 1) * size
        held = dict(zip(own[i * size : end], values[i * size : end]))
        windows.append(sum(held.values()) / max(end - i * size, size))
    return max(windows) + model.bias


def test_logits_against_plain_loops(frames, model):
    texts = [r[1] for r in frames[0][:40]]
    texts += ["", "  \n ", "a", "ab\tcd", "Éé ÜÜ", "same " * 55, " ".join(texts[:9]), "x" * 300]
    got = toxicity.logits([t.encode() for t in texts], model)
    assert np.allclose(got, [plain_logit(t, model) for t in texts], atol=1e-5)
