from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from samples import documents, empty

from tillmark.llm import langid, queries

SYLLABLES = {
    "en": "th he ing er on an re nd at ion",
    "de": "sch ei en er un ge ch ie ü ß",
    "fr": "ou eau é è ai re le tion ç que",
    "es": "ción os ar ue ñ ll do es la í",
}


def made(language, seed, words=30):
    draw = random.Random(seed)
    own = SYLLABLES[language].split()
    return " ".join("".join(draw.choices(own, k=draw.randint(1, 4))) for _ in range(words))


def corpus():
    rows, labels = [], []
    for i in range(240):
        language = list(SYLLABLES)[i % 4]
        rows.append((i, made(language, i, 3 + i % 60)))
        labels.append(language)
    return rows, labels


@pytest.fixture(scope="module")
def model():
    rows, labels = corpus()
    return langid.fit([text for _, text in rows], labels)


def plain_margins(text, model):
    padded = b" " + bytes(
        b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()
    ) + b" "
    result = model.biases.astype(float).copy()
    offset = 0
    for n, bits in langid.GRAMS:
        entries = []
        for i in range(len(padded) - n + 1):
            gram = padded[i : i + n]
            if b"  " not in gram:
                code = int.from_bytes(gram, "big")
                entries.append(((code * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits)) + offset)
        for pair in range(len(result)):
            total = sum(float(model.tables[pair][e]) for e in entries)
            result[pair] += total / max(len(entries), 1)
        offset += 1 << bits
    return result


def test_margins_against_plain_loops(model):
    texts = ["", "a", "ab", "abc", "  x  y ", "ÉCOLE d'été!", "12 34", "日本語 text", "\n", made("fr", 999)]
    got = langid.margins(texts, model)
    for text, own in zip(texts, got):
        assert np.allclose(own, plain_margins(text, model), atol=1e-5)
        assert np.array_equal(own, langid.margins([text], model)[0])


def test_features_and_margins_agree(model):
    for text in ["ab", made("de", 5)]:
        (entries, values), = langid.features([text])
        want = model.tables[:, entries] @ values + model.biases
        assert np.allclose(want, langid.margins([text], model)[0], atol=1e-5)


def test_two_levels(model):
    assert model.languages == ["de", "en", "es", "fr"]
    assert [p for p in model.pairs if not p[0].startswith("\x00")] == [("de", "en"), ("es", "fr")]
    assert langid.family("pt-BR") == "romance" and langid.family("xx_YY") == "xx"


def test_machine_separates_and_bounds_duals():
    draw = np.random.default_rng(1)
    rows = [(np.array([i % 2, 2 + draw.integers(0, 5)]), np.array([1.0, 0.5])) for i in range(60)]
    signs = np.array([1.0 if i % 2 else -1.0 for i in range(60)])
    weights, bias = langid.train_pair(rows, signs)
    assert all(sign * (weights[e] @ v + bias) > 0 for (e, v), sign in zip(rows, signs))


def test_votes_and_ties():
    names = ["a", "b", "c"]
    zero = np.zeros(1)
    assert langid._winner(names, {("a", "b"): zero, ("a", "c"): zero, ("b", "c"): zero})[0] == 0
    best, sure = langid._winner(
        names, {("a", "b"): zero - 1, ("a", "c"): zero + 1, ("b", "c"): zero + 2}
    )
    assert best == 1 and 0.5 < sure[0] < 1


def test_predictions_of_odd_rows(spark, model):
    rows = [
        (1, None), (2, ""), (3, "123 --- \n"), (4, "½ ² ٣"), (5, made("fr", 3)), (5, made("fr", 3)),
        (None, made("de", 4)), (6, made("es", 6) * 3000), (7, "\u0000 \x1f"),
    ]
    got = {
        (r["doc_id"], r["lang_pred"]): r["score"]
        for r in langid.predict(documents(spark, rows), model).collect()
    }
    assert set(got) == {(1, "und"), (2, "und"), (3, "und"), (4, "und"), (5, "fr"), (None, "de"), (6, "es"), (7, "und")}
    assert all(0 <= score <= 1 for score in got.values())
    assert langid.predict(empty(spark), model).collect() == []


def test_learning_from_odd_tables(spark):
    frame = spark.createDataFrame(
        [(1, "hello there", "en"), (2, None, "en"), (4, "111", "xx"), (5, "x", None)],
        "doc_id long, text string, lang string",
    )
    assert langid.learn(frame.limit(0)).languages == []
    one = langid.learn(frame)
    assert one.languages == ["en"]
    got = langid.predict(frame, one).orderBy("doc_id").collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("en", 1.0), ("und", 0.0), ("und", 0.0), ("en", 1.0)]
    none = langid.predict(frame, langid.learn(frame.limit(0))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}


def test_held_out_rows_teach_nothing(spark):
    rows, labels = corpus()
    marked = [
        (i, text, "held" if zlib.crc32(str(i).encode()) % 4 == 2 else label)
        for (i, text), label in zip(rows, labels)
    ]
    frame = spark.createDataFrame(marked, "doc_id long, text string, lang string")
    assert langid.learn(frame).languages == ["de", "en", "es", "fr"]


def test_copies_weigh_once(spark, partitions):
    rows, labels = corpus()
    own = [(i, text, label) for (i, text), label in zip(rows, labels)]
    frame = spark.createDataFrame(own, "doc_id long, text string, lang string")
    more = spark.createDataFrame(own + own[:9] * 30, frame.schema)
    first, second = langid.learn(frame, rows=20), langid.learn(more, rows=20)
    assert np.array_equal(first.tables, second.tables)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    scored = queries.op12_language(spark, folder).join(docs, "doc_id").filter("held_out")
    rows = [r for r in scored.collect() if r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert len(rows) > 200 and right / len(rows) > 0.97
