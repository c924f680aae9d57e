"""The pipeline against plain versions of its stages."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import samples
import test_decontam
import test_jaccard
import test_toxicity

import corpus_pipeline
from tillmark.llm import pii, toxicity

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t) for i, t, _ in test_toxicity.corpus(500)]
    items = samples.prose(61, 8, words=30)
    data = " mail a.b@mail.example.com or +1 (988) 555-2485 at 10.20.30.40 "
    rows += [(1000 + i, rows[4 * i + 1][1] + data + f"tail{i}") for i in range(60)]
    rows += [(2000 + i, samples.edited(rows[i][1], 1, i)) for i in range(60)]
    rows += [(3000 + i, item + " some words after it") for i, item in enumerate(items)]
    rows += [(4000, None), (4001, ""), (4002, rows[5][1])]
    table = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows]
    labels = [(i, 1, y) for i, _, y in test_toxicity.corpus(500)]
    frames = {
        "documents": (table, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (list(enumerate(items)), "item_id long, text string"),
    }
    for name, (values, schema) in frames.items():
        spark.createDataFrame(values, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path), table, items


def test_against_plain_stages(spark, folder):
    path, table, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{path}/labels.parquet"))
    kept = [r for r in table if toxicity.logits([(r[1] or "").encode()], model)[0] < 0]
    assert 300 < len(kept) < len(table)
    groups = test_jaccard.plain([r[:2] for r in kept])
    kept = [r for r in kept if groups[r[0]][1] == r[0]]
    found = test_decontam.plain([r[:2] for r in kept], list(enumerate(items)))
    kept = [r for r in kept if not found[r[0]][-1]]
    own = samples.empty(spark).select("doc_id", "text")
    frame = spark.createDataFrame([r[:2] for r in kept], own.schema)
    tagger = pii.learn(frame)
    library = tokenizers.Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    wanted = {}
    for doc, text, *_ in kept:
        (_, spans), = pii.all_spans([text or ""], tagger)
        masked = pii.masked(text or "", spans)
        ids = library.encode(masked, add_special_tokens=False).ids
        wanted[doc] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(masked.encode()).hexdigest())
        assert "a.b@mail.example.com" not in masked
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, path).collect()}
    assert set(got) == set(wanted)
    # The tagger learns from the rows in the order of their hash, so it is the same model.
    assert np.mean([got[i] == wanted[i] for i in wanted]) == 1


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).schema.simpleString() == docs.schema.simpleString()


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0


def test_columns_of_any_name(spark, folder):
    names = ["masked", "toxicity", "text_row", "number", "_toxicity", "_masked", "_text_row", "_kept"]
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").selectExpr(
        "*", *[f"doc_id AS {name}" for name in names]
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder[0])
        assert kept.columns == docs.columns
        assert kept.filter(" or ".join(f"{name} <> doc_id" for name in names)).isEmpty()
