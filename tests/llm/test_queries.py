from __future__ import annotations

from pathlib import Path

import parity
import pytest

import __spark_entry__ as registry
from tillmark.llm import queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_registered():
    names = registry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert "pipeline" in names and set(queries.ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_same_rows(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert parity.differences(df, parity.connect(FOLDER), queries.ORACLES[name]) == []


CONTRACTS = {
    "op1_suffix_dedup": "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    "op2_bpe": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    "op3_chat_format": "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
    " loss_sha256 string, formatted_chars long",
    "op4_exact_top_k": "query_id long, rank int, vec_id long, score long",
    "op5_pii": "doc_id long, n_email long, n_ip long, n_card long, n_phone long,"
    " base_sha256 string, spans string",
    "op6_ngram_jaccard": "doc_id long, n_shingles long, component_id long",
    "op8_toxicity": "doc_id long, held_out boolean, score double, predicted int",
    "op9_decontamination": "doc_id long, n_words long, n_hit long, n_items long,"
    " items_sha256 string, contaminated boolean",
    "op10_shards": "doc_id long, size long, text_crc32 long, law string, shard int, slot long,"
    " grown_shard int",
    "op11_spelling_variants": "word string, form string, root string, n long, n_near long, form_n long",
    "op12_language": "doc_id long, held_out boolean, lang_pred string, score double",
    "op13_conversation_repair": "conv_id long, gaps long, blank long, duplicate long, truncated long,"
    " illegal long, cost long, audit string, repaired_sha256 string",
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_columns_and_rows(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    if name in CONTRACTS:
        wanted = [part.strip().split(" ") for part in CONTRACTS[name].split(",")]
        kinds = dict(got.dtypes)
        names = {"long": "bigint"}
        assert all(kinds[column] == names.get(kind, kind) for column, kind in wanted)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if "doc_id" in got.columns:
        assert got.count() == got.select("doc_id").distinct().count() == docs
