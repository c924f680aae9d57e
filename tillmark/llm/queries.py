"""Registered queries of the text operators and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillmark.llm import (
    bpe,
    chat,
    decontam,
    jaccard,
    langid,
    licences,
    pii,
    repeats,
    sharding,
    spelling,
    structure,
    topk,
    toxicity,
)
from tillmark.llm.frames import table


def tokenizer_path() -> str:
    """The installed byte-level vocabulary; every executor has it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_suffix_dedup(spark, folder):
    cut = repeats.without_repeats(table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_bpe(spark, folder):
    coded = bpe.round_trip(table(spark, folder, "documents"), tokenizer_path())
    return bpe.digests(coded)


def op3_chat_format(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-1, 0, "user", trap), (-1, 1, "assistant", trap)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digests(chat.windows(turns.unionByName(planted)))


def op4_exact_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op5_pii(spark, folder):
    docs = table(spark, folder, "documents")
    found = pii.find(docs, pii.learn(docs))
    return found.select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
    )


def op6_ngram_jaccard(spark, folder):
    return jaccard.link_groups(table(spark, folder, "documents"))


def op7_licences(spark, folder):
    docs = table(spark, folder, "documents")
    return licences.per_document(docs, licences.learn(docs))


def op8_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_decontamination(spark, folder):
    return decontam.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op10_shards(spark, folder):
    return sharding.pack_shards(table(spark, folder, "documents"))


def op11_spelling_variants(spark, folder):
    words = spelling.word_counts(table(spark, folder, "documents"), slip_every=31)
    return spelling.variants(words)


def op12_language(spark, folder):
    docs = table(spark, folder, "documents")
    return langid.predict(docs, langid.learn(docs)).select(
        "doc_id",
        langid.is_held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )


def op13_conversation_repair(spark, folder):
    turns = table(spark, folder, "conversations")
    return structure.audit(structure.planted_damage(turns), turns)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_bpe": op2_bpe,
    "op3_chat_format": op3_chat_format,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_pii": op5_pii,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_licences": op7_licences,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_shards": op10_shards,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_language": op12_language,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op4_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   list_inner_product(q.e, v.e)::BIGINT AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
