"""Registry of the training-data operators: queries and their SQL."""

from __future__ import annotations

from opinio.llm import (ann, bpe, chat_format, conversation_repair, embed_dedup, language, ngram_join, packing, quality, sharding,
                        suffix_dedup, toxicity, whitening)

QUERIES = {f.__name__: f for f in (
    embed_dedup.op1_embedding_near_dedup,
    packing.op2_hierarchical_packing,
    ngram_join.op3_ngram_jaccard_join,
    ann.op4_rp_forest_neighbours,
    sharding.op5_lookup_table_sharding,
    suffix_dedup.op6_suffix_array_dedup,
    toxicity.op7_crf_toxicity,
    bpe.op8_bpe_encode_decode,
    language.op9_language_id,
    quality.op10_eb_quality,
    chat_format.op11_chat_format,
    whitening.op12_embedding_whitening,
    conversation_repair.op13_conversation_repair,
)}

#: SQL where it can express the operator on whole tables.
ORACLE = {
    "op1_embedding_near_dedup": embed_dedup.ORACLE,
    "op3_ngram_jaccard_join": ngram_join.ORACLE,
    "op5_lookup_table_sharding": sharding.ORACLE,
    "op11_chat_format": chat_format.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
