"""The queries of this subpackage by name, and their SQL where there is any."""

from __future__ import annotations

from plumbline.llm import chat, embeddings, licenses, media, minhash, ngrams, packing, suffix, toxicity, wordbpe

QUERIES = {
    "op1_suffix_dedup": suffix.op1_suffix_dedup,
    "op2_media_columns": media.op2_media_columns,
    "op3_minhash_near_dedup": minhash.op3_minhash_near_dedup,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_bpe_roundtrip": wordbpe.op5_bpe_roundtrip,
    "op6_lm_scores": ngrams.op6_lm_scores,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_best_fit_pack": packing.op8_best_fit_pack,
    "op9_chat_format": chat.op9_chat_format,
    "op10_embedding_near_dedup": embeddings.op10_embedding_near_dedup,
}

ORACLE_SQL = {"op6_lm_scores": ngrams.SQL, "op10_embedding_near_dedup": embeddings.SQL, "op7_license_scan": licenses.SQL, "op9_chat_format": chat.SQL}
