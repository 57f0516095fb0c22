"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, conversations, fingerprints, hnsw, langid, mixing, quality, secrets, simhash, substring, suffixes, tokencounts, whitening


def queries() -> dict:
    return {
        "op1_suffixes": suffixes.op1_suffixes,
        "op2_bpe": bpe.op2_bpe,
        "op3_token_counts": tokencounts.op3_token_counts,
        "op4_embeddings": hnsw.op4_embeddings,
        "op5_substring": substring.op5_substring,
        "op6_simhash": simhash.op6_simhash,
        "op7_quality": quality.op7_quality,
        "op8_langid": langid.op8_langid,
        "op9_secrets": secrets.op9_secrets,
        "op10_mixing": mixing.op10_mixing,
        "op11_whitening": whitening.op11_whitening,
        "op12_prefix_trie": conversations.op12_prefix_trie,
        "op13_fingerprints": fingerprints.op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_mixing": mixing.ORACLE, "op12_prefix_trie": conversations.ORACLE}
