"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from panelcast.llm import (
    bpe,
    decontaminate,
    language,
    lexical,
    license_scan,
    line_dedup,
    near_dup,
    packing,
    quality,
    quotes,
    token_store,
    trie,
    url_filter,
)

REGISTRY = {
    "op1_bpe_round_trip": bpe.op1_bpe_round_trip,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_token_shards": token_store.op5_token_shards,
    "op6_minhash_near_dedup": near_dup.op6_minhash_near_dedup,
    "op7_language_id": language.op7_language_id,
    "op8_chat_formatting": quotes.op8_chat_formatting,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_packing": packing.op11_packing,
    "op12_conversation_prefix_trie": trie.op12_conversation_prefix_trie,
    "op13_ranked_lexical_search": lexical.op13_ranked_lexical_search,
}

# Without SQL, and tested against brute force in tests/llm: op1 (merges in rank order), op4 (alignment),
# op5 (a keyed permutation over stored files), op7 (a trained model), op8 (parsing of nested quotes),
# op11 (any packing of the same ids is right).
ORACLE = {
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op3_url_filter": url_filter.OP3_SQL,
    "op6_minhash_near_dedup": near_dup.OP6_SQL,
    "op9_benchmark_decontamination": decontaminate.OP9_SQL,
    "op10_quality_rules": quality.OP10_SQL,
    "op12_conversation_prefix_trie": trie.OP12_SQL,
    "op13_ranked_lexical_search": lexical.OP13_SQL,
}
