"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from perfmart.llm import (
    chat_windows,
    decontaminate,
    language,
    ngram_join,
    periodic_runs,
    pieces,
    prefix_trie,
    spotsigs,
    substrings,
    token_counts,
    toxicity,
    url_filter,
    warc,
)

QUERIES = {
    "op1_spotsigs": spotsigs.op1_spotsigs,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_warc_revisits": warc.op5_warc_revisits,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_language": language.op8_language,
    "op10_substring_dedup": substrings.op10_substring_dedup,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_chat_windows": chat_windows.op12_chat_windows,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLE = {
    "op1_spotsigs": spotsigs.ORACLE_OP1,
    "op4_url_filter": url_filter.ORACLE_OP4,
    "op5_warc_revisits": warc.ORACLE_OP5,
    "op6_ngram_join": ngram_join.ORACLE_OP6,
    "op10_substring_dedup": substrings.ORACLE_OP10,
    "op9_decontaminate": decontaminate.ORACLE_OP9,
    "op12_chat_windows": chat_windows.ORACLE_OP12,
    "op13_prefix_trie": prefix_trie.ORACLE_OP13,
}
