"""Registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from vecloom.llm import (
    conversation_trie, decontaminate, langid, license_scan, merkle, mixing, near_dedup, secret_scan, sharding, substring_dedup, token_records,
    topk_search, warc,
)
from vecloom.llm.staging import in_small_batches

_QUERIES = {
    "op1_suffix_decontamination": decontaminate.op1_suffix_decontamination,
    "op2_crf_secret_scan": secret_scan.op2_crf_secret_scan,
    "op3_warc_chain": warc.op3_warc_chain,
    "op4_external_shuffle": sharding.op4_external_shuffle,
    "op5_bottom_k_near_dedup": near_dedup.op5_bottom_k_near_dedup,
    "op6_marginal_language_id": langid.op6_marginal_language_id,
    "op7_term_at_a_time": topk_search.op7_term_at_a_time,
    "op8_token_records": token_records.op8_token_records,
    "op9_pareto_mix": mixing.op9_pareto_mix,
    "op10_fm_substring_dedup": substring_dedup.op10_fm_substring_dedup,
    "op11_suffix_automaton_licenses": license_scan.op11_suffix_automaton_licenses,
    "op12_double_array_trie": conversation_trie.op12_double_array_trie,
    "op13_merkle_climb": merkle.op13_merkle_climb,
}
QUERIES = {name: in_small_batches(query) for name, query in _QUERIES.items()}
ORACLES = {
    "op1_suffix_decontamination": decontaminate.ORACLE_SQL,
    "op3_warc_chain": warc.ORACLE_SQL,
    "op5_bottom_k_near_dedup": near_dedup.ORACLE_SQL,
    "op7_term_at_a_time": topk_search.ORACLE_SQL,
    "op9_pareto_mix": mixing.ORACLE_SQL,
    "op10_fm_substring_dedup": substring_dedup.ORACLE_SQL,
    "op12_double_array_trie": conversation_trie.ORACLE_SQL,
    "op13_merkle_climb": merkle.ORACLE_SQL,
}
