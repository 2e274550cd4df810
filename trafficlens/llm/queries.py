"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from trafficlens.llm import (
    benchmark_leaks,
    hard_negatives,
    mixing,
    one_bit,
    order_minhash,
    personal_data,
    repeats,
    rule_ensemble,
    token_counts,
    toxicity,
    url_rules,
    whitening,
    wrappers,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_quality": rule_ensemble.op2_quality,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_substring_dedup": repeats.op4_substring_dedup,
    "op5_benchmark_leaks": benchmark_leaks.op5_benchmark_leaks,
    "op6_url_filters": url_rules.op6_url_filters,
    "op7_html_extraction": wrappers.op7_html_extraction,
    "op8_one_bit_neighbours": one_bit.op8_one_bit_neighbours,
    "op9_order_minhash": order_minhash.op9_order_minhash,
    "op10_mixing": mixing.op10_mixing,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_personal_data": personal_data.op12_personal_data,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {
    "op4_substring_dedup": repeats.ORACLE,
    "op6_url_filters": url_rules.ORACLE,
    "op8_one_bit_neighbours": one_bit.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
}
