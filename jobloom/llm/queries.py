"""The dealt operators as registered queries, and their SQL where SQL can express them."""

from __future__ import annotations

from . import bbit_minhash, block_naming, conversation_repair, credentials, cutting_stock, gear_chunks, mixing, one_permutation, periodic_runs, token_combinations, url_automaton, warc, weak_labels

REGISTRY = {
    "op1_warc": warc.op1_warc,
    "op2_credentials": credentials.op2_credentials,
    "op3_gear_chunks": gear_chunks.op3_gear_chunks,
    "op4_weak_labels": weak_labels.op4_weak_labels,
    "op5_one_permutation": one_permutation.op5_one_permutation,
    "op6_block_naming": block_naming.op6_block_naming,
    "op7_url_automaton": url_automaton.op7_url_automaton,
    "op8_cutting_stock": cutting_stock.op8_cutting_stock,
    "op9_token_combinations": token_combinations.op9_token_combinations,
    "op10_mixing": mixing.op10_mixing,
    "op11_bbit_minhash": bbit_minhash.op11_bbit_minhash,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLE = {
    "op1_warc": warc.SQL,
    "op6_block_naming": block_naming.SQL,
    "op7_url_automaton": url_automaton.SQL,
    "op9_token_combinations": token_combinations.SQL,
    "op10_mixing": mixing.SQL,
    "op11_bbit_minhash": bbit_minhash.SQL,
    "op12_periodic_runs": periodic_runs.SQL,
    "op13_conversation_repair": conversation_repair.SQL,
}
