"""Every operator of this package as a query over the given tables, and the same in SQL."""

from __future__ import annotations

from cohortgraph.llm.bloom_sketch import op5_bloom_sketch
from cohortgraph.llm.chat_format import OP13_SQL, op13_chat_format
from cohortgraph.llm.crf import op10_crf
from cohortgraph.llm.filter_audit import OP12_SQL, op12_filter_audit
from cohortgraph.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from cohortgraph.llm.line_blocks import op3_line_blocks
from cohortgraph.llm.lines import op7_lines
from cohortgraph.llm.minhash import OP4_SQL, op4_minhash
from cohortgraph.llm.mixing import OP8_SQL, op8_mixing
from cohortgraph.llm.packing import op1_packing
from cohortgraph.llm.pitman_yor import op2_pitman_yor
from cohortgraph.llm.quality_rules import OP6_SQL, op6_quality_rules
from cohortgraph.llm.rule_ensemble import op9_rule_ensemble

QUERIES = {
    "op1_packing": op1_packing,
    "op2_pitman_yor": op2_pitman_yor,
    "op3_line_blocks": op3_line_blocks,
    "op4_minhash": op4_minhash,
    "op5_bloom_sketch": op5_bloom_sketch,
    "op6_quality_rules": op6_quality_rules,
    "op7_lines": op7_lines,
    "op8_mixing": op8_mixing,
    "op9_rule_ensemble": op9_rule_ensemble,
    "op10_crf": op10_crf,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_chat_format": op13_chat_format,
}

ORACLE_SQL = {
    "op4_minhash": OP4_SQL,
    "op6_quality_rules": OP6_SQL,
    "op8_mixing": OP8_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_chat_format": OP13_SQL,
}
