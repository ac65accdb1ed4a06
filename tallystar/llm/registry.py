"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallystar.llm.op01_balanced_labels import op1_balanced_labels
from tallystar.llm.op02_license_scan import op2_license_scan
from tallystar.llm.op03_fuzzy_lines import op3_fuzzy_lines
from tallystar.llm.op04_suffix_index import op4_suffix_index
from tallystar.llm.op05_best_fit_packing import op5_best_fit_packing
from tallystar.llm.op06_weak_supervision import op6_weak_supervision
from tallystar.llm.op07_noisy_channel import op7_noisy_channel
from tallystar.llm.op08_quality_rules import op8_quality_rules
from tallystar.llm.op09_templates import op9_templates
from tallystar.llm.op10_signature_tree import op10_signature_tree
from tallystar.llm.op11_fill_in_middle import op11_fill_in_middle
from tallystar.llm.op12_event_chat import op12_event_chat
from tallystar.llm.op13_divergence_audit import op13_divergence_audit
from tallystar.llm.oracle import DIVERGENCE_AUDIT, EVENT_CHAT, FILL_IN_MIDDLE, JACCARD_COMPONENTS, REPEATED_PASSAGES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_balanced_labels": op1_balanced_labels,
    "op2_license_scan": op2_license_scan,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_suffix_index": op4_suffix_index,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_weak_supervision": op6_weak_supervision,
    "op7_noisy_channel": op7_noisy_channel,
    "op8_quality_rules": op8_quality_rules,
    "op9_templates": op9_templates,
    "op10_signature_tree": op10_signature_tree,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_event_chat": op12_event_chat,
    "op13_divergence_audit": op13_divergence_audit,
}

SQL: dict[str, str] = {
    "op4_suffix_index": REPEATED_PASSAGES,
    "op10_signature_tree": JACCARD_COMPONENTS,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_event_chat": EVENT_CHAT,
    "op13_divergence_audit": DIVERGENCE_AUDIT,
}
