from millrace.operators.cleaning import clean_edits, clean_events, fill_unknown, flatten, keep_value
from millrace.operators.masking import create_masked_view, is_in_group, mask_events, masked
from millrace.operators.quality import (
    EDIT_RULES,
    EVENT_RULES,
    EVENT_WARNINGS,
    gate,
    observed,
    quarantine_metrics,
    reject,
    rule_metrics,
    with_failures,
)

__all__ = [
    "EDIT_RULES",
    "EVENT_RULES",
    "EVENT_WARNINGS",
    "clean_edits",
    "clean_events",
    "create_masked_view",
    "fill_unknown",
    "flatten",
    "gate",
    "is_in_group",
    "keep_value",
    "mask_events",
    "masked",
    "observed",
    "quarantine_metrics",
    "reject",
    "rule_metrics",
    "with_failures",
]
