from winback.functions.elapsed import moment, whole_days
from winback.functions.hashing import id_hash
from winback.functions.missing import known_number, known_text, ratio, safe_timestamp
from winback.functions.risk import impact_direction, logistic, risk_tier, tier_action, tier_strategy

__all__ = [
    "id_hash",
    "impact_direction",
    "known_number",
    "known_text",
    "logistic",
    "moment",
    "ratio",
    "risk_tier",
    "safe_timestamp",
    "tier_action",
    "tier_strategy",
    "whole_days",
]
