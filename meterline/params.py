"""Parameters of the pipeline: thresholds, priority and movement maps.

All of these are arguments of the operators; the defaults are the values
the telemetry pipeline uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values (must equal the pipeline being matched) -------------------
# Sessionization priority of event types on equal timestamps.
SESSION_PRIORITY = {
    "t": 1, "game_changed": 2, "n": 3, "c": 4, "pss": 5, "w": 6,
    "x": 7, "y": 8, "o": 9, "pse": 10, "v": 11,
}
SESSION_PRIORITY_DEFAULT = 100

# Priority used by the quality-rule stage.
SEGREGATION_PRIORITY = {
    "t": 1, "game_changed": 2, "n": 3, "c": 4, "w": 5, "x": 6, "y": 7,
    "o": 8, "v": 9,
}
SEGREGATION_PRIORITY_DEFAULT = 10

# Priority used by the gaps-and-islands query.
ISLAND_PRIORITY = {
    "game_changed": 0, "n": 1, "c": 2, "t": 3, "w": 4, "o": 5, "x": 6, "y": 7,
}
ISLAND_PRIORITY_DEFAULT = 8

# Start/end pairing priorities.
WAGER_PAIR_PRIORITY = {"w": 1, "o": 2}
SECONDARY_PAIR_PRIORITY = {"x": 1, "y": 2}

# Event types kept by the quality-rule stage.
CHECKED_TYPES = ("c", "t", "n", "w", "o", "x", "y", "v", "pss", "pse")
# First event of a valid session must be one of these.
CASH_IN_FIRST_TYPES = ("t", "n", "c")

# Balance movement per event type: sign of tran_amt and whether payout adds.
# t: +amount; w, x: payout - amount; v: -amount; others: no movement.
MOVEMENT = {"t": (1, False), "w": (-1, True), "x": (-1, True), "v": (-1, False)}

# Error labels written to the violations table.
LABEL_NEGATIVE_AMOUNT = "negative_amount"
LABEL_SESSION_LENGTH = "SessionLength"
LABEL_CASHIN_POSITION = "cashin_position"
LABEL_BRACKET = "stm_pss_pse_no_w_records"
LABEL_INTENSITY = "no_valid_wager_pairs_found_in_session_to_calculate_intensity"
LABEL_RESIDUAL = "ResidualCredits"
LABEL_MORE_CASHOUTS = "more_cashouts"
LABEL_CREDITMETER = "creditmeter"

SESSION_TS_FORMAT = "yyyyMMddHHmmss"
DEFAULT_GAP_SECONDS = 3 * 60
DEFAULT_CREDIT_FLOOR = 50000
ISLAND_GAP_SECONDS = 120
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SessionParams:
    """Thresholds and maps of the sessionizer."""

    gap_seconds: int = DEFAULT_GAP_SECONDS
    credit_floor: float = DEFAULT_CREDIT_FLOOR
    cash_out_types: tuple = ("v",)
    cash_in_types: tuple = ("t",)
    priority: dict = field(default_factory=lambda: dict(SESSION_PRIORITY))
    priority_default: int = SESSION_PRIORITY_DEFAULT
    ts_format: str = SESSION_TS_FORMAT


# Entity key of the event log: one machine of one tenant in one batch.
ENTITY = ("customer", "batch_id", "egm_id")
# Session key: NULL sessions (rows before the first start) stay per machine.
SESSION_KEY = ("customer", "batch_id", "egm_id", "session_id")
