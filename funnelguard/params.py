"""Tunable parameters of the alert rules, bound into plans as literals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # --- Fixed values: rule constants whose defaults must equal the reference's ---
    cpa_mad_scaling_factor: float = 1.4826
    cpa_mad_threshold_multiplier: float = 2
    performance_decline_drop_factor: float = 0.9
    fb_to_clickout_drop_factor: float = 0.9
    clickout_to_conversion_factor: float = 0.90
    lp_abandonment_benchmark_factor: float = 1.03
    volume_drop_percentage: float = 0.2
    flow_interruption_automated_multiplier: float = 2.0
    flow_interruption_min_historical_gaps: int = 5
    min_spend_for_cpa_alert: float = 0
    min_spend_for_roi_alert: float = 0
    min_clicks_for_fb_to_clickout: int = 1
    min_clickouts_for_cr_alert: int = 1
    min_sessions_for_lp_abandonment: int = 1
    flow_max_relevant_gap_minutes: float = 720
    flow_min_dynamic_threshold_minutes: float = 5
    cpa_trim_low: float = 0.1
    cpa_trim_high: float = 0.9
    cpa_trim_accuracy: int = 1000
    # --- End of fixed values ---

    # Width of the time slices the conversion-gap lag is split into; a
    # slice is one sort task, the slices are stitched afterwards.
    gap_slice_seconds: int = 3600
    # 'null': a window with no rows on one side of a ratio yields NULL
    # (the reference's outer-join behaviour). 'zero': that side counts 0.
    missing: str = "null"
    # Include the as_of day itself in the highCPA same-weekday history.
    cpa_history_includes_today: bool = True
    # Average the same-hour volume over all 7 days (days without
    # conversions count as 0) instead of only over days that have rows.
    volume_avg_zero_fill: bool = False
    # How distinct click-out sessions are counted: 'rows' (one per campaign,
    # session and window, any id type) or 'bitmaps' (integer ids that are
    # dense within a campaign).
    distinct: str = "rows"

    def __post_init__(self) -> None:
        if self.missing not in ("null", "zero"):
            raise ValueError("missing must be 'null' or 'zero'")
        if self.distinct not in ("rows", "bitmaps"):
            raise ValueError("distinct must be 'rows' or 'bitmaps'")
        if self.gap_slice_seconds <= 0:
            raise ValueError("gap_slice_seconds must be positive")

    @property
    def volume_drop_factor(self) -> float:
        return 1 - self.volume_drop_percentage
