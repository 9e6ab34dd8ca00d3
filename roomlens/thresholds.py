"""Alert and ranking thresholds; the defaults are the published values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # Detectors.
    zero_purchase_min_views: int = 500
    zero_purchase_critical_views: int = 2000
    zero_purchase_high_views: int = 1000
    lost_sale_rate: float = 0.005
    min_views_for_analysis: int = 100
    cvr_z_alert: float = -2.0
    cvr_z_critical: float = -3.0
    cvr_z_high: float = -2.5
    cvr_drop_pct: float = 20.0
    drop_critical_pct: float = -40.0
    drop_high_pct: float = -30.0
    underperform_pct: float = -20.0
    rolling_days: int = 7
    rolling_min_days: int = 3
    # Views and statistics.
    brand_min_views: int = 100
    gap_view_min_views: int = 500
    gap_view_highlight: int = 1000
    room_min_views: int = 100
    gap_min_views: int = 100
    gap_z: float = -1.0
    gap_severe_z: float = -3.0
    gap_order_value: float = 220.35
    benchmark_rate: float = 0.02
    significance: float = 0.05


DEFAULTS = Thresholds()
