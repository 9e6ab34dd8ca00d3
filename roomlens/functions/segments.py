"""Price bands and severity tiers, as SQL text."""

from __future__ import annotations

# Upper bounds (exclusive) of the price bands.
EVENT_BANDS = (("Budget", 100.0), ("Mid-Range", 300.0), ("Premium", 700.0))
CATALOGUE_BANDS = (("Budget", 30.0), ("Mid-Range", 80.0), ("Premium", 150.0))


def price_band(price: str, bands: tuple[tuple[str, float], ...]) -> str:
    """Null or zero price is Unknown; anything at or above the last bound is Luxury."""
    steps = " ".join(f"WHEN {price} < {bound}D THEN '{name}'" for name, bound in bands)
    return f"CASE WHEN {price} IS NULL OR {price} = 0 THEN 'Unknown' {steps} ELSE 'Luxury' END"


def severity(value: str, operator: str, critical: float, high: float) -> str:
    return (
        f"CASE WHEN {value} {operator} {critical} THEN 'CRITICAL' "
        f"WHEN {value} {operator} {high} THEN 'HIGH' ELSE 'MEDIUM' END"
    )
