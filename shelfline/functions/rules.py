"""Business rules: tiers, flags and stock status as Column expressions.

Fixed values: the thresholds and labels below must equal the source
system's for the segments to agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .time import local_time

# Fixed values: (minimum, label) tiers, checked from the top; below the last
# minimum the default label applies.
VALUE_SEGMENTS = [(500, "HIGH_VALUE"), (200, "MEDIUM_VALUE"), (50, "REGULAR_VALUE")]
VALUE_DEFAULT = "LOW_VALUE"
FREQUENCY_SEGMENTS = [(5, "FREQUENT_BUYER"), (3, "REGULAR_BUYER")]
FREQUENCY_DEFAULT = "OCCASIONAL_BUYER"
SHOPPING_SEGMENTS = [(5, "CROSS_SHOPPER"), (3, "MULTI_CATEGORY")]
SHOPPING_DEFAULT = "FOCUSED_SHOPPER"
VELOCITY_TIERS = [(20, "HIGH_VELOCITY"), (10, "MEDIUM_VELOCITY"), (5, "NORMAL_VELOCITY")]
VELOCITY_DEFAULT = "LOW_VELOCITY"
ALERT_TIERS = [(20, "URGENT_RESTOCK"), (10, "MONITOR_STOCK")]
ALERT_DEFAULT = "NO_ACTION"
ALERT_KEEP = ("URGENT_RESTOCK", "MONITOR_STOCK")

# Opening hours (both ends inclusive) and busy hours.
WEEKDAY_HOURS = (6, 22)
WEEKEND_HOURS = (8, 23)
RUSH_HOURS = [(11, 13), (17, 19)]
EVENING_HOURS = (20, 22)

# Stock status labels.
OUT_OF_STOCK, LOW_STOCK, NORMAL_STOCK = "OUT_OF_STOCK", "LOW_STOCK", "NORMAL"


def tiered(value: Column, tiers, default: str) -> Column:
    """First tier whose minimum ``value`` reaches wins; NULL gets ``default``
    (a searched CASE sends NULL comparisons to ELSE)."""
    expr = None
    for minimum, label in tiers:
        cond = value >= F.lit(minimum)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def count_where(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` (a BIGINT, 0 when nothing
    matches within a non-empty group)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def stock_status(current_stock: Column, reorder_point: Column) -> Column:
    return (F.when(current_stock <= 0, OUT_OF_STOCK)
            .when(current_stock <= reorder_point, LOW_STOCK)
            .otherwise(NORMAL_STOCK))


def business_hours(ts: Column | str, tz: str = "UTC") -> Column:
    """True inside opening hours: Mon-Fri 6..22, Sat-Sun 8..23 (inclusive)."""
    t = local_time(ts, tz)
    h = F.hour(t)
    weekend = F.weekday(t) >= 5
    return (F.when(weekend, h.between(*WEEKEND_HOURS))
            .otherwise(h.between(*WEEKDAY_HOURS)))


def daypart(ts: Column | str, tz: str = "UTC") -> Column:
    """RUSH at lunch and dinner hours, EVENING late, NORMAL otherwise."""
    h = F.hour(local_time(ts, tz))
    rush = None
    for lo, hi in RUSH_HOURS:
        c = h.between(lo, hi)
        rush = c if rush is None else (rush | c)
    return (F.when(rush, "RUSH")
            .when(h.between(*EVENING_HOURS), "EVENING")
            .otherwise("NORMAL"))
