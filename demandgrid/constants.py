"""Column conventions and fixed parameter values.

Everything here is a parameter default; every operator takes the column
names and values as arguments so other panels can reuse it.
"""

from __future__ import annotations

import datetime as _dt

# Column conventions of the panel (date, entity, target).
DATE_COL = "shipment_date"
ENTITY_COL = "entity"
TARGET_COL = "n_shipments"

# ---------------------------------------------------------------------------
# Fixed values that must match the reference behaviour.
# ---------------------------------------------------------------------------
# Multiplicative adjustment grid for the cost-aware search (18 points).
ALPHA_GRID: tuple[float, ...] = (
    -0.20, -0.15, -0.10, -0.05, 0.0, 0.05, 0.10, 0.15, 0.20,
    0.25, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90, 1.00,
)
# Under-prediction cost per unit for a fixed over-prediction cost of 1.
COST_RATIOS: tuple[float, ...] = (1.0, 2.0, 3.0, 5.0)
# Scoring defaults for the cost-aware recommendation.
DEFAULT_ALPHA = 0.65
DEFAULT_COST_RATIO = 3.0
# Request limits for batch scoring.
MAX_WINDOW_DAYS = 90
ALPHA_RANGE = (-2.0, 2.0)
COST_RATIO_RANGE = (0.5, 10.0)
# Naive interval half-width in residual standard deviations.
NAIVE_INTERVAL_WIDTH = 1.28
# Volume tier thresholds: mean < first -> tail, mean >= second -> core.
DEFAULT_TIER_THRESHOLDS = (2.0, 10.0)
VOLUME_TIERS = ("tail", "mid", "core")
# Day-type labels in their fixed category order.
DAY_TYPES = ("business_day", "saturday", "sunday", "holiday")
# Fixed-date national holidays as (month, day); movable ones derive from Easter.
FIXED_HOLIDAYS: tuple[tuple[int, int], ...] = (
    (1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25),
)
# Holiday added to the fixed list from this year on: (year, month, day).
LATER_FIXED_HOLIDAYS: tuple[tuple[int, int, int], ...] = ((2024, 11, 20),)
# Easter-relative holidays, in days: Good Friday, Carnival Monday/Tuesday,
# Corpus Christi.
EASTER_OFFSETS: tuple[int, ...] = (-2, -48, -47, 60)
# Valentine's day of the events calendar: June 12.
VALENTINE_MONTH_DAY = (6, 12)
# Trend anchor default.
TREND_REFERENCE_DATE = _dt.date(2017, 1, 1)

# ---------------------------------------------------------------------------
# Parameters of the driver's TPC-H-like tables (dates 1995-01-02..2001-11-04).
# ---------------------------------------------------------------------------
# Shipment definition: order status values that count as shipped.
SHIPPED_STATUSES: tuple[str, ...] = ("F", "O")
# Expanding-window folds: (fold_id, train_end, test_start, test_end, label).
FOLD_SPEC: tuple[tuple[int, _dt.date, _dt.date, _dt.date, str], ...] = (
    (1, _dt.date(2000, 6, 30), _dt.date(2000, 7, 1), _dt.date(2000, 9, 30), "fold 1: Q3 2000"),
    (2, _dt.date(2000, 9, 30), _dt.date(2000, 10, 1), _dt.date(2000, 12, 31), "fold 2: Q4 2000, Black Friday"),
    (3, _dt.date(2000, 12, 31), _dt.date(2001, 1, 1), _dt.date(2001, 3, 31), "fold 3: Q1 2001"),
    (4, _dt.date(2001, 3, 31), _dt.date(2001, 4, 1), _dt.date(2001, 6, 30), "fold 4: Q2 2001, Valentine"),
)
# Named event windows (Black Friday 2000 and June 12 2001, +/- 7 days).
EVENT_WINDOWS: tuple[tuple[str, _dt.date, _dt.date], ...] = (
    ("black_friday_2000", _dt.date(2000, 11, 17), _dt.date(2000, 12, 1)),
    ("valentine_2001", _dt.date(2001, 6, 5), _dt.date(2001, 6, 19)),
)
# Event days of the per-event error table (+/- 7 days each).
EVENT_DAYS: dict[str, _dt.date] = {
    "black_friday": _dt.date(2000, 11, 24), "christmas": _dt.date(2000, 12, 25), "valentine": _dt.date(2001, 6, 12),
}
# Calibration lengths for the interval-coverage study.
CALIBRATION_LENGTHS: tuple[int, ...] = (30, 45, 60, 90, 120)
# Fast retrain (fixed values of the original workflow): the last 180 days
# and a small boosted-tree model (50 trees, about 15 leaves, rate 0.1, at
# least 20 rows per leaf).
FAST_RETRAIN_DAYS = 180
FAST_RETRAIN_TREES = 50
FAST_RETRAIN_DEPTH = 4
FAST_RETRAIN_RATE = 0.1
FAST_RETRAIN_MIN_LEAF = 20
