"""Fixed values that results depend on; they must stay exactly as written for results to match."""

from __future__ import annotations

# (label, lo, hi) -- hi exclusive; None = open ended
LIVE_BINS = [
    ("col_1", 20, 30),
    ("col_2", 31, 40),
    ("col_3", 41, 50),
    ("col_4", 51, 60),
    ("col_5", 61, 70),
    ("col_6", 71, 80),
    ("col_7", 81, 90),
]

HISTORY_BINS = [
    ("col_1", 20, 30),
    ("col_2", 30, 40),
    ("col_3", 40, 50),
    ("col_4", 50, 60),
    ("col_5", 60, 70),
    ("col_6", 70, 80),
    ("col_7", 80, None),
]

# closed intervals [lo, hi]; None = open ended
SUMMARY_BINS = [
    ("age_21_30", 21, 30),
    ("age_31_40", 31, 40),
    ("age_41_50", 41, 50),
    ("age_51_60", 51, 60),
    ("age_61_70", 61, 70),
    ("age_71_p", 71, None),
]

# display labels of the summary intervals (chart keys)
SUMMARY_LABELS = ["Age_21_30", "Age_31_40", "Age_41_50", "Age_51_60", "Age_61_70", "Age_71_P"]

# forecast age classes after folding the two oldest live classes
FORECAST_AGE_LABELS = ["20-30", "30-40", "40-50", "50-60", "60-70", "70+"]

REG_YEARS = [2003, 2007, 2011, 2012, 2015, 2016, 2019, 2020, 2022, 2023]

COUNTERS = ["male", "female", "col_1", "col_2", "col_3", "col_4", "col_5", "col_6", "col_7"]
PREDICTION_COUNTERS = ["male", "female", "col_1", "col_2", "col_3", "col_4", "col_5", "col_6"]

POLL_START = "07:00"
POLL_END = "18:59"
POLL_FIRST_MINUTE = 7 * 60
POLL_LAST_MINUTE = 18 * 60 + 59

WINDOW_IN = 60
WINDOW_OUT = 60
IQR_FENCE = 1.5
TEST_FRACTION = 0.1

NATION_PICK_WEIGHTS = [0.1, 0.2, 0.2, 0.2, 0.1, 0.1, 0.05, 0.05]
FORECAST_PICK_WEIGHTS = [0.5, 0.5]

STATS = "stats"
FORECASTED = "forcasted"

LEVEL_NATION = "nation"
LEVEL_L1 = "l1"
LEVEL_L2 = "l2"
