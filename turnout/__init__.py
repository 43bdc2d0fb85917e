"""Spark-native turnout analytics.

Ballots arrive as change-data-capture envelopes; they are decoded into
feature rows, counted per area and minute, rolled up over a two-level
area hierarchy (``area_l1`` contains ``area_l2``), turned into turnout
percentages against registered-voter dimensions, forecast per area and
published as chart-ready rows.  Every step is a DataFrame transformation;
nothing is collected to the driver.
"""

__all__ = ["session", "constants"]
