"""Query plans built from sources, functions and operators: summaries, reports, history, forecast."""
