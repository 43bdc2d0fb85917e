"""Inputs: driver tables, proof views derived from them, CDC logs, dimensions, history files."""
