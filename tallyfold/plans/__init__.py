"""Compositions of the operators: intake, load, geographies, quality tables, cleaning of one frame."""
