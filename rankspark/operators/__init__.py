"""Relational operators: statistics, scores, tables, listings and checks."""
