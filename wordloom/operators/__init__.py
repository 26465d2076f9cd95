"""Operators on tables: cohorts, raters, selection, geometry, rules, lifecycle, integrity."""
