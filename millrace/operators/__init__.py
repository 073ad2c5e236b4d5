"""Reusable DataFrame operators: dedup, reference joins, quarantine, profile, checks."""
