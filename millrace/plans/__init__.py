"""Whole transforms: rule sets, silver and gold tables, the full run."""
