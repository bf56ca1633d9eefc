"""Medallion operators: dedup, quarantine, silver, gold, profile, audit, guard, reports."""
