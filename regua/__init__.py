"""Indicator pipelines on Spark: conform, check, compare with targets, report."""
