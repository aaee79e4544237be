"""Batch operators: series windows (hot-key safe), detectors, aggregates,
top-k reads, quality checks, scaling, injection, splits, evaluation,
exact percentiles, drift and alert rules.  All are DataFrame -> DataFrame."""
