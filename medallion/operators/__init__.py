"""Reusable frame operators: joins, dedupe, aggregates, quality gates, search, enrichment."""
