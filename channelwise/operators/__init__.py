"""Reusable DataFrame operators: dedupe, distributed ranking, quality checks, validation."""
