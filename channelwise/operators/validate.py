"""Argument checks for report parameters (the bound-parameter validation of an API)."""

from __future__ import annotations


def check_range(name: str, value: int, lo: int | None, hi: int | None) -> int:
    if not isinstance(value, int) or isinstance(value, bool):
        raise ValueError(f"{name} must be an integer, got {value!r}")
    if lo is not None and value < lo:
        raise ValueError(f"{name} must be >= {lo}, got {value}")
    if hi is not None and value > hi:
        raise ValueError(f"{name} must be <= {hi}, got {value}")
    return value


def check_choice(name: str, value: str, choices) -> str:
    if value not in choices:
        raise ValueError(f"Invalid {name} {value!r}. Valid options: {list(choices)}")
    return value


def check_text(name: str, value: str, min_length: int) -> str:
    if not isinstance(value, str) or len(value) < min_length:
        raise ValueError(f"{name} must be a string of at least {min_length} characters")
    return value
