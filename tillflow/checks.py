"""Argument checks, made before anything is planned."""

from __future__ import annotations


def at_least(name: str, value: int, lowest: int) -> int:
    """Return ``value`` or raise a ``ValueError`` that names the argument."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name} must be an integer, got {type(value).__name__}")
    if value < lowest:
        raise ValueError(f"{name} must be >= {lowest}, got {value}")
    return value


def positive(name: str, value: int) -> int:
    return at_least(name, value, 1)


def not_negative(name: str, value: int) -> int:
    return at_least(name, value, 0)


def one_of(name: str, value: str, allowed) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {sorted(allowed)}, got {value!r}")
    return value
