"""Argument rules of the read queries."""

from __future__ import annotations

from tallystar.errors import ArgumentError

MONTHS = (1, 12)


def within(name: str, value, low, high=None):
    """The value itself, or an error; None means "not given" and passes."""
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise ArgumentError(f"{name} has to be a number, got {value!r}")
    if value < low or (high is not None and value > high):
        raise ArgumentError(f"{name} has to be within {low}..{'' if high is None else high}, got {value}")
    return value


def whole(name: str, value, low, high=None):
    if value is not None and (isinstance(value, bool) or not isinstance(value, int)):
        raise ArgumentError(f"{name} has to be a whole number, got {value!r}")
    return within(name, value, low, high)


def required(name: str, value):
    if value is None:
        raise ArgumentError(f"{name} is required")
    return value


def year(name: str, value, bounds: tuple[int, int]):
    return whole(name, value, *bounds)


def month(value):
    return whole("month", value, *MONTHS)


def state_code(value: str | None, length: int | None) -> str | None:
    """State codes are upper-cased and of fixed length; a feed without codes passes names through."""
    if value is None or length is None:
        return value
    if len(value) != length:
        raise ArgumentError(f"state has to have {length} characters, got {value!r}")
    return value.upper()


def one_of(name: str, value, allowed):
    if value not in allowed:
        raise ArgumentError(f"{name} has to be one of {sorted(allowed)}, got {value!r}")
    return value
