"""Argument checks shared by the operators. Each raises ``ValueError`` naming
the argument, the rule it breaks and the value given."""

from __future__ import annotations

from collections.abc import Collection, Iterable


def _fail(name: str, rule: str, value) -> None:
    raise ValueError(f"{name}: {rule} (given: {value!r})")


def some(name: str, values: Collection) -> None:
    if not values:
        _fail(name, "needs an entry", values)


def at_least(name: str, value, low) -> None:
    if value is None or value < low:
        _fail(name, f"is below {low}", value)


def all_at_least(name: str, values: Iterable, low) -> None:
    values = list(values)
    if any(v < low for v in values):
        _fail(name, f"has entries below {low}", values)


def between(name: str, value, low, high) -> None:
    """``low < value < high``."""
    if not low < value < high:
        _fail(name, f"lies outside ]{low}, {high}[", value)


def among(name: str, values: Iterable, known: Iterable) -> None:
    known = list(known)
    other = [v for v in values if v not in known]
    if other:
        _fail(name, f"knows only {known}", other)


def rising(name: str, *values) -> None:
    if any(not a < b for a, b in zip(values, values[1:])):
        _fail(name, "is not in rising order", values)
