"""Checks on SQL text that arrives from step specifications."""

from __future__ import annotations


def check_sql_text(text: str, what: str = "expression") -> str:
    """Reject comment markers and statement separators in configured SQL."""
    for mark, meaning in (("--", "a comment"), (";", "a second statement")):
        if mark in text:
            raise ValueError(f"{what} may not hold {meaning} ({mark!r}): {text}")
    return text
