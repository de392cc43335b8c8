"""Trigger texts."""

from __future__ import annotations

import re

# Fixed value: the trigger used when none is given.
DEFAULT_TRIGGER = "5 seconds"

_INTERVAL = re.compile(r"\d+ (second|minute|hour|day|millisecond)s?")


def parse_trigger(text: str = DEFAULT_TRIGGER) -> dict[str, bool | str]:
    """Keyword arguments for ``DataStreamWriter.trigger``.

    Accepts ``once``, ``availableNow``, an interval such as ``5 seconds`` or
    ``1 minute``, and ``processingTime=<interval>``. ``once`` reads all that is
    available, in several batches if rate limits say so.
    """
    spelled = text.strip().lower()
    if spelled in ("once", "availablenow"):
        return {"availableNow": True}
    if spelled.startswith("processingtime"):
        spelled = spelled.partition("=")[2].strip()
    if not _INTERVAL.fullmatch(spelled):
        raise ValueError(f"unknown trigger {text!r}")
    return {"processingTime": spelled}
