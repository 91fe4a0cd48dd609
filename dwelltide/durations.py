"""Durations as milliseconds, the unit of event time here."""

from __future__ import annotations

import re

UNIT_MS = {
    "millisecond": 1,
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
    "week": 604_800_000,
}


def duration_ms(value: int | str) -> int:
    """``"180 days"`` or a number of milliseconds; more than one part may follow."""
    if isinstance(value, int):
        parts_ms = value
    else:
        parts = re.findall(r"(\d+)\s*([a-z]+)", value.lower())
        if not parts or re.sub(r"(\d+)\s*([a-z]+)", "", value.lower()).strip(" ,"):
            raise ValueError(f"not a duration: {value!r}")
        try:
            parts_ms = sum(int(n) * UNIT_MS[unit.removesuffix("s")] for n, unit in parts)
        except KeyError as error:
            raise ValueError(f"unknown unit in {value!r}") from error
    if parts_ms <= 0:
        raise ValueError(f"a duration must be positive: {value!r}")
    return parts_ms


def interval(value: int | str) -> str:
    """The same duration as text that Spark's watermark and session window take."""
    return f"{duration_ms(value)} milliseconds"
