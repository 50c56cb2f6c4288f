"""Window lengths such as 1h, 5m, 1h30m or 3mo, and the windows they make on a time column."""

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Microseconds per unit of fixed length, and months per calendar unit.
MICROS = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
    "w": 604_800_000_000,
}
MONTHS = {"mo": 1, "y": 12}

_PART = re.compile(r"(\d+)(mo|ms|us|µs|[smhdwy])")


@dataclass(frozen=True)
class Duration:
    micros: int = 0
    months: int = 0


def parse_duration(text: str) -> Duration:
    parts = _PART.findall(text)
    if not parts or "".join(n + u for n, u in parts) != text:
        raise ValueError(f"not a duration: {text!r}")
    parts = [(int(n), u.replace("µ", "u")) for n, u in parts]
    length = Duration(
        sum(n * MICROS[u] for n, u in parts if u in MICROS), sum(n * MONTHS[u] for n, u in parts if u in MONTHS)
    )
    if bool(length.micros) == bool(length.months):
        raise ValueError(f"a window is a positive length of either fixed or calendar units: {text!r}")
    return length


def window_bounds(time: str, length: Duration) -> tuple[Column, Column]:
    """Start and end of the window, counted from 1970-01-01, that `time` falls into."""
    if length.micros:
        w = F.window(time, f"{length.micros} microseconds")
        return w["start"], w["end"]
    epoch = F.lit("1970-01-01").cast("date")
    months = (F.year(time) - 1970) * 12 + F.month(time) - 1
    first = (F.floor(months / length.months) * length.months).cast("int")
    return F.add_months(epoch, first), F.add_months(epoch, first + length.months)
