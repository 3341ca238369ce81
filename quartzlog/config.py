"""Table properties, their defaults, and durations."""

from __future__ import annotations

import re
import time

from .errors import IllegalArgument

#: Property names and defaults. A name may carry the format's prefix; the prefixed form wins.
DEFAULTS = {"logRetentionDuration": "interval 30 days", "deletedFileRetentionDuration": "interval 1 week", "checkpointInterval": "10", "enableExpiredLogCleanup": "true", "appendOnly": "false"}
PREFIX = "delta."
PROTOCOL_KEYS = ("minReaderVersion", "minWriterVersion")
#: Nanoseconds of each unit.
UNITS = {"nanosecond": 1, "microsecond": 10**3, "millisecond": 10**6, "second": 10**9, "minute": 60 * 10**9, "hour": 3600 * 10**9, "day": 86400 * 10**9, "week": 7 * 86400 * 10**9}


def duration_ms(text: str) -> int:
    """Milliseconds of `interval <n> <unit>`; units from nanosecond to week, singular or plural."""
    m = re.fullmatch(r"\s*interval\s+(\d+)\s+([a-z]+?)s?\s*", text, re.IGNORECASE)
    if not m or m[2].lower() not in UNITS:
        raise IllegalArgument(f"not a duration: {text!r}")
    return int(m[1]) * UNITS[m[2].lower()] // 10**6


def get(configuration: dict, key: str) -> str:
    return configuration.get(PREFIX + key, configuration.get(key, DEFAULTS[key]))


def checkpoint_interval(configuration: dict) -> int:
    n = int(get(configuration, "checkpointInterval"))
    if n <= 0:
        raise IllegalArgument("checkpointInterval needs to be positive")
    return n


def tombstone_retention_ms(configuration: dict) -> int:
    return duration_ms(get(configuration, "deletedFileRetentionDuration"))


def append_only(configuration: dict) -> bool:
    return get(configuration, "appendOnly").lower() == "true"


def merged(defaults: dict, configuration: dict) -> dict:
    """Defaults of the session under the table's own values."""
    return {**defaults, **configuration}


class Clock:
    """The time, replaceable in tests."""

    def now_ms(self) -> int:
        return time.time_ns() // 10**6

    def wait_until(self, ms: int) -> int:
        while (now := self.now_ms()) < ms:
            time.sleep(min(0.05, (ms - now) / 1000))
        return now


class FixedClock(Clock):
    def __init__(self, ms: int):
        self.ms = ms

    def now_ms(self) -> int:
        return self.ms

    def wait_until(self, ms: int) -> int:
        self.ms = max(self.ms, ms)
        return self.ms
