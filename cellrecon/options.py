"""Options of a typed table read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from enum import Enum

ALL_VERSIONS = None


class Restrictive(Enum):
    """Which cells a read fetches, and so which keys give a row."""

    NONE = "NONE"
    FAMILY = "FAMILY"
    COLUMN = "COLUMN"


@dataclass(frozen=True)
class ReadOptions:
    """How a typed read selects cells.

    ``timestamp`` reads one exact version time; ``min_ts``/``max_ts`` a half-open range, both or
    neither. ``max_versions`` keeps the newest N versions of a cell (``ALL_VERSIONS`` for all).
    ``merge_to_latest`` gives one row per key, otherwise one per key and version time.
    """

    timestamp: int | None = None
    min_ts: int | None = None
    max_ts: int | None = None
    max_versions: int | None = 1
    merge_to_latest: bool = True
    restrictive: Restrictive = Restrictive.COLUMN

    def __post_init__(self) -> None:
        if (self.min_ts is None) != (self.max_ts is None):
            raise ValueError("a time range needs both a minimum and a maximum")
        if self.timestamp is not None and self.min_ts is not None:
            raise ValueError("an exact timestamp and a time range exclude each other")
        if self.max_versions is not None and self.max_versions < 1:
            raise ValueError("at least one version has to be kept")

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> ReadOptions:
        """Read options given as text under their customary names; other names are not looked at."""

        def number(name: str, default: int | None = None) -> int | None:
            return int(options[name]) if name in options else default

        return cls(
            timestamp=number("timestamp"),
            min_ts=number("minStamp"),
            max_ts=number("maxStamp"),
            max_versions=number("maxVersions", 1),
            merge_to_latest=_flag(options.get("mergeToLatest", "true")),
            restrictive=Restrictive(options.get("restrictive", "COLUMN")),
        )


def _flag(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise ValueError(f"mergeToLatest is true or false, not {text!r}")
    return text.lower() == "true"
