"""Thresholds, dates and codes every operator takes as arguments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Period:
    """A reporting period; both ends belong to it."""

    start: dt.date
    end: dt.date

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError(f"period starts {self.start} after it ends {self.end}")


@dataclass(frozen=True)
class GeographyCodes:
    """Codes of the reported unit, its comparators and the neighbours flagged beside it."""

    unit: str = "PHN206"
    national: str = "001NAT"
    peer_group: str = "003REG"
    neighbours: tuple[str, ...] = ("PHN204", "PHN205", "PHN206")
    unit_level: str = "PHN"
    group_level: str = "PHN group"
    national_level: str = "National"
    area_level: str = "SA3"
    peer_group_name: str = "Regional"


@dataclass(frozen=True)
class Params:
    extract_date: dt.date = dt.date(2026, 6, 30)
    stale_open_days: int = 180
    target_outcome_rate: float = 0.70
    target_followup_rate: float = 0.80
    target_wait_days: float = 14
    baseline_fy: int = 2018
    tolerance: float = 0.05
    required_national_fall_pct: float = 1.0
    reach_years: float = 1.5
    scorecard_start: dt.date = dt.date(2026, 1, 1)
    scorecard_end: dt.date | None = None  # the extract date unless given
    codes: GeographyCodes = field(default_factory=GeographyCodes)

    def __post_init__(self):
        for name in ("target_outcome_rate", "target_followup_rate"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in [0, 1]")
        if self.stale_open_days < 0 or self.target_wait_days < 0 or self.tolerance < 0:
            raise ValueError("day counts and the tolerance cannot be negative")
        if self.reach_years <= 0:
            raise ValueError("reach_years must be positive")
        self.scorecard  # the period has to be one

    @property
    def scorecard(self) -> Period:
        return Period(self.scorecard_start, self.scorecard_end or self.extract_date)
