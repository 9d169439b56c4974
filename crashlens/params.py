"""Report parameters, kept in one frozen dataclass.

Everything that the original job hard-coded (sample bucket, channel, app, date
floors, report weekdays, crash thresholds) is a field here, so that tests and
backfills can pin ``today`` instead of reading the wall clock.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

EPOCH = _dt.date(1970, 1, 1)


def date_to_epoch_day(d: _dt.date) -> int:
    return (d - EPOCH).days


# Fixed values that must equal the original report's definitions.
SAMPLE_ID = "42"                      # the 1% sample bucket
SAMPLE_PERCENT = 1.0                  # share of the population the bucket represents
CHANNEL = "release"
APP_NAME = "Firefox"
SUBMISSION_FLOOR = "20160701"         # pings submitted before this are dropped (yyyyMMdd text)
PROFILE_CREATION_FLOOR = _dt.date(2010, 1, 1)
MAX_SESSION_SECONDS = 86400
DEFAULT_LAST_REPORT = _dt.date(2016, 9, 1)  # backfill starts the day after this
REPORT_WEEKDAYS = (0, 1, 2, 3, 4)     # Monday..Friday (Monday = 0)
WINDOW_DAYS = 7                       # a report covers [end - 6, end]
CRASH_THRESHOLDS = (1, 2)             # always reported
COHORT_LAG_DAYS = 14                  # cohort = profiles created in the window shifted back 14 days
COHORT_SPAN_DAYS = 14                 # first two weeks of a profile: pcd .. pcd + 13
SECOND_WEEK_START = 7                 # second week starts at pcd + 7
PER_HOURS = 1000.0                    # crash rates are reported per 1000 hours
RELEASE_LOOKBACK_MONTHS = 12          # chart markers: releases of the last year


@dataclass(frozen=True)
class ReportParams:
    sample_id: str = SAMPLE_ID
    sample_percent: float = SAMPLE_PERCENT
    channel: str = CHANNEL
    app_name: str = APP_NAME
    submission_floor: str = SUBMISSION_FLOOR
    profile_creation_floor: _dt.date = PROFILE_CREATION_FLOOR
    max_session_seconds: int = MAX_SESSION_SECONDS
    today: _dt.date = field(default_factory=_dt.date.today)
    default_last_report: _dt.date = DEFAULT_LAST_REPORT
    report_weekdays: tuple[int, ...] = REPORT_WEEKDAYS
    window_days: int = WINDOW_DAYS
    crash_thresholds: tuple[int, ...] = CRASH_THRESHOLDS
    cohort_lag_days: int = COHORT_LAG_DAYS
    cohort_span_days: int = COHORT_SPAN_DAYS
    second_week_start: int = SECOND_WEEK_START
    # D3: True = a report only sees history up to its end date (stable under backfill);
    # False = every report sees the profile's entire history, later days included.
    history_bounded: bool = True

    @property
    def thresholds(self) -> tuple[int, ...]:
        """Requested thresholds plus 1 and 2, deduplicated and sorted."""
        return tuple(sorted(set(CRASH_THRESHOLDS) | set(self.crash_thresholds)))

    @property
    def pcd_floor(self) -> int:
        return date_to_epoch_day(self.profile_creation_floor)

    @property
    def pcd_ceiling(self) -> int:
        return date_to_epoch_day(self.today)

    @property
    def last_report(self) -> _dt.date:
        """Reports run up to yesterday."""
        return self.today - _dt.timedelta(days=1)

    @property
    def population_factor(self) -> float:
        return 100.0 / self.sample_percent

    def first_report(self, last_published: _dt.date | None = None) -> _dt.date:
        last = last_published or self.default_last_report
        return last + _dt.timedelta(days=1)

    def with_(self, **kw) -> "ReportParams":
        return replace(self, **kw)


def fixture_params(**overrides) -> ReportParams:
    """Parameters of the test fixture (FIXTURES.md): 30 days of January 2024,
    reports on the weekdays 2024-01-08 .. 2024-01-30."""
    base = ReportParams(
        today=_dt.date(2024, 1, 31),
        default_last_report=_dt.date(2024, 1, 7),
    )
    return replace(base, **overrides)
