"""Study parameters: the cutoff, population start and target window."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _ts(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


@dataclass(frozen=True)
class StudyWindow:
    """Time bounds of one inactivity study.

    * observation set: rows with ``date <= cutoff``
    * trailing windows: ``date >= cutoff - n days`` for each n in ``days``
      (both ends inclusive, so "7 days" spans 8 calendar days)
    * population: customers with a row in ``[pop_start, cutoff]``
    * label: 1 when a population member has no row in ``[target_lo, target_hi]``

    All bounds are compared as timestamps exactly as given; intraday rows
    after a midnight bound fall outside it.
    """

    cutoff: dt.datetime
    pop_start: dt.datetime
    target_lo: dt.datetime
    target_hi: dt.datetime
    days: tuple[int, ...] = field(default=(7, 30, 90))

    def __post_init__(self):
        for name in ("cutoff", "pop_start", "target_lo", "target_hi"):
            object.__setattr__(self, name, _ts(getattr(self, name)))
        object.__setattr__(self, "days", tuple(sorted(int(d) for d in self.days)))
        if not self.pop_start <= self.cutoff < self.target_lo <= self.target_hi:
            raise ValueError("expected pop_start <= cutoff < target_lo <= target_hi")

    def window_start(self, days: int) -> dt.datetime:
        return self.cutoff - dt.timedelta(days=days)

    @property
    def widest(self) -> int:
        return self.days[-1]

    # Names of the frequency columns, widest first (freq_90d, freq_30d, freq_7d).
    def freq_col(self, days: int) -> str:
        return f"freq_{days}d"

    @property
    def freq_cols(self) -> list[str]:
        return [self.freq_col(d) for d in reversed(self.days)]

    @property
    def value_col(self) -> str:
        return f"avg_value_{self.widest}d"


# The study dates of the original study (2023 ledger).
REFERENCE_WINDOW = StudyWindow(
    cutoff="2023-11-30", pop_start="2023-10-01",
    target_lo="2023-12-01", target_hi="2023-12-29", days=(7, 30, 90),
)

# The same study placed on the test ledger (lineitem ship dates, 1995-2001).
LEDGER_WINDOW = StudyWindow(
    cutoff="2001-06-30", pop_start="2001-05-01",
    target_lo="2001-07-01", target_hi="2001-07-29", days=(7, 30, 90),
)

# An intraday ledger (events, January 2024) with a six-hour target window.
INTRADAY_WINDOW = StudyWindow(
    cutoff="2024-01-24", pop_start="2024-01-22",
    target_lo="2024-01-25 00:00:00", target_hi="2024-01-25 06:00:00", days=(1, 3, 10),
)

LABEL_COL = "inactive_next_60d"
KEY_COL = "customer_id"
