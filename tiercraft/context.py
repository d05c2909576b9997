"""What one run is about: which month, from which date, which months are closed."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from tiercraft.functions.interactions import Interactions


def month_bounds(month_no: int) -> tuple[date, date]:
    """First day of a ``YYYYMM`` month and first day of the month after it."""
    year, month = divmod(int(month_no), 100)
    following = date(year + month // 12, month % 12 + 1, 1)
    return date(year, month, 1), following


@dataclass(frozen=True)
class RunContext:
    """``close_month`` is a ``YYYYMM`` number when a month is being closed, ``None`` for a daily run."""

    close_month: int | None = None
    min_date: str | None = None
    frozen: tuple[int, ...] = ()
    load_ts: datetime | None = None
    interactions: Interactions = Interactions()

    @property
    def first_day(self) -> str:
        """Earliest activity date of the run: the closing month's first day, else ``min_date``, which a daily run needs."""
        if self.close_month is not None:
            return month_bounds(self.close_month)[0].isoformat()
        if self.min_date is None:
            raise ValueError("a daily run needs min_date: earlier rows are left out")
        return self.min_date

    @property
    def months_to_skip(self) -> list[int]:
        """Frozen months, except the one this run is (re)closing."""
        return frozen_to_skip(self.frozen, self.close_month)


def frozen_to_skip(frozen: Iterable[int], close_month: int | None = None) -> list[int]:
    """Frozen months a run must leave alone; a month being re-closed is open to that run."""
    return sorted({int(m) for m in frozen} - {close_month})
