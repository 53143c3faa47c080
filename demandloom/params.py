"""Periods and calendar parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Calendar:
    """Train and test periods (all days inclusive), holidays and event ranges."""

    train_start: date
    train_end: date
    test_start: date
    test_end: date
    holidays: tuple[date, ...] = ()
    events: tuple[tuple[date, date], ...] = field(default_factory=tuple)


#: The period of the event-based panel.
PANEL = Calendar(
    date(2024, 1, 1), date(2024, 1, 23), date(2024, 1, 24), date(2024, 1, 30), (date(2024, 1, 1), date(2024, 1, 7), date(2024, 1, 8), date(2024, 1, 19)), ((date(2024, 1, 10), date(2024, 1, 12)), (date(2024, 1, 20), date(2024, 1, 21)))
)
#: The period of the order-line sales.
SALES = Calendar(
    date(1995, 1, 1), date(2001, 8, 31), date(2001, 9, 1), date(2001, 11, 30), tuple(date(y, m, d) for y in range(1995, 2002) for m, d in ((1, 1), (1, 7), (2, 23), (3, 8), (5, 1), (5, 9), (6, 12), (11, 4))), ((date(1998, 6, 10), date(1998, 7, 12)), (date(2000, 9, 15), date(2000, 10, 1)))
)
#: Five months of the order-line sales with all their items: four to train on and one to test.
SEASON = Calendar(date(1998, 1, 1), date(1998, 4, 30), date(1998, 5, 1), date(1998, 5, 31), tuple(date(1998, m, d) for m, d in ((1, 1), (1, 7), (2, 23), (3, 8), (5, 1), (5, 9))), ((date(1998, 2, 7), date(1998, 2, 22)), (date(1998, 4, 10), date(1998, 4, 12))))
