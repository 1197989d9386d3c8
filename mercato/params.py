"""Run parameters shared by every analysis."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


def _parse_day(value: str | _dt.date | None, name: str) -> _dt.datetime | None:
    if value is None or value == "":
        return None
    if isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    try:
        day = _dt.datetime.strptime(value, "%Y-%m-%d")
    except ValueError as exc:
        raise ValueError(f"cannot read {name}={value!r} as a date; write it like 2018-03-31") from exc
    return day


@dataclass(frozen=True)
class Params:
    """Optional filters: purchase date range and seller state.

    ``None`` or ``''`` means "no filter". Both dates are compared with the
    purchase timestamp at midnight at the start of the given day, so
    ``end_date='1999-12-31'`` keeps 1999-12-31 00:00:00 but drops an order
    placed at 09:00 that day (the reference's semantics).
    """

    start_date: str | _dt.date | None = None
    end_date: str | _dt.date | None = None
    seller_state: str | None = None

    def __post_init__(self) -> None:
        # validate eagerly, like the command-line date check
        _parse_day(self.start_date, "start_date")
        _parse_day(self.end_date, "end_date")

    @property
    def start(self) -> _dt.datetime | None:
        return _parse_day(self.start_date, "start_date")

    @property
    def end(self) -> _dt.datetime | None:
        return _parse_day(self.end_date, "end_date")

    @property
    def state(self) -> str | None:
        return self.seller_state or None


NO_FILTER = Params()
