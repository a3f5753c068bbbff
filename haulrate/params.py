"""Parameters of a pricing run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Limits:
    """Measured sizes that decide how a table may be joined.

    broadcast_rows: a side with at most this many rows may be broadcast.
    literal_rows: a band card with at most this many rows becomes one CASE expression.
    keyword_rows: a keyword card with at most this many rows becomes one literal array.
    hot_rows: rows of one join key from which the key is split over several tasks.
    """

    broadcast_rows: int = 200_000
    literal_rows: int = 256
    keyword_rows: int = 4_000
    hot_rows: int = 1_000_000


@dataclass(frozen=True)
class Params:
    """What a back-test prices: one partner's shipments delivered in a window."""

    partner: str
    as_of: date
    start_date: date = date(2023, 4, 1)
    end_date: date = date(2023, 10, 16)
    fuel_start: date = date(2017, 1, 1)
    fuel_lag_days: int = 14
    keyword_passes: int = 3
    text_size_compare: bool = False
    limits: Limits = field(default_factory=Limits)
