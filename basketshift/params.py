"""Analysis parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


# What each scope may have of its own: the columns of a table of scope parameters, by scope_id.
SCOPE_PARAMS = ("start_date date, end_date date, prod_tail double, min_sales double, min_weeks int, min_baskets int, max_baskets bigint, "
                "non_promo_only boolean, promo_ratio string, basket_by_day boolean, adjust_for_entropy boolean, item_type string")


@dataclass(frozen=True)
class Params:
    end_date: date
    start_date: date
    prod_tail: float = 1.0
    min_sales: float = 0.0
    min_weeks: int = 0
    min_baskets: int = 1
    max_baskets: int = 2**31 - 1
    non_promo_only: bool = False
    promo_ratio: str = "0.95"
    basket_by_day: bool = False
    adjust_for_entropy: bool = True
    item_type: str = "sku"
    # A basket or session with more items than this is split over several tasks.
    block_items: int = 512

    def __post_init__(self):
        if self.item_type not in ("sku", "brand"):
            raise ValueError(f"item_type must be sku or brand, not {self.item_type!r}")
        if self.start_date > self.end_date:
            raise ValueError("start_date lies after end_date")

    @property
    def publish_date(self) -> date:
        return self.end_date + timedelta(days=1)


def resolve_window(n_years: int, today: date, end: date | None = None, start: date | None = None) -> tuple[date, date]:
    """The (start, end) days of an analysis.

    End defaults to the last day of the month before ``today``; start to the first day
    of the month after the end month, ``n_years`` earlier.
    """
    end = end or today.replace(day=1) - timedelta(days=1)
    if start is None:
        following = (end.replace(day=28) + timedelta(days=4)).replace(day=1)
        start = following.replace(year=following.year - n_years)
    return start, end
