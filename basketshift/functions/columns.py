"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text read as null in tab-separated inputs.
NULL_TOKENS = ("NULL", "None", "NA", "NaN", "nan", "N/A", "")

# Data-type codes of the sku master.
SELF_CODE = 10
POP_CODES = (1, 2, 3, 4, 5, 6, 7, 8, 9)

# The attribute name that carries the brand, and the first site code
# that is not ours.
BRAND_ATTR = "品牌"
FOREIGN_SITE = 2

SCOPE_PARTS = ("item_first_cate_cd", "item_second_cate_cd", "item_third_cate_cd", "self_pop", "scope_type",
               "scope_desc", "item_type")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time ---------------------------------------------------------------------


def last_day_of_previous_month(day: Column | str) -> Column:
    return F.last_day(F.add_months(_col(day), -1))


def window_start(end: Column | str, n_years: int) -> Column:
    """First day of the month after ``end``, ``n_years`` earlier."""
    return window_start_months(_col(end), F.lit(12 * n_years))


def window_start_months(end: Column, months: Column) -> Column:
    """First day of the month after ``end``, so many months earlier."""
    return F.date_add(F.last_day(F.add_months(end, -months)), 1)


def week_number(day: Column | str, start: date | Column) -> Column:
    """Week counted from ``start``, the first day being in week 1."""
    first = start if isinstance(start, Column) else F.lit(start)
    return F.ceil((F.datediff(_col(day), first) + 1) / F.lit(7.0)).cast("int")


def to_second(ts: str) -> Column:
    """A timestamp without its fraction of a second."""
    return F.expr(f"{ts} - make_dt_interval(0, 0, 0, extract(second from {ts}) % 1)")


def publish_date(end: Column | str) -> Column:
    return F.date_add(_col(end), 1)


# -- scope identity -----------------------------------------------------------


def scope_id(prefix: str = "") -> Column:
    return F.concat_ws("_", *[F.col(prefix + p) for p in SCOPE_PARTS])


def super_scope_id() -> Column:
    sid = scope_id()
    return F.when(F.col("scope_type") == "lvl4", F.replace(sid, F.lit("lvl4"), F.lit("super"))).otherwise(sid)


def sku_type(code: Column | str) -> Column:
    c = _col(code)
    return F.when(c == SELF_CODE, "self").when(c.isin(*POP_CODES), "pop").otherwise("other")


def category_codes(scope_codes: Column | str) -> Column:
    """The distinct third-level codes of a ``-`` joined list."""
    return F.array_distinct(F.split(_col(scope_codes), "-"))


# -- money and quantities -----------------------------------------------------


# The scale of quantities and amounts: four decimals, those of a price times a discount and a tax.
SCALE = 10_000


def scaled(c: Column | str) -> Column:
    """An amount as a whole number of ten-thousandths, so that sums are exact and cheap."""
    return (_col(c).cast("decimal(18,4)") * SCALE).cast("long")


def units(c: Column | str) -> Column:
    """The inverse of :func:`scaled`."""
    return _col(c) / F.lit(float(SCALE))


# -- substitution formulas ----------------------------------------------------


def switched_spend(a, a_total, b, b_total) -> Column:
    """Spend moving from b in one basket to a in the next."""
    return F.try_divide(a, a_total) * F.try_divide(b, b_total) * (a_total + b_total)


def within_spend(a, b, total) -> Column:
    """:func:`switched_spend` for two items of one basket."""
    return F.try_divide(2 * a * b, total)


def complement_index(t: Column) -> Column:
    """1 for a user who spreads spend evenly (t = 0), -1 for one who concentrates it (t = 1)."""
    return (1 - 2 * t) / (2 * t * t - 2 * t + 1)


def lift_index(lift: Column) -> Column:
    """Negative where two items share baskets more often than chance, else zero."""
    return F.least((1 - lift * lift) / (1 + lift * lift), F.lit(0.0))


def log_distance(a: Column, b: Column) -> Column:
    """Distance of two numbers on a log2(x + 1) scale; null below the scale."""
    def on_scale(x):
        # NaN is larger than all numbers to Spark, so it does not pass either.
        return F.when((x > -1) & (x < float("inf")), F.log2(x + 1))
    return F.abs(on_scale(a) - on_scale(b))


def null_tokens(text: Column | str) -> Column:
    """Text without the tokens that stand for null."""
    return F.when(~_col(text).isin(*NULL_TOKENS), _col(text))


def number(text: Column | str) -> Column:
    """A plain decimal number, with an exponent or not, that is finite; null for all other text, such as NaN, Infinity or 5d."""
    parsed = F.when(F.rlike(_col(text), F.lit(r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,4})?$")), _col(text)).try_cast("double")
    return F.when(F.abs(parsed) < float("inf"), parsed)
