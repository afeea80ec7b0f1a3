"""Calendar features of a date column (all built-in, codegen'd expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in the order the dashboard heatmap lists them (Monday first),
# as produced by the date pattern "EEEE".
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Month names as the date pattern "MMMM" gives them.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
]

# Code -> label of the weekend flag.
WEEKEND_LABELS = {0: "Weekday", 1: "Weekend"}


def parse_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """String -> date; an unparseable value becomes NULL instead of failing the job."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(c, fmt)


def is_weekend(d: Column) -> Column:
    """1 on Saturday/Sunday, else 0 (a NULL date gives 0)."""
    return F.when(F.dayofweek(d).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def _named(names: list[str], number: Column) -> Column:
    """The name of a number from 1 up; NULL stays NULL (asked for, as ``element_at`` in compiled
    code was seen to give the last name for it)."""
    return F.when(number.isNotNull(), F.element_at(F.array(*[F.lit(n) for n in names]), number))


def year_month(d: Column) -> Column:
    """As the pattern "yyyy-MM" gives it: for years of four digits the date's text without its day."""
    return F.when(F.year(d).between(1, 9999), F.left(d.cast("string"), F.lit(7))).otherwise(F.date_format(d, "yyyy-MM"))


def calendar_columns(date_col: str = "date") -> dict[str, Column]:
    """The nine calendar features, keyed by output name."""
    d = F.col(date_col)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day_of_week": F.dayofweek(d),  # 1 = Sunday ... 7 = Saturday
        "day_name": _named(DAY_ORDER, F.weekday(d) + 1),
        "week_of_year": F.weekofyear(d),  # ISO-8601 week
        "quarter": F.quarter(d),
        "is_weekend": is_weekend(d),
        "month_name": _named(MONTHS, F.month(d)),
        "year_month": year_month(d),
    }


def weekend_label(flag: Column | str) -> Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    out = None
    for code, label in WEEKEND_LABELS.items():
        out = (F.when if out is None else out.when)(flag == code, F.lit(label))
    return out


def day_index(day_name: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday, NULL for anything else."""
    day_name = F.col(day_name) if isinstance(day_name, str) else day_name
    return F.array_position(F.array(*[F.lit(d) for d in DAY_ORDER]), day_name).cast("int") - 1


def quarter_label(year: Column | str, quarter: Column | str) -> Column:
    """'YYYY-Qn'."""
    year = F.col(year) if isinstance(year, str) else year
    quarter = F.col(quarter) if isinstance(quarter, str) else quarter
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))
