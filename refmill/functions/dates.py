"""Dates in file names, calendar sets, ages and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: how a file's date was found
BY_NAME_YMD = "FN_YYYYMMDD"
BY_NAME_DMY = "FN_DDMMYYYY"
BY_FOLDER = "FolderName"
BY_NOTHING = "None"

# --- fixed values: freshness labels
STALE = "STALE — SLA breached"
FRESH = "OK"

_YMD = "(?<![0-9])(?:19|20|21)[0-9]{6}(?![0-9])"
_DMY = "(?<![0-9])[0-9]{4}(?:19|20|21)[0-9]{2}(?![0-9])"


def _digits(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _day(digits: Column, year_first: bool) -> Column:
    """Eight digits → date, or null. Put together as ISO text, so a bad date is a null cast."""
    at = (1, 5, 7) if year_first else (5, 3, 1)
    year, month, day = (F.substring(digits, p, n) for p, n in zip(at, (4, 2, 2)))
    in_range = (F.length(digits) == 8) & year.between("1990", "2100")
    return F.when(in_range, F.concat_ws("-", year, month, day).try_cast("date"))


def date_digits(folder: Column, name: Column) -> dict[str, Column]:
    """All digit groups that may be a date, in order: year-first, day-first, of the parent folder."""
    return {
        "ymd": _digits(name, _YMD),
        "dmy": _digits(name, _DMY),
        "parent": _digits(F.substring_index(F.translate(folder, "\\", "/"), "/", -1), _YMD),
    }


def date_candidates(digits: dict[str, Column]) -> dict[str, Column]:
    """The first group of each kind that is a date."""

    def first(groups: Column, year_first: bool) -> Column:
        days = F.transform(groups, lambda g: _day(g, year_first))
        return F.get(F.filter(days, lambda d: d.isNotNull()), F.lit(0))

    return {k: first(v, k != "dmy") for k, v in digits.items()}


def pick_date(days: dict[str, Column]) -> tuple[Column, Column]:
    """``(day, method)``. Eight digits may read both ways; year-first wins.

    Years outside 1990-2100 are taken as a number that is not a date.
    """
    day = F.coalesce(days["ymd"], days["dmy"], days["parent"])
    method = (
        F.when(days["ymd"].isNotNull(), BY_NAME_YMD)
        .when(days["dmy"].isNotNull(), BY_NAME_DMY)
        .when(days["parent"].isNotNull(), BY_FOLDER)
        .otherwise(BY_NOTHING)
    )
    return day, method


def size_mb(total_bytes: Column) -> Column:
    return F.round(total_bytes / F.lit(1048576.0), 2)


def month_days(first_of_month: Column) -> Column:
    """Every calendar day of a month as day numbers."""
    return F.sequence(F.lit(1), F.dayofmonth(F.last_day(first_of_month)))


def days_since(then: Column, as_of: Column) -> Column:
    return F.datediff(as_of, then).cast("bigint")


def freshness(days: Column, sla_days: Column) -> Column:
    """Null age or null SLA counts as OK, as in the freshness view."""
    return F.when(sla_days.isNotNull() & (days > sla_days), STALE).otherwise(FRESH)


def latency_ms(started: Column, finished: Column) -> Column:
    return F.unix_millis(finished.cast("timestamp")) - F.unix_millis(started.cast("timestamp"))
