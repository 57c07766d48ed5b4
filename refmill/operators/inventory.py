"""File-drop inventory: date of each file, roll-ups, and gaps in the calendar.

Input ``files(folder, name, bytes, modified_at)``. All reports start from counts per
folder and day, so a folder holding most of the files shrinks to its days before the
wider groupings; only those day rows are expanded, compared or rolled up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D

# --- fixed value: which file names belong to a drop
NAME_FILTER = "^NG[_-]"


def matches(keyword: str | None = None, name_filter: str = NAME_FILTER) -> Column:
    """Whether a file is of interest; the folder keyword is compared without case."""
    named = F.col("name").rlike(name_filter)
    return named & F.contains(F.lower("folder"), F.lit(keyword.lower())) if keyword else named


def matching_files(files: DataFrame, keyword: str | None = None, name_filter: str = NAME_FILTER) -> DataFrame:
    return files.where(matches(keyword, name_filter))


def dated_files(files: DataFrame) -> DataFrame:
    """Add ``file_day`` and ``method``: digits, then dates, then the pick, each computed once."""
    digits = D.date_digits(F.col("folder"), F.col("name"))
    found = files.select("*", *[v.alias(f"_{k}") for k, v in digits.items()])
    days = D.date_candidates({k: F.col(f"_{k}") for k in digits})
    found = found.select(*files.columns, *[v.alias(f"_{k}") for k, v in days.items()])
    day, method = D.pick_date({k: F.col(f"_{k}") for k in days})
    return found.select(*files.columns, day.alias("file_day"), method.alias("method"))


def per_day(dated: DataFrame) -> DataFrame:
    """``(folder, file_day, files, bytes)`` of the dated files.

    Undated files are dropped after counting: a filter on the day itself would be
    pushed to the scan together with the whole date search, and that run twice.
    """
    return (
        dated.groupBy("folder", "file_day")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.max("file_day").alias("_day"))
        .where(F.col("_day").isNotNull())
        .drop("_day")
    )


def rollup(days: DataFrame) -> DataFrame:
    """Files and size at folder, year, month and day level, and in total."""
    parts = days.select(
        "folder",
        F.year("file_day").alias("year"),
        F.month("file_day").alias("month"),
        F.dayofmonth("file_day").alias("day"),
        "files",
        "bytes",
    )
    return (
        parts.rollup("folder", "year", "month", "day")
        .agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.grouping_id().alias("_g"))
        .select(
            "folder",
            "year",
            "month",
            "day",
            "files",
            D.size_mb(F.col("bytes")).alias("size_mb"),
            F.when(F.col("_g") == 0, "day")
            .when(F.col("_g") == 1, "month")
            .when(F.col("_g") == 3, "year")
            .when(F.col("_g") == 7, "folder")
            .otherwise("total")
            .alias("level"),
        )
    )


def folder_counts(files: DataFrame, keyword: str | None = None, name_filter: str = NAME_FILTER) -> DataFrame:
    """Every folder found with its number of matching files, zero included; one pass over the files."""
    return files.groupBy("folder").agg(F.count_if(matches(keyword, name_filter)).alias("files"))


def report_totals(counts: DataFrame) -> DataFrame:
    """Folders found and files matched, from the counts per folder."""
    return counts.agg(
        F.count(F.lit(1)).alias("folders_found"), F.coalesce(F.sum("files"), F.lit(0)).alias("files_matched")
    )


def method_counts(dated: DataFrame) -> DataFrame:
    return dated.groupBy("method").agg(F.count(F.lit(1)).alias("files"))


def year_compare(dated: DataFrame) -> DataFrame:
    """Files and size by the year in the name next to the year of modification."""

    # One pass over the files: each counts for the year of its name and for that of its modification.
    years = F.array(*[F.struct(F.year(d).alias("year"), F.lit(p).alias("of")) for d, p in (("file_day", "fn"), ("modified_at", "md"))])
    sides = dated.select("bytes", F.inline(years))
    both = (
        sides.groupBy("year")
        .agg(
            *[F.count_if(F.col("of") == p).alias(f"{p}_count") for p in ("fn", "md")],
            *[F.sum(F.when(F.col("of") == p, F.col("bytes"))).alias(f"{p}_bytes") for p in ("fn", "md")],
        )
        .where(F.col("year").isNotNull())
    )

    def count(prefix: str):
        return F.coalesce(f"{prefix}_count", F.lit(0).cast("bigint")).alias(f"{prefix}_count")

    def size(prefix: str):
        return D.size_mb(F.coalesce(f"{prefix}_bytes", F.lit(0).cast("bigint"))).alias(f"{prefix}_size_mb")

    return both.select("year", count("fn"), size("fn"), count("md"), size("md"))


def missing_days(days: DataFrame) -> DataFrame:
    """Per folder and month that has files: the calendar days without one."""
    months = days.groupBy("folder", F.trunc("file_day", "MM").alias("month_start")).agg(
        F.collect_set(F.dayofmonth("file_day")).alias("present")
    )
    gaps = F.array_except(D.month_days(F.col("month_start")), F.col("present"))
    return months.select(
        "folder",
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        F.explode(gaps).alias("missing_day"),
    )


def missing_months(days: DataFrame) -> DataFrame:
    """Per folder and year that has files: the months without one."""
    years = days.groupBy("folder", F.year("file_day").alias("year")).agg(
        F.collect_set(F.month("file_day")).alias("present")
    )
    gaps = F.array_except(F.sequence(F.lit(1), F.lit(12)), F.col("present"))
    return years.select("folder", "year", F.explode(gaps).alias("missing_month"))


def detail_report(folders: DataFrame, days: DataFrame) -> DataFrame:
    """Year, month and day rows per folder; a folder without dated files has one empty row."""
    levels = rollup(days).where(F.col("level").isin("folder", "year", "month", "day"))
    return folders.select("folder").distinct().join(levels, "folder", "left").withColumn(
        "files", F.coalesce("files", F.lit(0).cast("bigint"))
    )
