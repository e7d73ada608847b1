"""Service calendars: weekly patterns to dates, exceptions, and the choice of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ADDED, REMOVED = 1, 2


def date_of(yyyymmdd: Column) -> Column:
    return F.to_date(yyyymmdd.cast("string"), "yyyyMMdd")


def number_of(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def expand(calendar: DataFrame) -> DataFrame:
    """service_id, date, exception_type 1: every date from start_date to end_date whose weekday the service runs on."""
    start, end = date_of(F.col("start_date")), date_of(F.col("end_date"))
    days = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    runs = F.array(*[F.col(d).cast("int") for d in WEEKDAYS])
    days = F.filter(days, lambda d: F.get(runs, F.weekday(d)) == 1)
    return calendar.select("service_id", F.explode(days).alias("d")).select("service_id", number_of(F.col("d")).alias("date"), F.lit(ADDED).alias("exception_type"))


def load(calendar: DataFrame | None, exceptions: DataFrame | None, services: DataFrame) -> DataFrame:
    """Dates of the given services (service_id): from the exceptions where that table exists, else from the calendar."""
    rows = exceptions if exceptions is not None else expand(calendar)
    return rows.join(services.select("service_id").distinct(), "service_id", "left_semi")


def effective(calendar: DataFrame | None, exceptions: DataFrame | None) -> DataFrame:
    """The dates that services really run: the pattern without removals, with additions; a pattern's row wins over an
    equal addition. Exceptions alone pass as they are; at least one table must be there."""
    if calendar is None and exceptions is None:
        raise ValueError("neither a calendar nor exceptions")
    if calendar is None:
        return exceptions
    base = expand(calendar)
    if exceptions is None:
        return base
    keys = ["service_id", "date"]
    kept = base.join(exceptions.filter(F.col("exception_type") == REMOVED).select(*keys).distinct(), keys, "left_anti")
    added = exceptions.filter(F.col("exception_type") == ADDED).select(*keys, F.col("exception_type").cast("int").alias("exception_type"))
    return first_by(kept.withColumn("source", F.lit(0)).unionByName(added.withColumn("source", F.lit(1))), keys, ["source"]).drop("source")


def first_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def active(exceptions: DataFrame, date: int) -> DataFrame:
    return exceptions.filter((F.col("date") == date) & (F.col("exception_type") == ADDED)).select("service_id").distinct()


def services_by_date(exceptions: DataFrame) -> DataFrame:
    return exceptions.filter(F.col("exception_type") == ADDED).groupBy("date").agg(F.countDistinct("service_id").alias("services"))


def busiest(exceptions: DataFrame, n: int) -> DataFrame:
    """The n dates with most services, earlier ones first among equals, with weekday (Monday 0) and name."""
    d = date_of(F.col("date"))
    top = services_by_date(exceptions).orderBy(F.desc("services"), "date").limit(n)
    return top.select("date", "services", F.weekday(d).alias("weekday"), F.date_format(d, "EEEE").alias("day_name"))


def extent(exceptions: DataFrame) -> DataFrame:
    """Number of dates with service, the first and the last."""
    days = exceptions.filter(F.col("exception_type") == ADDED)
    return days.agg(F.countDistinct("date").alias("dates"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
