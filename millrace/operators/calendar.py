"""Business-day offsets by arithmetic on weeks and a rank among holidays."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_REGION = "Ontario"
# What a date can be, in days since 1970; no array of holidays is longer than that range.
FIRST, LAST = (d.toordinal() - date(1970, 1, 1).toordinal() for d in (date.min, date.max))
FULL_RANGE = LAST - FIRST + 1


def holiday_dates(
    holidays: DataFrame,
    regions: str | Sequence[str] = DEFAULT_REGION,
    custom: DataFrame | Sequence[date] | None = None,
) -> DataFrame:
    """Distinct holidays of one or more regions, from a ``(region, date)`` table.

    A region the table does not know counts as the default region.
    """
    wanted = [regions] if isinstance(regions, str) else list(regions)
    spark = holidays.sparkSession
    asked = spark.createDataFrame([(r,) for r in wanted], "region string")
    known = holidays.select("region").distinct()
    effective = asked.join(known.withColumn("_known", F.lit(True)), "region", "left").select(
        F.when(F.col("_known"), F.col("region")).otherwise(F.lit(DEFAULT_REGION)).alias("region")
    )
    days = holidays.join(effective.distinct(), "region", "left_semi").select(F.col("date").cast("date").alias("date"))
    if custom is not None:
        extra = custom if isinstance(custom, DataFrame) else spark.createDataFrame([(d,) for d in custom], "date date")
        days = days.union(extra.select(F.col("date").cast("date")))
    return days.distinct()


def _weekdays_upto(day: Column) -> Column:
    """How many Mondays to Fridays there are up to a day (a number of days since 1970), itself included."""
    since_monday = day + 3  # 1970 began on a Thursday
    week = F.floor(since_monday / 7)
    return week * 5 + F.least(since_monday - week * 7 + 1, F.lit(5))


def _day_of_weekday(number: Column) -> Column:
    """The day whose count by :func:`_weekdays_upto` is ``number``."""
    week = F.floor((number - 1) / 5)
    return week * 7 + (number - week * 5) - 4


def _halves(size: Column) -> Column:
    """Powers of two up to ``size``, the greatest first."""
    powers = F.sequence(F.lit(0), F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int"))
    return F.reverse(F.transform(powers, lambda k: F.pow(F.lit(2), k).cast("int")))


def _rank(values: Column, halves: Column, x: Column) -> Column:
    """How many of the sorted ``values`` are at most ``x``, by halving."""
    return F.aggregate(halves, F.lit(0), lambda at, step: F.when(F.get(values, at + step - 1) <= x, at + step).otherwise(at))


def business_day_offset(
    df: DataFrame,
    anchor: str,
    days: str,
    holidays: DataFrame,
    output: str = "offset_at",
) -> DataFrame:
    """Move ``anchor`` by ``days`` business days, keeping its time of day.

    From a non-business day a move of zero or backwards first rolls forward and
    a move forwards first rolls back.  Weeks are counted by arithmetic, and the
    holidays passed by their rank in one sorted array, which the date type bounds
    (a scalar subquery; rows are neither joined nor shuffled).  A day before year 1
    or past 9999 is NULL, however far a row is to move.
    """
    off = holidays.select(F.unix_date(F.col("date").cast("date")).cast("bigint").alias("day"))
    off = F.array_sort(F.collect_set(F.when(F.pmod(F.col("day") + 3, F.lit(7)) < 5, F.col("day")))).alias("days")
    # The k-th holiday is passed on the way to business day n if its own number among weekdays, less k, is at most n.
    found = holidays.select(F.unix_date(F.col("date").cast("date")).cast("bigint").alias("day")).agg(off)
    found = found.select("days", F.transform("days", lambda day, k: _weekdays_upto(day) - k).alias("passed"))
    table = found.select(F.struct("days", "passed", _halves(F.size("days")).alias("halves"))).scalar()

    day = F.unix_date(F.to_date(anchor)).cast("bigint")
    moved = df.withColumn("_off", table).withColumn("_day", day)
    rank = _rank(F.col("_off.days"), F.col("_off.halves"), F.col("_day"))
    moved = moved.withColumn("_rank", rank)
    closed = (F.pmod(F.col("_day") + 3, F.lit(7)) >= 5) | (F.coalesce(F.get(F.col("_off.days"), F.col("_rank") - 1), F.lit(FIRST - 1)) == F.col("_day"))
    start = _weekdays_upto(F.col("_day")) - F.col("_rank") + F.when((F.col(days) <= 0) & closed, 1).otherwise(0)
    moved = moved.withColumn("_goal", F.try_add(start, F.col(days).cast("bigint")))
    # Farther than any date can be, so that nothing overflows below.
    near = F.col("_goal").between(-2 * FULL_RANGE, 2 * FULL_RANGE)
    goal = _day_of_weekday(F.col("_goal") + _rank(F.col("_off.passed"), F.col("_off.halves"), F.col("_goal")))
    moved = moved.withColumn("_goal", F.when(near, goal))
    inside = F.when(F.col("_goal").between(FIRST, LAST), F.col("_goal")).cast("int")
    kind = df.schema[anchor].dataType
    value = F.date_from_unix_date(inside).cast(kind)
    if kind.typeName() != "date":
        value = value + (F.col(anchor) - F.date_trunc("day", F.col(anchor)).cast(kind))
    return moved.select(*df.columns, value.alias(output))
