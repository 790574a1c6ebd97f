"""Date spines, periods and date-contiguous batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """A date Column from a Column, ``datetime.date`` or ISO text."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def days(spark: SparkSession, start, end) -> DataFrame:
    """One row per day of ``[start, end]``."""
    span = F.when(as_date(start) <= as_date(end), F.sequence(as_date(start), as_date(end)))
    return spark.range(1).select(F.explode(span).alias("date"))


def months(spark: SparkSession, start, end) -> DataFrame:
    """One row per (year, month) touched by ``[start, end]``."""
    return (days(spark, start, end)
            .select(F.year("date").alias("year"), F.month("date").alias("month")).distinct())


def fill(spine: DataFrame, measured: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of the spine; measures without data are 0."""
    values = [c for c in measured.columns if c not in keys]
    return spine.join(measured, keys, "left").select(
        *keys, *[F.coalesce(F.col(c), F.lit(0)).cast(measured.schema[c].dataType).alias(c)
                 for c in values])


def period(vouchers: DataFrame) -> DataFrame:
    """First and last voucher date."""
    return vouchers.agg(F.min("date").alias("period_from"), F.max("date").alias("period_to"))


def batches(rows: DataFrame, size: int = 5000, date: str = "date") -> DataFrame:
    """Contiguous date ranges of at most ``size`` rows each.

    Days are taken in order; a day that would overfill the running batch starts the next one,
    so a day larger than ``size`` is a batch of its own. Counting is distributed; the fold
    then sees one value per calendar day.
    """
    per_day = rows.where(F.col(date).isNotNull()).groupBy(F.col(date).alias("day")).agg(
        F.count("*").alias("n"))
    calendar = per_day.agg(F.array_sort(F.collect_list(F.struct("day", "n"))).alias("days"))

    def start_of(day: Column) -> Column:
        return F.struct(day["day"].alias("date_from"), day["day"].alias("date_to"),
                        day["n"].alias("rows"))

    def step(done: Column, day: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        fits = last["rows"] + day["n"] <= size
        head = F.slice(done, F.lit(1), F.size(done) - 1)
        grown = F.struct(last["date_from"].alias("date_from"), day["day"].alias("date_to"),
                         (last["rows"] + day["n"]).alias("rows"))
        return F.when(F.coalesce(fits, F.lit(False)), F.concat(head, F.array(grown))).otherwise(
            F.concat(done, F.array(start_of(day))))

    empty = F.array().cast("array<struct<date_from:date,date_to:date,rows:bigint>>")
    return (
        calendar.select(F.posexplode(F.aggregate("days", empty, step)).alias("i", "b"))
        .select((F.col("i") + 1).alias("batch"), "b.date_from", "b.date_to", "b.rows"))
