"""Account, calendar and clock dimensions."""

from pyspark.sql import functions as F

from tradeloom.functions.columns import date_key, flag
from tradeloom.schemas import (
    CURRENCY_NAMES,
    GOLD_ACCOUNT_COLUMNS,
    GOLD_CLOCK_COLUMNS,
    GOLD_DATE_COLUMNS,
)


def dim_account(accounts):
    names = F.create_map(*[F.lit(x) for item in CURRENCY_NAMES.items() for x in item])
    return accounts.withColumn("currency_name", names[F.col("account_currency")]).select(*GOLD_ACCOUNT_COLUMNS)


def calendar_days(bounds, name="calendar_day"):
    """One row per day of a one-row frame with columns `first_day` and `last_day`; none if the last precedes the first."""
    return bounds.filter("first_day <= last_day").select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias(name))


def trade_day_bounds(trades, last_day=None):
    """First opening day of the trades up to `last_day` (the last opening day by default)."""
    last = F.lit(last_day).cast("date") if last_day is not None else F.max("open_datetime").cast("date")
    return trades.agg(F.min("open_datetime").cast("date").alias("first_day"), last.alias("last_day"))


def dim_date(bounds):
    c = F.col
    quarter_month = F.lpad((c("cal_quarter") * 3).cast("string"), 2, "0")
    return (
        calendar_days(bounds, "cal_date")
        .withColumns(
            {
                "date_key": date_key(c("cal_date")).cast("int"),
                "cal_year": F.year("cal_date"),
                "cal_quarter": F.quarter("cal_date"),
                "cal_month": F.month("cal_date"),
                "month_name": F.date_format("cal_date", "MMM"),
                "month_start": F.trunc("cal_date", "MM"),
                "month_end": F.last_day("cal_date"),
                "week_year_num": F.weekofyear("cal_date"),
                "week_month_num": F.floor((F.dayofmonth("cal_date") - 1) / 7).cast("int") + 1,
                "week_day_num": F.dayofweek("cal_date"),
                "cal_day": F.dayofmonth("cal_date"),
                "day_name": F.date_format("cal_date", "EEE"),
            }
        )
        .withColumns(
            {
                "quarter_name": F.concat(F.lit("q"), c("cal_quarter").cast("string")),
                "quarter_ending": F.concat(quarter_month, c("cal_year").cast("string")),
                "week_of_year": F.concat(F.lit("wk"), c("week_year_num").cast("string")),
                "week_of_month": F.concat(F.lit("wk"), c("week_month_num").cast("string")),
                "is_business_day": flag(~c("week_day_num").isin(1, 7)),
            }
        )
        .select(*GOLD_DATE_COLUMNS)
    )


def dim_clock(spark, compat=False):
    """All 86,400 seconds of a day. `compat` leaves the afternoon without its number."""
    second = F.col("id").cast("int")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    c = F.col
    parts = [("06:00:00", "11:59:59", "morning"), ("12:00:00", "16:59:59", "afternoon"), ("17:00:00", "20:59:59", "evening")]
    part_of_day = F.lit("night")
    for start, stop, name in reversed(parts):
        part_of_day = F.when(c("clock").between(start, stop), name).otherwise(part_of_day)
    return (
        spark.range(86400)
        .select(
            two(F.floor(second / 3600)).alias("clock_hour"),
            two(F.floor(second / 60) % 60).alias("clock_minute"),
            two(second % 60).alias("clock_second"),
        )
        .withColumn("clock", F.concat_ws(":", "clock_hour", "clock_minute", "clock_second"))
        .withColumns(
            {
                "is_working_hour": flag(c("clock").between("09:00:00", "17:00:00")),
                "is_daytime": flag(c("clock").between("06:00:00", "18:59:59")),
                "part_of_day": part_of_day,
            }
        )
        .withColumn(
            "part_of_day_num",
            F.when(c("part_of_day") == "morning", 1)
            .when(c("part_of_day") == "afternoon", F.lit(None).cast("int") if compat else F.lit(2))
            .when(c("part_of_day") == "evening", 3)
            .otherwise(4),
        )
        .select(*GOLD_CLOCK_COLUMNS)
    )


def calendar(bounds, name="calendar_day", features=False):
    """Days with their key and, if asked for, the calendar features of each day."""
    d = F.col(name)
    days = calendar_days(bounds, name).withColumn("date_key", date_key(d))
    if not features:
        return days
    year, month, day = F.year(d), F.month(d), F.dayofmonth(d)
    last_of_month = d == F.last_day(d)
    return days.withColumns(
        {
            "year": year,
            "is_leap_year": F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366,
            "is_year_start": (month == 1) & (day == 1),
            "is_year_end": (month == 12) & (day == 31),
            "quarter": F.quarter(d),
            "quarter_name": F.concat(F.lit("q"), F.quarter(d).cast("string")),
            "is_quarter_start": (month % 3 == 1) & (day == 1),
            "is_quarter_end": (month % 3 == 0) & last_of_month,
            "month": month,
            "month_name": F.date_format(d, "MMMM"),
            "month_days": F.dayofmonth(F.last_day(d)),
            "is_month_start": day == 1,
            "is_month_end": last_of_month,
            "week_of_year": F.weekofyear(d),
            "day": day,
            "day_name": F.date_format(d, "EEEE"),
            "day_of_year": F.dayofyear(d),
            "day_of_week": F.weekday(d),
        }
    )
