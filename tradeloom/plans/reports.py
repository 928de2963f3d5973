"""Datasets behind the report charts, risk lists and the star-schema report."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import float_round
from tradeloom.operators.dims import dim_account
from tradeloom.operators.measures import DAILY_SUMMARY, trade_cells
from tradeloom.plans.cubes import daily_main, fill_calendar, symbol_days
from tradeloom.schemas import TOTAL

HISTOGRAM_BINS = 15

# Risk lists and the flag each of them selects.
RISK_FLAGS = {
    "risk_scalping": "trade_scalping",
    "risk_drawdown": "high_drawdown",
    "risk_streak": "three_consecutive_losses",
    "risk_overnight": "overnight_trade",
}


def risk_list(features, name):
    return features.filter(F.col(RISK_FLAGS[name]) == 1)


def profit_curve(features, last_day=None):
    return daily_main(features, last_day).select("account_nr", "calendar_day", "cumulative_profit", "carried_profit")


def daily_net_profit(features, last_day=None):
    return daily_main(features, last_day).select("account_nr", "calendar_day", "net_profit")


def pips_vs_duration(features, last_day=None):
    return daily_main(features, last_day).select("account_nr", "calendar_day", "minutes_spent", "pips_gained")


def duration_histogram(features, last_day=None, bins=HISTOGRAM_BINS):
    """Equal-width histogram of the daily minutes of each account, last bin closed.

    Empty days count as zero minutes; they enter through their number, not as rows.
    """
    days = daily_main(features, last_day, empty_days="count").select("account_nr", "minutes_spent", "empty_days_after")
    c = F.col
    # A row per trading day of an account, in the partitioning that the daily table has already.
    account = Window.partitionBy("account_nr")
    zero = F.when(c("empty_days_after") > 0, 0.0)
    days = days.withColumns(
        {
            "lo": F.min(F.least("minutes_spent", F.coalesce(zero, "minutes_spent"))).over(account),
            "hi": F.max(F.greatest("minutes_spent", F.coalesce(zero, "minutes_spent"))).over(account),
        }
    )
    flat = c("lo") == c("hi")
    days = days.withColumns({"lo": F.when(flat, c("lo") - 0.5).otherwise(c("lo")), "hi": F.when(flat, c("hi") + 0.5).otherwise(c("hi"))})
    bin_of = lambda x: F.least(F.width_bucket(x, c("lo"), c("hi"), F.lit(bins)), F.lit(bins).cast("long"))
    binned = days.withColumns({"own": bin_of(c("minutes_spent")), "empty": bin_of(F.lit(0.0))})
    counts = [
        F.count_if(c("own") == b) + F.sum(F.when(c("empty") == b, c("empty_days_after")).otherwise(0)) for b in range(1, bins + 1)
    ]
    width = (c("hi") - c("lo")) / bins
    return (
        binned.groupBy("account_nr", "lo", "hi")
        .agg(F.array(*counts).alias("counts"))
        .select("account_nr", "lo", "hi", F.posexplode("counts").alias("place", "days"))
        .select(
            "account_nr",
            (c("place") + 1).alias("bin"),
            (c("lo") + width * c("place")).alias("bin_start"),
            (c("lo") + width * (c("place") + 1)).alias("bin_end"),
            c("days").cast("long").alias("days"),
        )
    )


def _exact_sum(name):
    return F.sum(F.col(name).cast(TOTAL)).cast("double")


def _summary_rows(features):
    """Symbol days without empty ones."""
    picked = [m for m in DAILY_SUMMARY if m.name in ("trades_won", "trades_lost", "amount_won", "amount_lost")]
    rows = symbol_days(trade_cells(features), picked).filter(F.col("symbol").isNotNull())
    return rows.fillna(0, [m.name for m in picked])


def symbol_wins(features):
    return _summary_rows(features).groupBy("account_nr", "symbol").agg(
        F.sum("trades_won").alias("trades_won"), F.sum("trades_lost").alias("trades_lost")
    )


def symbol_amounts(features):
    return _summary_rows(features).groupBy("account_nr", "symbol").agg(
        float_round(_exact_sum("amount_won"), 2).alias("amount_won"),
        F.abs(float_round(_exact_sum("amount_lost"), 2)).alias("amount_lost"),
    )


def weekday_amounts(features, last_day=None):
    """Amounts per weekday, largest first; a weekday within a gap shows with zeros."""
    picked = [m for m in DAILY_SUMMARY if m.name in ("amount_won", "amount_lost")]
    rows = fill_calendar(
        symbol_days(trade_cells(features), picked), F.col("symbol").isNotNull(), picked, last_day, empty_days="count"
    )
    # The first seven days of a gap hold every weekday it has.
    week = F.sequence(F.lit(0), F.least("empty_days_after", F.lit(7)))
    rows = rows.select("account_nr", "day", "amount_won", "amount_lost", F.explode(week).alias("step")).select(
        "account_nr",
        F.date_format(F.date_add("day", F.col("step")), "EEEE").alias("day_name"),
        *[F.when(F.col("step") == 0, F.col(m.name)).otherwise(0.0).alias(m.name) for m in picked],
    )
    return (
        rows.groupBy("account_nr", "day_name")
        .agg(
            float_round(_exact_sum("amount_won"), 2).alias("amount_won"),
            F.abs(float_round(_exact_sum("amount_lost"), 2)).alias("amount_lost"),
        )
        .orderBy("account_nr", F.desc("amount_won"), "day_name")
    )


def account_counts(trades):
    """Trades per account, most first."""
    return trades.groupBy("account_nr").agg(F.count("*").alias("trades")).orderBy(F.desc("trades"), "account_nr")


def clock_activity(trades, clock):
    """The clock dimension with the number of trades opened at each second.

    Trades are counted per second before the join; both sides hold at most 86,400 rows.
    """
    opened = trades.groupBy(F.col("open_time").alias("clock")).agg(F.count("*").alias("trades_opened"))
    return clock.join(opened, "clock", "left").fillna(0, ["trades_opened"])


def star_report(history, accounts, days, clock):
    """Trades, wins and net profit by currency, quarter and part of day.

    The clock has 86,400 rows and is broadcast. Trades are reduced per account, day and part of day
    before they meet the calendar, and per account and quarter before they meet the accounts: both
    grow with the data (one bad date makes a long calendar), so Spark picks those joins by size.
    """
    days = days.select("date_key", "cal_year", "cal_quarter")
    clock = clock.select("clock", "part_of_day")
    measures = lambda n, won: [n.alias("trades"), won.alias("trades_won"), F.sum("net_profit").alias("net_profit")]
    again = measures(F.sum("trades"), F.sum("trades_won"))
    per_day = (
        history.select("account_nr", "open_date_key", "open_time", "trade_won", "net_profit")
        .join(F.broadcast(clock), F.col("open_time") == clock.clock, "left")
        .groupBy("account_nr", "open_date_key", "part_of_day")
        .agg(*measures(F.count("*"), F.count_if(F.col("trade_won") == 1)))
    )
    keys = ["cal_year", "cal_quarter", "part_of_day"]
    per_account = per_day.join(days, F.col("open_date_key") == days.date_key, "left").groupBy("account_nr", *keys).agg(*again)
    names = dim_account(accounts).select("account_number", "currency_name")
    found = per_account.join(names, F.col("account_nr") == names.account_number, "left").groupBy("currency_name", *keys).agg(*again)
    return found.withColumn("net_profit", F.col("net_profit").cast("double"))
