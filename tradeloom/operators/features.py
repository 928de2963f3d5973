"""Per-trade features with the warehouse rules.

Cumulative profit and balance include all trades that share the opening time (range frame);
lags run over all ledger rows, balance rows included, in (open time, ticket) order.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import flag, seconds_between, time_of_day
from tradeloom.operators.skew import (
    Ledger,
    bucket_prefix,
    join_buckets,
    running_max,
    running_sum,
    split_ledger,
    ticket_range,
)
from tradeloom.schemas import LOST, NEUTRAL, TOTAL, TRADE_TYPES, UNDECIDED, WON


def trade_won_code(closed, net):
    return (
        F.when((closed == 1) & (net > 0), WON)
        .when((closed == 1) & (net < 0), LOST)
        .when((closed == 1) & (net == 0), NEUTRAL)
        .otherwise(UNDECIDED)
    )


def closed_flag():
    return flag(F.col("open_datetime").isNotNull() & F.col("close_datetime").isNotNull())


def balance_change():
    zero = F.lit(0).cast("decimal(18,6)")
    return F.col("profit") - F.coalesce("commission", zero) - F.coalesce("swap", zero)


def _row_features(trades):
    c = F.col
    seconds = seconds_between(c("open_datetime"), c("close_datetime"))
    move = c("close_price") - c("open_price")
    return trades.withColumns(
        {
            "minutes_spent": F.round(seconds / 60, 1),
            "pips_gained": F.when(c("type") == "buy", move * 10000).when(c("type") == "sell", -move * 10000),
            "net_profit": c("profit") - c("commission") - c("swap"),
            "trade_closed": closed_flag(),
        }
    ).withColumn("trade_won", trade_won_code(c("trade_closed"), c("net_profit")))


def _ordinary(rows):
    """Plain windows over account-partitioned rows: one sort serves all of them."""
    ties = Window.partitionBy("account_nr").orderBy("open_datetime")
    line = Window.partitionBy("account_nr").orderBy("open_datetime", "ticket")
    rows = rows.sortWithinPartitions("account_nr", "open_datetime", "ticket").withColumns(
        {
            "cumulative_profit": F.sum("net_profit").over(ties).cast(TOTAL),
            "balance": F.sum(balance_change()).over(ties).cast(TOTAL),
        }
    )
    lost = F.col("trade_won") == LOST
    return rows.withColumns(
        {
            "initial_balance": F.lag("balance").over(line),
            "three_consecutive_losses": flag(
                lost
                & (F.lag("trade_won", 1).over(line) == LOST)
                & (F.lag("trade_won", 2).over(line) == LOST)
            ),
        }
    )


def _hot(rows):
    """The same columns for hot accounts, from totals per day, second and ticket range."""
    rows = rows.withColumns({"open_day": F.to_date("open_datetime"), "ticket_range": ticket_range()})
    levels = [["open_day"], ["open_datetime"], ["ticket_range"]]
    bucket = ["account_nr", "open_day", "open_datetime", "ticket_range"]
    line = Window.partitionBy(*bucket).orderBy("ticket")
    rows = rows.withColumn("__rn", F.row_number().over(line)).withColumn(
        "__kept", F.max(F.when(F.col("trade_won") != LOST, F.col("__rn"))).over(line)
    )

    prefix = bucket_prefix(
        rows,
        "account_nr",
        levels,
        {
            "rows": ("sum", F.lit(1)),
            "net": ("sum", F.col("net_profit")),
            "bal": ("sum", balance_change()),
            "kept": ("max", F.col("__kept")),
        },
        nulls_first=True,
    )
    # Position of the last row that is not a loss, counted over the whole account.
    prefix = prefix.withColumn("rows_before", F.coalesce(running_sum("rows", 2, False), F.lit(0)))
    kept = bucket_prefix(
        prefix, "account_nr", levels, {"pos": ("max", F.col("rows_before") + F.col("kept_own_2"))}, nulls_first=True
    ).select(*bucket, F.coalesce(running_max("pos", 2), F.lit(0)).alias("kept_before"))
    prefix = join_buckets(prefix, kept, bucket).select(
        *bucket,
        "kept_before",
        "rows_before",
        F.col("rows_before_2").isNull().alias("first_range"),
        running_sum("net", 1, True).cast(TOTAL).alias("cumulative_profit"),
        running_sum("bal", 1, True).cast(TOTAL).alias("balance"),
        running_sum("bal", 1, False).cast(TOTAL).alias("balance_before"),
    )

    # NULL arguments of greatest are skipped.
    kept_position = F.greatest(F.col("kept_before"), F.col("rows_before") + F.col("__kept"))
    return (
        join_buckets(rows, prefix, bucket)
        .withColumn(
            "initial_balance",
            F.when(F.col("first_range") & (F.col("__rn") == 1), F.col("balance_before")).otherwise(F.col("balance")),
        )
        .withColumn(
            "three_consecutive_losses",
            flag(F.col("rows_before") + F.col("__rn") - kept_position >= 3),
        )
        .drop("open_day", "ticket_range", "__rn", "__kept", "rows_before", "first_range", "balance_before", "kept_before")
    )


def trade_features(trades, hot=None, most_rows=None):
    """All ledger rows with their features; takes trades or an already split ledger.

    hot, most_rows: what is known about the accounts' sizes, see `skew.found_hot`.
    """
    ledger = trades if isinstance(trades, Ledger) else split_ledger(trades, hot=hot, most_rows=most_rows)
    rows = ledger.map(_row_features).combine(_ordinary, _hot)
    c = F.col
    return rows.withColumns(
        {
            "open_time": time_of_day(c("open_datetime")),
            "close_time": time_of_day(c("close_datetime")),
            "trade_return": F.round(F.try_divide("net_profit", "initial_balance"), 4),
            "sl_triggered": flag(c("stop_loss") == c("close_price")),
            "tp_triggered": flag(c("take_profit") == c("close_price")),
            "trade_scalping": flag((c("trade_closed") == 1) & (c("minutes_spent") < 2)),
            "overnight_trade": flag((c("trade_closed") == 1) & (F.round(c("minutes_spent") / 60, 0) > 8)),
        }
    )


def trade_history(features):
    """Buys and sells only; the filter stays above the account windows."""
    return features.filter(F.col("type").isin(*TRADE_TYPES))
