"""Performance report: one row per account.

Cells roll up to (account, day, symbol), to (account, day) and to the account. All steps
group by account first, so ordinary accounts keep one partitioning from the trades to the
report; large ones are reduced by partial aggregation before each shuffle. Empty days are
counted, not generated.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import float_round
from tradeloom.operators.measures import (
    DAILY_SUMMARY,
    SIDES,
    is_count,
    mean_return_sql,
    measure_column,
    rounded_sql,
    side_measures,
    std_return_sql,
    trade_cells,
    zero_filled,
)
from tradeloom.plans.cubes import replaced
from tradeloom.schemas import LOST, TOTAL

# Fixed value: trading days per year in the ratios.
TRADING_DAYS = 252

SUMMED = [
    "trades_opened",
    "trades_closed",
    "trades_ongoing",
    "trades_won",
    "trades_lost",
    "trades_neutral",
    "amount_won",
    "amount_lost",
    "pips_won",
    "pips_lost",
    "trade_scalping_won",
    "overnight_trade_won",
    "scalping_amount_won",
    "scalping_amount_lost",
    "overnight_amount_won",
    "overnight_amount_lost",
]
SUMMED_PER_SIDE = ["{}s_closed", "{}s_won", "{}s_lost", "{}_amount_won", "{}_amount_lost"]
MAIN_SUMMED = ["traded_lots", "pips_gained", "trade_scalping", "overnight_trade"]
MAIN_AVERAGED = ["avg_return", "std_return", "std_neg_return"]
RETURN_PARTS = ["n_ret", "sum_ret", "sum_ret_sq"]


def _exact(c):
    return F.col(c).cast(TOTAL)


def _day_of_symbols(cells, summary, sides):
    """(account, day): sums of the symbol rows, extreme trades, and totals for the day's own measures."""
    per_symbol = cells.groupBy("account_nr", "day", "symbol").agg(
        *map(measure_column, summary),
        *[measure_column(m) for ms in sides.values() for m in ms],
        F.sum("n_rows").alias("n_rows"),
        # What the measures of the whole day are made of.
        *[F.sum(f"{part}").alias(f"day_{part}") for part in RETURN_PARTS],
        *[F.expr(f"sum(case when trade_won = {LOST} then {part} end) as neg_{part}") for part in RETURN_PARTS],
        *[F.sum(c).alias(f"day_{c}") for c in ("sum_size", "sum_pips", "n_scalping", "n_overnight")],
    ).filter("n_rows > 0")

    in_table = F.col("symbol").isNotNull()
    columns = {m.name: f"case when symbol is not null then {zero_filled(m)} end" for m in summary}
    for word, ms in sides.items():
        columns |= {m.name: f"case when symbol is not null and {word}s_opened > 0 then {zero_filled(m)} end" for m in ms}
    rows = replaced(per_symbol, columns)

    summed = [m for m in summary if m.name in SUMMED] + [m for ms in sides.values() for m in ms if not m.name.endswith("s_opened")]
    # Extremes: largest profit and loss, then earliest day, then first symbol.
    best = F.struct((0 - _exact("max_profit")).cast(TOTAL).alias("rank"), "day", "symbol")
    worst = F.struct(_exact("max_loss").alias("rank"), "day", "symbol")
    return rows.groupBy("account_nr", "day").agg(
        *[F.expr(f"sum({m.name if is_count(m) else f'cast({m.name} as {TOTAL})'}) as {m.name}") for m in summed],
        F.min(F.when(in_table, best)).alias("best"),
        F.min(F.when(in_table, worst)).alias("worst"),
        *[F.sum(f"{prefix}_{part}").alias(f"{prefix}_{part}") for prefix in ("day", "neg") for part in RETURN_PARTS],
        *[F.sum(f"day_{c}").alias(f"day_{c}") for c in ("sum_size", "sum_pips", "n_scalping", "n_overnight")],
    )


def _daily(value, name):
    """A day's rounded figure as an exact number; 0 where it has none."""
    return f"cast(coalesce({value}, 0.0D) as decimal(28,4)) as {name}"


def _days(cells, last_day):
    """(account, day) rows ready to be summed per account."""
    summary = [m for m in DAILY_SUMMARY if m.name in SUMMED + ["max_profit", "max_loss"]]
    wanted = {w: [f"{w}s_opened"] + [t.format(w) for t in SUMMED_PER_SIDE] for w in SIDES}
    sides = {w: [m for m in side_measures(w) if m.name in wanted[w]] for w in SIDES}
    days = _day_of_symbols(cells, summary, sides)
    if last_day is not None:
        days = days.filter(F.col("day") <= F.lit(last_day).cast("date"))

    # The first empty day after a trading day stands for the whole gap among the extremes.
    following = F.lead("day").over(Window.partitionBy("account_nr").orderBy("day"))
    end = F.lit(last_day).cast("date") if last_day is not None else F.col("day")
    gap_starts = F.date_diff(F.coalesce(F.date_sub(following, 1), end), F.col("day")) > 0
    empty = lambda day: F.struct(
        F.lit(0).cast(TOTAL).alias("rank"), day.alias("day"), F.lit(None).cast("string").alias("symbol")
    )
    gap = F.when(gap_starts, empty(F.date_add("day", 1)))
    own = empty(F.col("day"))
    sums = [
        c
        for c in days.columns
        if c not in ("account_nr", "day", "best", "worst") and not c.startswith(("day_", "neg_"))
    ]
    return days.select(
        "account_nr",
        "day",
        *sums,
        F.least(F.coalesce("best", own), gap).alias("best"),
        F.least(F.coalesce("worst", own), gap).alias("worst"),
        F.expr(_daily(mean_return_sql("day_sum_ret", "day_n_ret"), "avg_return")),
        F.expr(_daily(std_return_sql("day_sum_ret", "day_sum_ret_sq", "day_n_ret"), "std_return")),
        F.expr(_daily(std_return_sql("neg_sum_ret", "neg_sum_ret_sq", "neg_n_ret"), "std_neg_return")),
        float_round(F.coalesce(F.col("day_sum_size").cast("double"), F.lit(0.0)), 4).cast(TOTAL).alias("traded_lots"),
        float_round(F.coalesce(F.col("day_sum_pips").cast("double"), F.lit(0.0)), 4).cast(TOTAL).alias("pips_gained"),
        F.col("day_n_scalping").alias("trade_scalping"),
        F.col("day_n_overnight").alias("overnight_trade"),
        F.col("best").isNotNull().alias("__traded"),
    )


def _ratio(a, b, digits, factor=100.0):
    """a / b * factor, rounded; NULL when b is 0."""
    return F.expr(rounded_sql(f"try_divide(cast({a} as double), cast({b} as double)) * {factor}D", digits))


def kpi_report(features, last_day=None):
    """Win rates, amounts, extremes, Sharpe and Sortino ratios of every account."""
    days = _days(trade_cells(features, closes=True), last_day)
    skipped = {"account_nr", "day", "best", "worst", "__traded", *MAIN_AVERAGED}
    sums = [c for c in days.columns if c not in skipped]
    end = F.lit(last_day).cast("date") if last_day is not None else F.max("day")
    totals = days.groupBy("account_nr").agg(
        *[F.expr(f"coalesce(sum({c}), 0) as {c}") for c in sums],
        *[F.expr(f"cast(sum({c}) as double) as {c}") for c in MAIN_AVERAGED],
        F.min("best").alias("best"),
        F.min("worst").alias("worst"),
        F.min(F.when(F.col("__traded"), F.col("day"))).alias("start_date"),
        F.max(F.when(F.col("__traded"), F.col("day"))).alias("end_date"),
        (F.date_diff(end, F.min("day")) + 1).alias("n_days"),
    )
    c = F.col
    rounded = lambda name, digits=2: float_round(c(name).cast("double"), digits)
    amounts = ["amount_won", "amount_lost"] + [f"{w}_amount_{o}" for w in SIDES for o in ("won", "lost")]
    totals = totals.withColumns({a: rounded(a) for a in amounts} | {m: float_round(c(m) / c("n_days") * 100.0, 2) for m in MAIN_AVERAGED})
    plain = lambda name, alias: F.expr(f"cast({name} as bigint) as {alias}")
    number = lambda name: F.expr(f"cast({name} as double) as {name}")
    annual = F.sqrt(F.lit(float(TRADING_DAYS)))
    return totals.select(
        "account_nr",
        "start_date",
        "end_date",
        plain("trades_closed", "closed_trades"),
        plain("trades_ongoing", "ongoing_trades"),
        plain("trades_opened", "n_trades"),
        c("traded_lots").cast("double").alias("lots_traded"),
        number("pips_gained"),
        float_round((0 - c("best.rank")).cast("double"), 2).alias("max_profit"),
        c("best.day").alias("max_profit_date"),
        F.upper("best.symbol").alias("max_profit_symbol"),
        float_round(c("worst.rank").cast("double"), 2).alias("max_loss"),
        c("worst.day").alias("max_loss_date"),
        F.upper("worst.symbol").alias("max_loss_symbol"),
        plain("trades_won", "n_wins"),
        plain("longs_closed", "n_longs"),
        plain("shorts_closed", "n_shorts"),
        plain("longs_won", "longs_won"),
        plain("shorts_won", "shorts_won"),
        _ratio("trades_won", "trades_closed", 0).alias("win_rate"),
        _ratio("longs_won", "longs_closed", 2).alias("long_win_rate"),
        _ratio("shorts_won", "shorts_closed", 2).alias("short_win_rate"),
        "amount_won",
        "long_amount_won",
        "short_amount_won",
        _ratio("long_amount_won", "amount_won", 2).alias("long_perc_amount_won"),
        _ratio("short_amount_won", "amount_won", 2).alias("short_perc_amount_won"),
        plain("trades_lost", "n_losses"),
        plain("longs_lost", "longs_lost"),
        plain("shorts_lost", "shorts_lost"),
        _ratio("trades_lost", "trades_closed", 0).alias("loss_rate"),
        _ratio("longs_lost", "longs_closed", 2).alias("long_loss_rate"),
        _ratio("shorts_lost", "shorts_closed", 2).alias("short_loss_rate"),
        "amount_lost",
        "long_amount_lost",
        "short_amount_lost",
        _ratio("long_amount_lost", "amount_lost", 2).alias("long_perc_amount_lost"),
        _ratio("short_amount_lost", "amount_lost", 2).alias("short_perc_amount_lost"),
        plain("trades_neutral", "n_neutrals"),
        _ratio("trades_neutral", "trades_closed", 0).alias("neutral_rate"),
        number("pips_won"),
        _ratio("amount_won", "trades_won", 2, 1.0).alias("avg_win_profit"),
        _ratio("pips_won", "trades_won", 2, 1.0).alias("avg_win_pips"),
        number("pips_lost"),
        _ratio("amount_lost", "trades_lost", 2, 1.0).alias("avg_net_loss"),
        _ratio("pips_lost", "trades_lost", 2, 1.0).alias("avg_loss_pips"),
        plain("trade_scalping", "scalping_trades"),
        plain("overnight_trade", "overnight_trades"),
        plain("trade_scalping_won", "scalping_trades_won"),
        plain("overnight_trade_won", "overnight_trades_won"),
        number("scalping_amount_won"),
        number("overnight_amount_won"),
        number("scalping_amount_lost"),
        number("overnight_amount_lost"),
        _ratio("trade_scalping", "trades_opened", 2).alias("perc_scalping_trades"),
        _ratio("overnight_trade", "trades_opened", 2).alias("perc_overnight_trades"),
        _ratio("trade_scalping_won", "trade_scalping", 2).alias("perc_scalping_trades_won"),
        _ratio("overnight_trade_won", "overnight_trade", 2).alias("perc_overnight_trades_won"),
        _ratio("scalping_amount_won", "amount_won", 2).alias("perc_scalping_amount_won"),
        _ratio("overnight_amount_won", "amount_won", 2).alias("perc_overnight_amount_won"),
        _ratio("scalping_amount_lost", "amount_lost", 2).alias("perc_scalping_amount_lost"),
        _ratio("overnight_amount_lost", "amount_lost", 2).alias("perc_overnight_amount_lost"),
        c("avg_return").alias("average_return"),
        "std_return",
        "std_neg_return",
        float_round(F.try_divide("avg_return", "std_return") * annual, 2).alias("sharpe_ratio"),
        float_round(F.try_divide("avg_return", "std_neg_return") * annual, 2).alias("sortino_ratio"),
        F.abs(float_round(F.try_divide("amount_won", "amount_lost"), 2)).alias("profit_factor"),
    )
