"""Measure definitions of the daily tables and their aggregation.

Trades are aggregated once, without conditions, to cells of (account, day, symbol, type,
outcome). Every daily table is a roll-up of cells, so its conditions are evaluated on cells
and not on trades, and means and deviations come from exact sums. The many measure
expressions are SQL texts, which Spark parses in one step each.
"""

from typing import NamedTuple

from pyspark.sql import functions as F

from tradeloom.schemas import LOST, NEUTRAL, WON

RETURN_UNIT = 10000.0


class Measure(NamedTuple):
    name: str
    how: str
    base: str = "rows"
    won: int | None = None
    side: str | None = None
    digits: int | None = None


def _won_lost(template, base, sum_digits=None, mean_digits=2, side=None):
    """Sum and mean over won trades, then over lost trades."""
    out = []
    for word, code in (("won", WON), ("lost", LOST)):
        name = template.format(word)
        out.append(Measure(name, "sum", base, code, side, sum_digits))
        out.append(Measure(f"avg_{name}", "mean", base, code, side, mean_digits))
    return out


DAILY_SUMMARY = [
    Measure("trades_opened", "count"),
    Measure("trades_closed", "count", "closed"),
    Measure("trades_ongoing", "count", "ongoing"),
    Measure("trades_won", "count", won=WON),
    Measure("trades_lost", "count", won=LOST),
    Measure("trades_neutral", "count", won=NEUTRAL),
    Measure("stop_loss", "count", "stop_loss"),
    Measure("take_profit", "count", "take_profit"),
    *_won_lost("amount_{}", "net"),
    Measure("net_profit", "sum", "net"),
    Measure("avg_net_profit", "mean", "net", digits=2),
    Measure("avg_return", "mean_return", digits=4),
    Measure("std_return", "std_return", digits=4),
    *_won_lost("lots_{}", "size"),
    *_won_lost("pips_{}", "pips"),
    *_won_lost("minutes_spent_{}", "minutes", 0, 0),
    Measure("trade_scalping_won", "count", "scalping", WON),
    Measure("overnight_trade_won", "count", "overnight", WON),
    Measure("trade_scalping_lost", "count", "scalping", LOST),
    Measure("overnight_trade_lost", "count", "overnight", LOST),
    Measure("scalping_amount_won", "sum", "scalping_net", WON, digits=0),
    Measure("scalping_amount_lost", "sum", "scalping_net", LOST, digits=0),
    Measure("overnight_amount_won", "sum", "overnight_net", WON, digits=0),
    Measure("overnight_amount_lost", "sum", "overnight_net", LOST, digits=0),
    Measure("max_profit", "max", "profit", WON),
    Measure("max_loss", "min", "profit", LOST),
]

DAILY_MAIN = [
    Measure("profit", "sum", "profit", digits=4),
    Measure("net_profit", "sum", "net", digits=4),
    Measure("avg_return", "mean_return", digits=4),
    Measure("std_return", "std_return", digits=4),
    Measure("std_neg_return", "std_return", won=LOST, digits=4),
    Measure("minutes_spent", "sum", "minutes", digits=4),
    Measure("trade_scalping", "count", "scalping"),
    Measure("overnight_trade", "count", "overnight"),
    Measure("traded_lots", "sum", "size", digits=4),
    Measure("pips_gained", "sum", "pips", digits=4),
    Measure("max_profit", "max", "profit"),
    Measure("max_loss", "min", "profit"),
]

# Trade type and the word its measures carry.
SIDES = {"long": "buy", "short": "sell"}


def side_measures(word):
    """The measures of one side; `word` is 'long' or 'short'."""
    side = SIDES[word]
    return [
        Measure(f"{word}s_opened", "count", side=side),
        Measure(f"{word}s_closed", "closes", side=side),
        Measure(f"{word}s_ongoing", "count", "ongoing", side=side),
        Measure(f"{word}s_won", "count", won=WON, side=side),
        Measure(f"{word}s_lost", "count", won=LOST, side=side),
        Measure(f"{word}s_neutral", "count", won=NEUTRAL, side=side),
        Measure(f"{word}_stop_loss", "count", "stop_loss", side=side),
        Measure(f"{word}_take_profit", "count", "take_profit", side=side),
        *_won_lost(word + "_amount_{}", "net", side=side),
        Measure(f"{word}_net_profit", "sum", "net", side=side),
        Measure(f"avg_{word}_net_profit", "mean", "net", side=side, digits=2),
        Measure(f"avg_{word}_return", "mean_return", side=side, digits=4),
        Measure(f"std_{word}_return", "std_return", side=side, digits=4),
        *_won_lost(word + "_lots_{}", "size", side=side),
        *_won_lost(word + "_pips_{}", "pips", side=side),
        *_won_lost(word + "_minutes_spent_{}", "minutes", 0, 0, side=side),
    ]


def names(measures):
    return [m.name for m in measures]


def is_count(measure):
    return measure.how in ("count", "closes")


# What cells take from cleaned trades as it is; beside these they need the return and both days.
CELL_COLUMNS = [
    "account_nr",
    "symbol",
    "type",
    "trade_won",
    "trade_closed",
    "trade_scalping",
    "overnight_trade",
    "sl_triggered",
    "tp_triggered",
    "ticket",
    "net_profit",
    "size",
    "pips_gained",
    "trade_duration_minutes",
    "profit",
]


def trade_cells(features, closes=False):
    """Cells of cleaned trades: (account, day, symbol, type, outcome) with plain totals.

    With `closes`, every trade also counts once on its closing day, in the same pass: the
    cell then carries `n_closes` and a cell without opened trades has `n_rows` = 0.
    """
    c = F.col
    rows = features.select(
        *CELL_COLUMNS,
        F.rint(c("trade_return") * RETURN_UNIT).cast("decimal(19,0)").alias("ret"),
        c("open_date").alias("day"),
        *([c("close_date")] if closes else []),
    )
    opened = F.lit(True)
    if closes:
        events = F.array(
            F.struct(c("day"), F.lit(True).alias("opened")), F.struct(c("close_date").alias("day"), F.lit(False).alias("opened"))
        )
        rows = rows.select(*[n for n in rows.columns if n not in ("day", "close_date")], F.inline(events))
        opened = c("opened")
    on = (lambda value: F.when(opened, value)) if closes else (lambda value: value)
    total = lambda value: F.sum(on(value))
    return (
        rows.filter(c("day").isNotNull())
        .groupBy("account_nr", "day", "symbol", "type", "trade_won")
        .agg(
            F.count(on(c("ticket"))).alias("n_rows"),
            total(c("trade_closed")).alias("n_closed"),
            total(1 - c("trade_closed")).alias("n_ongoing"),
            total(c("sl_triggered")).alias("n_stop_loss"),
            total(c("tp_triggered")).alias("n_take_profit"),
            total(c("trade_scalping")).alias("n_scalping"),
            total(c("overnight_trade")).alias("n_overnight"),
            total(c("net_profit")).alias("sum_net"),
            F.count(on(c("net_profit"))).alias("n_net"),
            total(c("size")).alias("sum_size"),
            F.count(on(c("size"))).alias("n_size"),
            total(c("pips_gained")).alias("sum_pips"),
            F.count(on(c("pips_gained"))).alias("n_pips"),
            total(c("trade_duration_minutes")).alias("sum_minutes"),
            F.count(on(c("trade_duration_minutes"))).alias("n_minutes"),
            total(c("ret")).alias("sum_ret"),
            total((c("ret") * c("ret")).cast("decimal(38,0)")).alias("sum_ret_sq"),
            F.count(on(c("ret"))).alias("n_ret"),
            total(F.when(c("trade_scalping") == 1, c("net_profit"))).alias("sum_scalping_net"),
            total(F.when(c("overnight_trade") == 1, c("net_profit"))).alias("sum_overnight_net"),
            total(c("profit")).alias("sum_profit"),
            F.max(on(c("profit"))).alias("max_profit"),
            F.min(on(c("profit"))).alias("min_profit"),
            (F.count_if(~opened) if closes else F.lit(0).cast("long")).alias("n_closes"),
        )
    )


def rounded_sql(value, digits):
    """SQL text of float_round."""
    if digits == 0:
        return f"rint({value})"
    return f"rint(({value}) * {10**digits}.0D) / {10**digits}.0D"


def mean_return_sql(total, n):
    """Mean return of `n` returns that sum to `total` units."""
    return rounded_sql(f"try_divide(cast({total} as double) / {RETURN_UNIT}D, {n})", 4)


def std_return_sql(total, squares, n):
    """Sample deviation from exact sums; NULL below two returns."""
    n = f"cast({n} as decimal(19,0))"
    spread = f"cast({n} * {squares} - {total} * {total} as double)"
    return rounded_sql(f"sqrt(try_divide({spread}, cast({n} * ({n} - 1) as double))) / {RETURN_UNIT}D", 4)


def measure_sql(m):
    """Aggregate over cells as SQL text; NULL where nothing matches."""
    conditions = []
    if m.won is not None:
        conditions.append(f"trade_won = {m.won}")
    if m.side is not None:
        conditions.append(f"type = '{m.side}'")
    pick = (lambda c: f"case when {' and '.join(conditions)} then {c} end") if conditions else (lambda c: c)
    total = lambda c: f"sum({pick(c)})"

    if m.how == "closes":
        return total("n_closes")
    if m.how == "count":
        return total(f"n_{m.base}")
    if m.how in ("max", "min"):
        return f"cast({m.how}({pick(f'{m.how}_{m.base}')}) as double)"
    if m.how == "sum":
        value = f"cast({total(f'sum_{m.base}')} as double)"
        return value if m.digits is None else rounded_sql(value, m.digits)
    if m.how == "mean":
        return rounded_sql(f"try_divide(cast({total(f'sum_{m.base}')} as double), {total(f'n_{m.base}')})", m.digits)
    if m.how == "mean_return":
        return mean_return_sql(total("sum_ret"), total("n_ret"))
    if m.how == "std_return":
        return std_return_sql(total("sum_ret"), total("sum_ret_sq"), total("n_ret"))
    raise ValueError(f"unknown aggregation {m.how}")


def measure_column(m):
    return F.expr(f"{measure_sql(m)} as {m.name}")


def roll_up(cells, keys, measures, extra=()):
    """Cells to one row per key with the given measures."""
    return cells.groupBy(*keys).agg(*map(measure_column, measures), *extra)


def zero(measure):
    return "0L" if is_count(measure) else "0.0D"


def zero_filled(measure):
    return f"coalesce({measure.name}, {zero(measure)})"
