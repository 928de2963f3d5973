"""Builds one SQL text per registered query from shared common table expressions."""

from tradeloom.operators.measures import DAILY_MAIN, DAILY_SUMMARY, side_measures
from tradeloom.schemas import (
    GOLD_ACCOUNT_COLUMNS,
    GOLD_DATE_COLUMNS,
    GOLD_TRADE_COLUMNS,
    MONEY_COLUMNS,
    TRADE_COLUMNS,
)

SNAPSHOT = "1999-01-01 00:00:00"
LOADS = ("1997-01-01 00:00:00", "1999-01-01 00:00:00")


def rint(y):
    return f"(case when ({y}) - floor({y}) = 0.5 then 2 * round(({y}) / 2) else round({y}) end)"


def fround(x, digits):
    if digits == 0:
        return rint(x)
    return f"{rint(f'({x}) * 1e{digits}::double')} / 1e{digits}::double"


def dbl(x):
    return f"cast({x} as double)"


def doubles(columns, decimals):
    return ", ".join(f"cast({c} as double) as {c}" if c in decimals else c for c in columns)


BASE = """
lines as (
  select o_custkey as account_nr, l_orderkey * 10 + l_linenumber as ticket, l.*, o_orderdate,
    l_linenumber = 7 and l_orderkey % 3 = 0 as is_bal,
    l_linestatus = 'O' and l_orderkey % 5 = 0 as is_open,
    (l_partkey * 97 + l_linenumber * 3571) % 86400 as sec,
    case (l_partkey + l_orderkey) % 10 when 0 then 30 + cast(l_quantity as int)
      when 1 then 28800 + cast(l_quantity as int) * 600 else cast(l_quantity as int) * 300 end as dur,
    (l_orderkey + l_linenumber) % 6 as parity,
    cast(1 + (l_partkey % 5000) / 10000.0 as decimal(18,6)) as open_px,
    cast(cast(1 + (l_partkey % 5000) / 10000.0 as decimal(18,6)) + cast((l_discount - 0.05) / 10 as decimal(18,6)) as decimal(18,6)) as close_px,
    cast(l_quantity / 100 as decimal(18,6)) as sz
  from lineitem l join orders o on l_orderkey = o_orderkey
),
sided as (
  select *, case when is_bal then 'balance' when l_returnflag = 'A' then 'buy' when l_returnflag = 'R' then 'sell'
      when l_partkey % 2 = 0 then 'buy' else 'sell' end as type,
    o_orderdate + to_seconds(sec) as open_datetime,
    case when not is_open then o_orderdate + to_seconds(sec + dur) end as close_datetime
  from lines
),
raw as (
  select account_nr, ticket, open_datetime, close_datetime,
    cast(strftime(open_datetime, '%Y%m%d') as bigint) as open_date_key,
    cast(strftime(close_datetime, '%Y%m%d') as bigint) as close_date_key,
    type,
    case when not is_bal then case l_suppkey % 8 when 0 then 'eurusd' when 1 then 'gbpusd' when 2 then 'usdjpy'
      when 3 then 'audusd' when 4 then 'usdcad' when 5 then 'nzdusd' when 6 then 'eurgbp' else 'xauusd' end end as symbol,
    sz as size, open_px as open_price,
    case when not is_open then close_px end as close_price,
    case when not is_bal then cast(l_tax as decimal(18,6)) end as commission,
    case when not is_bal then cast(case when l_linenumber % 2 = 0 then 0.02 else 0 end as decimal(18,6)) end as swap,
    case when is_bal then cast(l_extendedprice as decimal(18,6)) when is_open then cast(0 as decimal(18,6))
      else cast(cast((case when type = 'buy' then close_px - open_px else open_px - close_px end) * sz as decimal(22,8))
        * cast(100000 as decimal(6,0)) as decimal(18,6)) end as profit,
    case when not is_bal then case when parity = 0 then close_px else cast(open_px - 0.01 as decimal(18,6)) end end as stop_loss,
    case when not is_bal then case when parity = 1 then close_px when parity <> 2 then cast(open_px + 0.01 as decimal(18,6)) end end as take_profit,
    l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice
  from sided
),
trades as (
  select * from raw
  qualify row_number() over (partition by account_nr, ticket
    order by l_partkey desc, l_suppkey desc, l_shipdate desc, l_quantity desc, l_extendedprice desc) = 1
),
accounts as (
  select c_custkey as account_number, c_name as account_name,
    case c_nationkey % 4 when 0 then 'GBP' when 1 then 'USD' when 2 then 'CAD' else 'EUR' end as account_currency
  from customer
),
dim_account as (
  select *, case account_currency when 'GBP' then 'POUND STERLING' when 'USD' then 'US DOLLARS'
    when 'CAD' then 'CANADIAN DOLLARS' end as currency_name from accounts
)"""

FEATURES = """
f1 as (
  select *, date_diff('second', open_datetime, close_datetime) as secs,
    case type when 'buy' then (close_price - open_price) * 10000 when 'sell' then (open_price - close_price) * 10000 end as pips_gained,
    profit - commission - swap as net_profit,
    case when open_datetime is not null and close_datetime is not null then 1 else 0 end as trade_closed
  from trades
),
f2 as (
  select *, (20 * secs + 60) // 120 / 10.0 as minutes_spent,
    case when trade_closed = 1 and net_profit > 0 then 1 when trade_closed = 1 and net_profit < 0 then -1
      when trade_closed = 1 and net_profit = 0 then 0 else 9999 end as trade_won,
    sum(net_profit) over (partition by account_nr order by open_datetime) as cumulative_profit,
    sum(profit - coalesce(commission, 0) - coalesce(swap, 0)) over (partition by account_nr order by open_datetime) as balance
  from f1
),
f3 as (
  select *, lag(balance) over w as initial_balance,
    case when trade_won = -1 and lag(trade_won, 1) over w = -1 and lag(trade_won, 2) over w = -1 then 1 else 0 end as three_consecutive_losses
  from f2 window w as (partition by account_nr order by open_datetime, ticket)
),
features as (
  select *, strftime(open_datetime, '%H:%M:%S') as open_time, strftime(close_datetime, '%H:%M:%S') as close_time,
    case when initial_balance <> 0 then
      sign(net_profit) * sign(initial_balance)
      * cast((20000 * cast(abs(net_profit) * 1000000 as hugeint) + cast(abs(initial_balance) * 1000000 as hugeint))
        // (2 * cast(abs(initial_balance) * 1000000 as hugeint)) as double) / 10000 + 0.0::double end as trade_return,
    case when stop_loss = close_price then 1 else 0 end as sl_triggered,
    case when take_profit = close_price then 1 else 0 end as tp_triggered,
    case when trade_closed = 1 and minutes_spent < 2 then 1 else 0 end as trade_scalping,
    case when trade_closed = 1 and round(minutes_spent / 60, 0) > 8 then 1 else 0 end as overnight_trade
  from f3
)"""

FEATURE_DECIMALS = set(MONEY_COLUMNS) | {
    "minutes_spent",
    "pips_gained",
    "net_profit",
    "cumulative_profit",
    "balance",
    "initial_balance",
    "trade_return",
}
FEATURE_COLUMNS = [
    "account_nr", "ticket", "open_datetime", "close_datetime", "open_date_key", "close_date_key", "open_time", "close_time",
    "type", "symbol", "size", "open_price", "close_price", "commission", "swap", "profit", "stop_loss", "take_profit",
    "minutes_spent", "pips_gained", "net_profit", "trade_closed", "trade_won", "cumulative_profit", "balance",
    "initial_balance", "three_consecutive_losses", "trade_return", "sl_triggered", "tp_triggered", "trade_scalping",
    "overnight_trade",
]

CLEANED = f"""
c1 as (
  select *, cast(open_datetime as date) as open_date, cast(close_datetime as date) as close_date,
    strftime(open_datetime, '%H:%M:%S') as open_time, strftime(close_datetime, '%H:%M:%S') as close_time,
    date_diff('second', open_datetime, close_datetime) as secs,
    case when type = 'buy' then (close_price - open_price) * 10000 else (open_price - close_price) * 10000 end as pips_gained,
    profit - commission - swap as net_profit, profit - coalesce(commission, 0) - coalesce(swap, 0) as change,
    case when close_datetime is not null then 1 else 0 end as trade_closed
  from trades where type in ('buy', 'sell', 'balance')
),
c2 as (
  select *,
    secs // 60 + case when secs % 60 > 30 then 1 when secs % 60 = 30 then (secs // 60) % 2 else 0 end as trade_duration_minutes,
    case when net_profit is not null then sum(net_profit) over w end as cumulative_profit,
    case when change is not null then sum(change) over w end as balance,
    case when trade_closed = 1 and net_profit > 0 then 1 when trade_closed = 1 and net_profit < 0 then -1
      when trade_closed = 1 and net_profit = 0 then 0 else 9999 end as trade_won
  from c1
  window w as (partition by account_nr order by open_datetime nulls last, close_datetime nulls last, symbol nulls last, type, ticket
    rows unbounded preceding)
),
c3 as (
  select *, balance - coalesce(net_profit, 0) as initial_balance,
    {fround("(sum(profit) filter (trade_won = -1) over a)::double / count(*) filter (trade_won = -1) over a", 2)} as mean_loss,
    case when trade_won = -1 and lag(trade_won, 1) over w = -1 and lag(trade_won, 2) over w = -1 then 1 else 0 end as three_consecutive_losses
  from c2 where type in ('buy', 'sell')
  window a as (partition by account_nr),
    w as (partition by account_nr order by open_datetime nulls last, close_datetime nulls last, symbol nulls last, type, ticket)
),
cleaned as (
  select *,
    case when initial_balance <> 0 then {fround("net_profit::double / initial_balance::double", 4)} end as trade_return,
    case when stop_loss = close_price then 1 else 0 end as sl_triggered,
    case when take_profit = close_price then 1 else 0 end as tp_triggered,
    case when trade_closed = 1 and trade_duration_minutes < 2 then 1 else 0 end as trade_scalping,
    case when profit::double < mean_loss * 0.5 then 1 else 0 end as high_drawdown,
    case when trade_closed = 1 and {rint("trade_duration_minutes / 60.0::double")} > 8 then 1 else 0 end as overnight_trade
  from c3
)"""

CLEANED_COLUMNS = [
    "account_nr", "ticket", "open_datetime", "close_datetime", "open_date", "open_date_key", "close_date", "close_date_key",
    "open_time", "close_time", "type", "symbol", "size", "open_price", "close_price", "commission", "swap", "profit",
    "stop_loss", "take_profit", "trade_duration_minutes", "pips_gained", "net_profit", "cumulative_profit", "balance",
    "initial_balance", "trade_return", "trade_closed", "trade_won", "sl_triggered", "tp_triggered", "trade_scalping",
    "high_drawdown", "three_consecutive_losses", "overnight_trade",
]
CLEANED_SELECT = doubles(CLEANED_COLUMNS, FEATURE_DECIMALS)

# Trade column behind each measure base: (summed expression, extra condition for counts).
SUMMED = {
    "net": "net_profit",
    "size": "size",
    "pips": "pips_gained",
    "minutes": "trade_duration_minutes",
    "scalping_net": "case when trade_scalping = 1 then net_profit end",
    "overnight_net": "case when overnight_trade = 1 then net_profit end",
    "profit": "profit",
}
COUNTED = {
    "rows": "true",
    "closed": "trade_closed = 1",
    "ongoing": "trade_closed = 0",
    "stop_loss": "sl_triggered = 1",
    "take_profit": "tp_triggered = 1",
    "scalping": "trade_scalping = 1",
    "overnight": "overnight_trade = 1",
}


def measure_sql(m):
    """One conditional aggregate over trades."""
    conditions = []
    if m.won is not None:
        conditions.append(f"trade_won = {m.won}")
    if m.side is not None:
        conditions.append(f"type = '{m.side}'")
    where = " and ".join(conditions) or "true"
    if m.how == "count":
        return f"count(*) filter ({where} and {COUNTED[m.base]})"
    if m.how in ("max", "min"):
        return f"cast({m.how}({m.base}) filter ({where}) as double)"
    if m.how == "sum":
        value = f"cast(sum({SUMMED[m.base]}) filter ({where}) as double)"
        return value if m.digits is None else fround(value, m.digits)
    if m.how == "mean":
        value = SUMMED[m.base]
        return fround(f"cast(sum({value}) filter ({where}) as double) / nullif(count({value}) filter ({where}), 0)", m.digits)
    if m.how == "mean_return":
        return fround(
            f"cast(sum(cast(trade_return as decimal(24,4))) filter ({where}) as double) / nullif(count(trade_return) filter ({where}), 0)",
            m.digits,
        )
    if m.how == "std_return":
        # From whole ten-thousandths, so that exact halves are rounded alike everywhere.
        x = "cast(round(trade_return * 10000) as hugeint)"
        n, s, q = (f"{f} filter ({where})" for f in (f"count({x})", f"sum({x})", f"sum({x} * {x})"))
        return fround(f"sqrt(cast({n} * {q} - ({s}) * ({s}) as double) / nullif({n} * ({n} - 1), 0)) / 10000.0::double", m.digits)
    raise ValueError(m.how)


def zero_filled(measures, table, present="true"):
    return ", ".join(f"case when {present} then coalesce({table}.{m.name}, 0) else 0 end as {m.name}" for m in measures)


SIDE_MEASURES = {w: side_measures(w) for w in ("long", "short")}


def side_ctes(word):
    """Opened trades by opening day, closed ones by closing day, joined."""
    measures = [m for m in SIDE_MEASURES[word] if m.how != "closes"]
    side = measures[0].side
    return f"""
{word}_open as (
  select account_nr, open_date as day, symbol, {", ".join(f"{measure_sql(m)} as {m.name}" for m in measures)}
  from cleaned where type = '{side}' and symbol is not null group by all
),
{word}_close as (
  select account_nr, close_date as day, symbol, count(*) as n from cleaned
  where type = '{side}' and symbol is not null and close_date is not null group by all
),
{word}_rows as (
  select o.*, coalesce(n, 0) as {word}s_closed from {word}_open o left join {word}_close c using (account_nr, day, symbol)
)"""


DAYS = """
days as (
  select account_nr, day, lead(day) over (partition by account_nr order by day) - day - 1 as gap
  from (select distinct account_nr, open_date as day from cleaned where open_date is not null)
)"""

SUMMARY_ROWS = f"""
summary_rows as (
  select account_nr, open_date as day, symbol, {", ".join(f"{measure_sql(m)} as {m.name}" for m in DAILY_SUMMARY)}
  from cleaned where symbol is not null and open_date is not null group by all
)"""

DAY_COLUMNS = "d.account_nr, d.day as calendar_day, cast(strftime(d.day, '%Y%m%d') as bigint) as date_key, strftime(d.day, '%A') as day_name"
GAP = "cast(case when row_number() over (partition by d.account_nr, d.day order by r.symbol desc nulls last) = 1 then coalesce(gap, 0) else 0 end as int) as empty_days_after"


CALENDAR = """
calendar as (
  select account_nr, cast(unnest(generate_series(a, b, interval 1 day)) as date) as day
  from (select account_nr, min(open_date) as a, max(open_date) as b from cleaned group by 1)
)"""


def on_calendar(rows, measures):
    """Every day from the account's first to its last, with or without rows."""
    return f"""select {DAY_COLUMNS}, r.symbol, {zero_filled(measures, "r")}
from calendar d left join {rows} r on r.account_nr = d.account_nr and r.day = d.day"""


# With every calendar day; `joined` below holds days with trades only, for the sums of the report.
JOINED_FULL = """
joined_full as (
  select d.account_nr, d.day as calendar_day, cast(strftime(d.day, '%Y%m%d') as bigint) as date_key, strftime(d.day, '%A') as day_name,
    r.symbol, {values}
  from calendar d left join summary_rows r on r.account_nr = d.account_nr and r.day = d.day
  left join long_rows l on l.account_nr = r.account_nr and l.day = r.day and l.symbol = r.symbol
  left join short_rows s on s.account_nr = r.account_nr and s.day = r.day and s.symbol = r.symbol
)"""


def joined_full():
    """Zeros on empty days; NULL for a side without opened trades on a day with others."""
    values = [f"case when r.symbol is null then 0 else coalesce(r.{m.name}, 0) end as {m.name}" for m in DAILY_SUMMARY]
    for word, table in (("long", "l"), ("short", "s")):
        values += [
            f"case when r.symbol is null then 0 when {table}.{word}s_opened is null then null else coalesce({table}.{m.name}, 0) end as {m.name}"
            for m in SIDE_MEASURES[word]
        ]
    return JOINED_FULL.format(values=", ".join(values))


JOINED = f"""
joined as (
  select {DAY_COLUMNS}, r.symbol, {GAP}, {zero_filled(DAILY_SUMMARY, "r")},
    {", ".join(f"case when r.symbol is null then 0 else {w}_rows.{m.name} end as {m.name}" for w in SIDE_MEASURES for m in SIDE_MEASURES[w] if m.how != "none")}
  from days d left join summary_rows r on r.account_nr = d.account_nr and r.day = d.day
  left join long_rows on long_rows.account_nr = r.account_nr and long_rows.day = r.day and long_rows.symbol = r.symbol
  left join short_rows on short_rows.account_nr = r.account_nr and short_rows.day = r.day and short_rows.symbol = r.symbol
)"""
for _w in SIDE_MEASURES:
    # Side sums of present rows are zero-filled like the side tables themselves.
    for _m in SIDE_MEASURES[_w]:
        JOINED = JOINED.replace(
            f"else {_w}_rows.{_m.name} end",
            f"when {_w}_rows.{_w}s_opened is null then null else coalesce({_w}_rows.{_m.name}, 0) end",
        )

MAIN = f"""
main_rows as (
  select account_nr, open_date as day, {", ".join(f"{measure_sql(m)} as {m.name}" for m in DAILY_MAIN)}
  from cleaned where open_date is not null group by all
),
main_running as (
  select *, {fround("cast(sum(cast(coalesce(net_profit, 0) as decimal(28,4))) over (partition by account_nr order by day) as double)", 4)} as cumulative_profit
  from main_rows
),
spine as (
  select account_nr, cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as day
  from (select account_nr, min(open_date) as first_day, max(open_date) as last_day from cleaned group by 1)
),
main as (
  select {DAY_COLUMNS}, {zero_filled(DAILY_MAIN, "r")}, coalesce(r.cumulative_profit, 0) as cumulative_profit,
    last_value(r.cumulative_profit ignore nulls) over (partition by d.account_nr order by d.day) as carried_profit
  from spine d left join main_running r on r.account_nr = d.account_nr and r.day = d.day
)"""

CLOCK = """
clock as (
  select strftime(timestamp '2025-01-01' + to_seconds(s), '%H:%M:%S') as clock, s from range(86400) t(s)
),
dim_clock as (
  select clock, left(clock, 2) as clock_hour, substr(clock, 4, 2) as clock_minute, right(clock, 2) as clock_second,
    case when s between 32400 and 61200 then 1 else 0 end as is_working_hour,
    case when s between 21600 and 68399 then 1 else 0 end as is_daytime,
    case when s < 21600 then 'night' when s < 43200 then 'morning' when s < 61200 then 'afternoon'
      when s < 75600 then 'evening' else 'night' end as part_of_day,
    case when s < 21600 then 4 when s < 43200 then 1 when s < 61200 then 2 when s < 75600 then 3 else 4 end as part_of_day_num
  from clock
)"""

DATES = """
all_days as (
  select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d
  from (select cast(min(open_datetime) as date) as a, cast(max(open_datetime) as date) as b from trades)
),
dim_date as (
  select d as cal_date, cast(strftime(d, '%Y%m%d') as int) as date_key, cast(year(d) as int) as cal_year,
    cast(quarter(d) as int) as cal_quarter, 'q' || quarter(d) as quarter_name,
    case quarter(d) when 1 then '03' when 2 then '06' when 3 then '09' else '12' end || year(d) as quarter_ending,
    cast(month(d) as int) as cal_month, strftime(d, '%b') as month_name, cast(date_trunc('month', d) as date) as month_start,
    last_day(d) as month_end, cast(weekofyear(d) as int) as week_year_num, 'wk' || weekofyear(d) as week_of_year,
    cast((day(d) - 1) // 7 + 1 as int) as week_month_num, 'wk' || ((day(d) - 1) // 7 + 1) as week_of_month,
    cast(dayofweek(d) + 1 as int) as week_day_num, cast(day(d) as int) as cal_day, strftime(d, '%a') as day_name,
    case when dayofweek(d) in (0, 6) then 0 else 1 end as is_business_day
  from all_days
)"""


def grid_ctes():
    return """
grid as (
  select *, 'statement_' || account_nr || '_' || year(open_datetime) as file,
    4 + l_partkey * 100000000 + (l_suppkey % 10000) * 10000 + date_diff('day', date '1990-01-01', cast(l_shipdate as date)) as row_idx from raw
),
parsed as (
  select * from grid qualify row_number() over (partition by account_nr, ticket order by file desc, row_idx desc) = 1
)"""


SNAPSHOT_CTES = f"""
target as (
  select * replace (
    case when close_datetime >= timestamp '{SNAPSHOT}' then null else close_datetime end as close_datetime,
    case when close_datetime >= timestamp '{SNAPSHOT}' then null else close_date_key end as close_date_key,
    case when close_datetime >= timestamp '{SNAPSHOT}' then null else close_price end as close_price,
    case when close_datetime >= timestamp '{SNAPSHOT}' then 0 else profit end as profit)
  from (select {", ".join(TRADE_COLUMNS)} from trades) where open_datetime < timestamp '{SNAPSHOT}'
),
source as (select {", ".join(TRADE_COLUMNS)} from trades where ticket % 7 <> 0)"""


def as_of(moment):
    """The trades as a statement taken at `moment` shows them."""
    later = f"close_datetime >= timestamp '{moment}'"
    hidden = ", ".join(f"case when {later} then null else {c} end as {c}" for c in ("close_datetime", "close_date_key", "close_price"))
    return f"""select * replace ({hidden}, case when {later} then 0 else profit end as profit)
  from (select {", ".join(TRADE_COLUMNS)} from trades) where open_datetime < timestamp '{moment}'"""


def staged_ctes(loads, columns, key):
    """load1, load2, ... and staged1, staged2, ...: the table after each load, with the counts `state1`, ..."""
    out, names = [], [c for c in columns if c not in key]
    for n, sql in enumerate(loads, 1):
        out.append(f"load{n} as ({sql})")
        if n == 1:
            out.append("staged1 as (select *, 1 as load_nr, 1 as n_versions from load1)")
            out.append("state1 as (select 'new' as state from load1)")
            continue
        differs = " or ".join(f"l.{c} is distinct from s.{c}" for c in names)
        state = f"case when s.{key[0]} is null then 'new' when l.{key[0]} is null then 'gone' when {differs} then 'changed' else 'equal' end"
        both = f"load{n} l full join staged{n - 1} s on " + " and ".join(f"l.{k} = s.{k}" for k in key)
        pick = ", ".join(f"case when state in ('new', 'changed') then l_{c} else s_{c} end as {c}" for c in columns)
        sides = ", ".join(f"{t}.{c} as {t}_{c}" for t in "ls" for c in columns)
        out.append(f"both{n} as (select {state} as state, {sides}, s.load_nr, s.n_versions from {both})")
        out.append(f"""staged{n} as (select {pick}, case when state in ('new', 'changed') then {n} else load_nr end as load_nr,
    case when state in ('new', 'changed') then coalesce(n_versions, 0) + 1 else n_versions end as n_versions from both{n})""")
        out.append(f"state{n} as (select state from both{n})")
    return ",\n".join(out)


TRADE_LOADS = [as_of(LOADS[0]), f"select * from ({as_of(LOADS[1])}) where ticket % 3 <> 0",
    f"select {', '.join(TRADE_COLUMNS)} from trades where ticket % 2 = 0"]
ACCOUNT_LOADS = [
    "select * from accounts",
    "select * replace (case when account_number % 7 = 0 then 'EUR' else account_currency end as account_currency) from accounts where account_number % 5 <> 0",
]

DAMAGED_GRID = """
damaged as (
  select *, account_nr % 10 = 3 as headless, account_nr % 10 = 7 and year(open_datetime) = 1995 as emptied,
    l_partkey % 90 = 18 as bad_type, l_partkey % 50 = 10 as bad_ticket, l_partkey % 70 = 14 as bad_time from grid
),
reasons as (
  select *, case when headless then 'no account' when bad_type then 'other type' when bad_ticket then 'bad ticket' when bad_time then 'bad time' end as reason
  from damaged where not emptied
)"""

FLAWED = """
flawed as (
  select * replace (
    case when ticket % 83 = 0 then account_nr + 1000000000 else account_nr end as account_nr,
    case when ticket % 101 <> 0 then open_datetime end as open_datetime,
    case when ticket % 79 <> 0 then open_date_key end as open_date_key,
    case when ticket % 97 = 0 then repeat('b', 26) when ticket % 103 <> 0 then type end as type,
    case when ticket % 89 = 0 then repeat('s', 51) else symbol end as symbol,
    case when ticket % 107 <> 0 then ticket end as ticket) from raw
),
doubled as (select * from accounts union all select * from accounts where account_number % 17 = 0),
flawed_accounts as (
  select case when account_number % 23 <> 0 then account_number end as account_number,
    case when account_number % 19 = 0 then repeat('n', 256) when account_number % 11 <> 0 then account_name end as account_name,
    case when account_number % 13 = 0 then 'DOLLAR' when account_number % 29 <> 0 then account_currency end as account_currency
  from doubled
)"""


def kpi_sql():
    pct = lambda a, b, n, k="100": fround(f"{dbl(a)} / nullif({dbl(b)}, 0) * {k}::double", n)
    exact = lambda c: f"sum(cast({c} as decimal(28,6)))"
    counts = {
        "closed_trades": "trades_closed", "ongoing_trades": "trades_ongoing", "n_trades": "trades_opened", "n_wins": "trades_won",
        "n_longs": "longs_closed", "n_shorts": "shorts_closed", "longs_won": "longs_won", "shorts_won": "shorts_won",
        "n_losses": "trades_lost", "longs_lost": "longs_lost", "shorts_lost": "shorts_lost", "n_neutrals": "trades_neutral",
        "scalping_trades_won": "trade_scalping_won", "overnight_trades_won": "overnight_trade_won",
    }
    rounded = ["amount_won", "amount_lost", "long_amount_won", "long_amount_lost", "short_amount_won", "short_amount_lost"]
    plain = ["pips_won", "pips_lost", "scalping_amount_won", "scalping_amount_lost", "overnight_amount_won", "overnight_amount_lost"]
    return f"""
d_full as (
  select s.account_nr, s.day as calendar_day, j.symbol, coalesce(j.max_profit, 0) as max_profit, coalesce(j.max_loss, 0) as max_loss
  from spine s left join joined j on j.account_nr = s.account_nr and j.calendar_day = s.day
),
d_sums as (
  select account_nr, {", ".join(f"cast(coalesce(sum({v}), 0) as bigint) as {k}" for k, v in counts.items())},
    {", ".join(f"{fround(f'cast(coalesce({exact(c)}, 0) as double)', 2)} as {c}" for c in rounded)},
    {", ".join(f"cast(coalesce({exact(c)}, 0) as double) as {c}" for c in plain)},
    min(calendar_day) filter (trades_opened > 0) as start_date, max(calendar_day) filter (trades_opened > 0) as end_date
  from joined group by account_nr
),
best as (
  select account_nr, {fround("max_profit", 2)} as max_profit, calendar_day as max_profit_date, upper(symbol) as max_profit_symbol from d_full
  qualify row_number() over (partition by account_nr order by max_profit desc, calendar_day, symbol nulls first) = 1
),
worst as (
  select account_nr, {fround("max_loss", 2)} as max_loss, calendar_day as max_loss_date, upper(symbol) as max_loss_symbol from d_full
  qualify row_number() over (partition by account_nr order by max_loss, calendar_day, symbol nulls first) = 1
),
m_sums as (
  select account_nr, cast({exact("traded_lots")} as double) as lots_traded, cast({exact("pips_gained")} as double) as pips_gained,
    cast(sum(trade_scalping) as bigint) as scalping_trades, cast(sum(overnight_trade) as bigint) as overnight_trades,
    {", ".join(f"{fround(f'cast(sum(cast({c} as decimal(28,4))) as double) / count(*) * 100.0::double', 2)} as {a}" for c, a in (("avg_return", "average_return"), ("std_return", "std_return"), ("std_neg_return", "std_neg_return")))}
  from main group by account_nr
)
select d_sums.*, best.* exclude (account_nr), worst.* exclude (account_nr), m_sums.* exclude (account_nr),
  {pct("n_wins", "closed_trades", 0)} as win_rate, {pct("longs_won", "n_longs", 2)} as long_win_rate,
  {pct("shorts_won", "n_shorts", 2)} as short_win_rate,
  {pct("long_amount_won", "amount_won", 2)} as long_perc_amount_won, {pct("short_amount_won", "amount_won", 2)} as short_perc_amount_won,
  {pct("n_losses", "closed_trades", 0)} as loss_rate, {pct("longs_lost", "n_longs", 2)} as long_loss_rate,
  {pct("shorts_lost", "n_shorts", 2)} as short_loss_rate,
  {pct("long_amount_lost", "amount_lost", 2)} as long_perc_amount_lost, {pct("short_amount_lost", "amount_lost", 2)} as short_perc_amount_lost,
  {pct("n_neutrals", "closed_trades", 0)} as neutral_rate,
  {pct("amount_won", "n_wins", 2, "1")} as avg_win_profit, {pct("pips_won", "n_wins", 2, "1")} as avg_win_pips,
  {pct("amount_lost", "n_losses", 2, "1")} as avg_net_loss, {pct("pips_lost", "n_losses", 2, "1")} as avg_loss_pips,
  {pct("scalping_trades", "n_trades", 2)} as perc_scalping_trades, {pct("overnight_trades", "n_trades", 2)} as perc_overnight_trades,
  {pct("scalping_trades_won", "scalping_trades", 2)} as perc_scalping_trades_won,
  {pct("overnight_trades_won", "overnight_trades", 2)} as perc_overnight_trades_won,
  {", ".join(f"{pct(f'{k}_amount_{o}', f'amount_{o}', 2)} as perc_{k}_amount_{o}" for k in ("scalping", "overnight") for o in ("won", "lost"))},
  {fround("average_return / nullif(std_return, 0) * sqrt(252.0::double)", 2)} as sharpe_ratio,
  {fround("average_return / nullif(std_neg_return, 0) * sqrt(252.0::double)", 2)} as sortino_ratio,
  abs({fround("amount_won / nullif(amount_lost, 0)", 2)}) as profit_factor
from d_sums join best using (account_nr) join worst using (account_nr) join m_sums using (account_nr)"""


HISTOGRAM = """
limits as (
  select account_nr, case when min(minutes_spent) = max(minutes_spent) then min(minutes_spent) - 0.5 else min(minutes_spent) end as lo,
    case when min(minutes_spent) = max(minutes_spent) then max(minutes_spent) + 0.5 else max(minutes_spent) end as hi
  from main group by 1
),
bins as (select account_nr, lo, hi, cast(b as int) as bin from limits, range(1, 16) t(b)),
hits as (
  select m.account_nr, least(cast(floor(15 * (minutes_spent - lo) / (hi - lo)) as int) + 1, 15) as bin, count(*) as n
  from main m join limits using (account_nr) group by all
)
select account_nr, bin, lo + (hi - lo) / 15 * (bin - 1) as bin_start, lo + (hi - lo) / 15 * bin as bin_end, coalesce(n, 0) as days
from bins left join hits using (account_nr, bin)"""


def queries():
    """Query name -> SQL text."""
    with_ = lambda *ctes: "with " + ",".join(c for c in ctes)
    trades = doubles(TRADE_COLUMNS, FEATURE_DECIMALS)
    cleaned = with_(BASE, CLEANED)
    days = with_(BASE, CLEANED, DAYS, SUMMARY_ROWS)
    sides = with_(BASE, CLEANED, DAYS, SUMMARY_ROWS, side_ctes("long"), side_ctes("short"))
    main = with_(BASE, CLEANED, MAIN)
    history = f"{with_(BASE, FEATURES)} select {doubles(GOLD_TRADE_COLUMNS, FEATURE_DECIMALS)} from features where type in ('buy', 'sell')"
    dates = f"{with_(BASE, DATES)} select {', '.join(GOLD_DATE_COLUMNS)} from dim_date"
    accounts = f"{with_(BASE)} select {', '.join(GOLD_ACCOUNT_COLUMNS)} from dim_account"
    summary_amounts = {m.name: m for m in DAILY_SUMMARY}
    staged = staged_ctes(TRADE_LOADS, TRADE_COLUMNS, ["account_nr", "ticket"])
    staged_features = FEATURES.replace("from trades", "from staged3")
    out = {
        "dedupe_last": f"{with_(BASE)} select {trades} from trades",
        "trade_features": f"{with_(BASE, FEATURES)} select {doubles(FEATURE_COLUMNS, FEATURE_DECIMALS)} from features",
        "trade_history": history,
        "cleaned_features": f"{cleaned} select {CLEANED_SELECT} from cleaned",
        "dim_account": accounts,
        "dim_date": dates,
        "dim_clock": f"""{with_(BASE, CLOCK)} select c.*, coalesce(n, 0) as trades_opened from dim_clock c
left join (select strftime(open_datetime, '%H:%M:%S') as clock, count(*) as n from trades group by 1) t using (clock)""",
        "calendar_features": f"""{with_(BASE, DATES)}
select d as calendar_day, cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(year(d) as int) as year,
  (year(d) % 4 = 0 and year(d) % 100 <> 0) or year(d) % 400 = 0 as is_leap_year,
  dayofyear(d) = 1 as is_year_start, strftime(d, '%m%d') = '1231' as is_year_end, cast(quarter(d) as int) as quarter,
  'q' || quarter(d) as quarter_name, strftime(d, '%m%d') in ('0101', '0401', '0701', '1001') as is_quarter_start,
  strftime(d, '%m%d') in ('0331', '0630', '0930', '1231') as is_quarter_end, cast(month(d) as int) as month,
  strftime(d, '%B') as month_name, cast(day(last_day(d)) as int) as month_days, day(d) = 1 as is_month_start,
  d = last_day(d) as is_month_end, cast(weekofyear(d) as int) as week_of_year, cast(day(d) as int) as day,
  strftime(d, '%A') as day_name, cast(dayofyear(d) as int) as day_of_year, cast(isodow(d) - 1 as int) as day_of_week
from all_days""",
        "gold_trade_history": history,
        "gold_dim_account_info": accounts,
        "gold_dim_date": dates,
        "gold_dim_clock": f"""{with_(BASE, CLOCK)} select c.*, coalesce(n, 0) as trades_opened from dim_clock c
left join (select strftime(open_datetime, '%H:%M:%S') as clock, count(*) as n from trades group by 1) t using (clock)""",
        "daily_summary": f"{days},{CALENDAR} {on_calendar('summary_rows', DAILY_SUMMARY)}",
        "daily_main": f"{main} select * from main",
        "daily_long": f"{sides},{CALENDAR} {on_calendar('long_rows', SIDE_MEASURES['long'])}",
        "daily_short": f"{sides},{CALENDAR} {on_calendar('short_rows', SIDE_MEASURES['short'])}",
        "joined_cube": f"{sides},{CALENDAR},{joined_full()} select * from joined_full",
        "joined_summaries": f"{sides},{CALENDAR},{joined_full()} select * from joined_full",
        "kpi_report": f"{sides},{JOINED},{MAIN},{kpi_sql()}",
        "profit_curve": f"{main} select account_nr, calendar_day, cumulative_profit, carried_profit from main",
        "daily_net_profit": f"{main} select account_nr, calendar_day, net_profit from main",
        "pips_vs_duration": f"{main} select account_nr, calendar_day, minutes_spent, pips_gained from main",
        "duration_histogram": f"{main},{HISTOGRAM}",
        "symbol_wins": f"""{days} select account_nr, symbol, cast(sum(trades_won) as bigint) as trades_won,
  cast(sum(trades_lost) as bigint) as trades_lost from summary_rows group by 1, 2""",
        "symbol_amounts": f"""{days} select account_nr, symbol,
  {fround("cast(coalesce(sum(cast(amount_won as decimal(28,6))), 0) as double)", 2)} as amount_won,
  abs({fround("cast(coalesce(sum(cast(amount_lost as decimal(28,6))), 0) as double)", 2)}) as amount_lost
from summary_rows group by 1, 2""",
        "weekday_amounts": f"""{days}, {MAIN} select s.account_nr, strftime(s.day, '%A') as day_name,
  {fround("cast(coalesce(sum(cast(amount_won as decimal(28,6))), 0) as double)", 2)} as amount_won,
  abs({fround("cast(coalesce(sum(cast(amount_lost as decimal(28,6))), 0) as double)", 2)}) as amount_lost
from spine s left join summary_rows r on r.account_nr = s.account_nr and r.day = s.day group by 1, 2""",
        "statement_parse": f"{with_(BASE, grid_ctes())} select {trades} from parsed",
        "statement_accounts": f"""{with_(BASE, grid_ctes())} select distinct file, account_number as acct_nr, account_name as acct_name,
  account_currency as acct_currency from grid join accounts on account_nr = account_number""",
        "html_statement_rows": f"{with_(BASE)} select {trades} from trades",
        "recast_types": f"""{with_(BASE)} select cast(account_nr as varchar) as account_nr, ticket, open_datetime, close_datetime,
  close_date_key, case when type <> 'balance' then cast(size as double) end as size, cast(profit as double) as profit from raw""",
        "value_switch": f"""{with_(BASE)} select account_nr,
  case type when 'buy' then 'long' when 'sell' then 'short' else 'cash' end as side,
  case left(symbol, 3) when 'eur' then 'EURO' when 'gbp' then 'POUND STERLING' when 'usd' then 'US DOLLARS' end as base_currency,
  count(*) as n from raw group by all""",
        "row_identity": f"""{with_(BASE)} select distinct account_nr, ticket, type, symbol, open_date_key,
  concat_ws('-;-', account_nr, ticket, type, coalesce(symbol, '<null>'), open_date_key) as delta_id from raw""",
        "csv_roundtrip": f"{with_(BASE)} select {trades} from trades",
        "delta_append": f"""{with_(BASE, SNAPSHOT_CTES)}
select {trades} from (select {", ".join(TRADE_COLUMNS)} from trades except select * from target)""",
        "delta_stale": f"{with_(BASE, SNAPSHOT_CTES)} select {trades} from (select * from target except select * from source)",
        "delta_upsert": f"""{with_(BASE, SNAPSHOT_CTES)} select {trades} from source
union all select {trades} from target where (account_nr, ticket) not in (select (account_nr, ticket) from source)""",
        "validate_staging": f"""{with_(BASE, FLAWED)}
select 'trade_history' as table_name, 'not_null' as check_name, c as column_name, cast(n as bigint) as violations from (
  select unnest(['account_nr', 'ticket', 'open_datetime', 'open_date_key', 'type']) as c,
    unnest([count(*) - count(account_nr), count(*) - count(ticket), count(*) - count(open_datetime), count(*) - count(open_date_key), count(*) - count(type)]) as n from flawed)
union all select 'trade_history', 'max_length', 'type', count(*) from flawed where length(type) > 25
union all select 'trade_history', 'max_length', 'symbol', count(*) from flawed where length(symbol) > 50
union all select 'dim_account', 'not_null', 'account_number', count(*) from flawed_accounts where account_number is null
union all select 'dim_account', 'not_null', 'account_name', count(*) from flawed_accounts where account_name is null
union all select 'dim_account', 'not_null', 'account_currency', count(*) from flawed_accounts where account_currency is null
union all select 'dim_account', 'max_length', 'account_name', count(*) from flawed_accounts where length(account_name) > 255
union all select 'dim_account', 'max_length', 'account_currency', count(*) from flawed_accounts where length(account_currency) > 5
union all select 'trade_history', 'unique', 'ticket', count(*) from (select ticket from flawed where ticket is not null group by 1 having count(*) > 1)
union all select 'dim_account', 'unique', 'account_number', count(*) from (select account_number from flawed_accounts where account_number is not null group by 1 having count(*) > 1)
union all select 'trade_history', 'foreign_key', 'account_nr', count(*) from flawed
  where account_nr not in (select account_number from flawed_accounts where account_number is not null)""",
        "export_order": f"""{with_(BASE, DATES)}, sizes as (
select 'trade_history' as view_name, count(*) as n_rows from trades where type in ('buy', 'sell')
union all select 'dim_account_info', count(*) from accounts union all select 'dim_date', count(*) from dim_date
union all select 'dim_clock', 86400) select view_name, n_rows, n_rows as n_in_order from sizes""",
        "exported_trades": history,
        "exported_dates": dates,
        "staged_trades": f"{with_(BASE, staged)} select {trades}, cast(load_nr as bigint) as load_nr, cast(n_versions as bigint) as n_versions from staged3",
        "load_states": f"""{with_(BASE, staged)} select cast(1 as bigint) as load_nr, state, count(*) as n_rows from state1 group by 2
union all select 2, state, count(*) from state2 group by 2 union all select 3, state, count(*) from state3 group by 2""",
        "staged_accounts": f"""{with_(BASE, staged_ctes(ACCOUNT_LOADS, ["account_number", "account_name", "account_currency"], ["account_number"]))}
select account_number, account_name, account_currency, cast(load_nr as bigint) as load_nr, cast(n_versions as bigint) as n_versions from staged2""",
        "refreshed_features": f"{with_(BASE, staged, staged_features)} select {doubles(FEATURE_COLUMNS, FEATURE_DECIMALS)} from features",
        "selected_accounts": f"""{with_(BASE, staged, staged_features)} select {doubles(FEATURE_COLUMNS, FEATURE_DECIMALS)} from features
where account_nr in (select account_number from accounts where account_currency = 'GBP')""",
        "statement_rejects": f"""{with_(BASE, grid_ctes(), DAMAGED_GRID)}
select file, reason, count(*) as n_rows, min(row_idx) as first_row from reasons where reason is not null group by 1, 2
union all select distinct file, 'no rows', 1, null from damaged where emptied""",
        "accepted_trades": f"""{with_(BASE, grid_ctes(), DAMAGED_GRID)}
select {trades} from (select * from reasons where coalesce(reason, 'other type') = 'other type' and not bad_ticket
  qualify row_number() over (partition by account_nr, ticket order by file desc, row_idx desc) = 1) where reason is null""",
        "html_rejects": f"""{with_(BASE)} select distinct account_nr || '-' || (ticket // 10000) as doc_id,
  case account_nr % 10 when 1 then 'no table' when 2 then 'no header row' when 3 then 'no rows' else 'unknown header' end as reason
from trades where account_nr % 10 between 1 and 4""",
        "inbox_scan": f"""{with_(BASE)} select 'statement_' || account_nr as file, cast(case when account_nr % 4 = 0 then 2 else 1 end as bigint) as scan_nr,
  count(*) as n_rows, cast(sum(profit) as double) as profit, (select count(distinct account_nr) from raw) as n_files from raw group by 1, 2""",
        "named_scan": f"{with_(BASE)} select {trades} from trades",
        "export_gold": f"""{with_(BASE, DATES)}
select 'trade_history' as view_name, count(*) as n_rows from trades where type in ('buy', 'sell')
union all select 'dim_account_info', count(*) from accounts union all select 'dim_date', count(*) from dim_date
union all select 'dim_clock', 86400""",
        "account_counts": f"{with_(BASE)} select account_nr, count(*) as trades from trades group by 1",
        "star_report": f"""{with_(BASE, FEATURES, DATES, CLOCK)}
select currency_name, cal_year, cal_quarter, part_of_day, count(*) as trades, count(*) filter (trade_won = 1) as trades_won,
  cast(sum(net_profit) as double) as net_profit
from features f left join dim_date d on f.open_date_key = d.date_key left join dim_clock c on f.open_time = c.clock
left join dim_account a on a.account_number = f.account_nr where type in ('buy', 'sell') group by 1, 2, 3, 4""",
    }
    for name, column in {
        "risk_scalping": "trade_scalping", "risk_drawdown": "high_drawdown",
        "risk_streak": "three_consecutive_losses", "risk_overnight": "overnight_trade",
    }.items():
        out[name] = f"{cleaned} select {CLEANED_SELECT} from cleaned where {column} = 1"
    return out
