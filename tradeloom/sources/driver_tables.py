"""Trades and accounts derived from the order tables of the test data."""

from pyspark.sql import functions as F

from tradeloom.functions.columns import money
from tradeloom.operators import skew
from tradeloom.operators.dedupe import dedupe_last
from tradeloom.operators.skew import HOT_ROWS, split_ledger
from tradeloom.schemas import GRID_CELLS, GRID_TO_TRADE
from tradeloom.session import stored

# Symbol by supplier number modulo 8, currency by nation number modulo 4.
SYMBOLS = ["eurusd", "gbpusd", "usdjpy", "audusd", "usdcad", "nzdusd", "eurgbp", "xauusd"]
CURRENCIES = ["GBP", "USD", "CAD", "EUR"]


def read_table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# What the order tables contribute to a trade; everything else is derived from these.
LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "o_orderdate",
]


def order_lines(spark, sf_dir, latest=False):
    """Order lines with account, ticket and the `row_order` that ranks copies of a ticket.

    latest: of the copies of one line of an order only the last, found where the lines of an order meet for the join.
    """
    row_order = F.struct("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    lines = read_table(spark, sf_dir, "lineitem")
    if latest:
        together = lines.repartition("l_orderkey").withColumn("row_order", row_order)
        lines = dedupe_last(together, keys=("l_orderkey", "l_linenumber")).drop("row_order")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("account_nr"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket"),
        *LINE_COLUMNS,
        row_order.alias("row_order"),
    )


def raw_trades(spark, sf_dir):
    """One trade per order line, with repeated tickets and their `row_order`."""
    lines = order_lines(spark, sf_dir)
    return lines_to_trades(lines, keep=["row_order"])


def latest_ledger(spark, sf_dir, hot_rows=HOT_ROWS):
    """The last copy of each ticket, split by account size.

    Trades are derived after the shuffle: fewer and narrower columns travel, and only the
    copies that stay are computed. Of large tables the copies within an order go before that.
    """
    large = line_count(spark, sf_dir) > hot_rows
    hot = None
    if large and most_lines(spark, sf_dir, hot_rows) > hot_rows:
        hot = skew.hot_keys(order_lines(spark, sf_dir), "account_nr", hot_rows)
    # The ticket is made of columns that travel anyway.
    lines = order_lines(spark, sf_dir, latest=large).drop("ticket")
    ledger = split_ledger(lines, hot_rows=hot_rows, hot=hot, most_rows=hot_rows)
    numbered = ledger.map(lambda part: part.withColumn("ticket", F.col("l_orderkey") * 10 + F.col("l_linenumber")))
    return numbered.map(dedupe_last).map(lines_to_trades)


def line_count(spark, sf_dir):
    """Rows of the order lines, from the footers of their files."""
    return read_table(spark, sf_dir, "lineitem").count()


def most_lines(spark, sf_dir, hot_rows=HOT_ROWS):
    """A number of lines that no account exceeds: the footers' count if that is at most `hot_rows`.

    Otherwise the most orders of an account times the most lines of an order, which takes two keys and no join.
    """
    count = line_count(spark, sf_dir)
    if count <= hot_rows:
        return count
    most = lambda name, key: read_table(spark, sf_dir, name).filter(F.col(key).isNotNull()).groupBy(key).count().agg(F.max("count")).first()[0] or 0
    return min(count, most("orders", "o_custkey") * most("lineitem", "l_orderkey"))


def latest_trades(spark, sf_dir):
    """The last copy of each ticket as one frame."""
    return latest_ledger(spark, sf_dir).union()


def stored_trades(spark, sf_dir):
    """The latest trades, written once for queries that read them several times."""
    return stored(latest_trades(spark, sf_dir), "latest-trades")


def lines_to_trades(lines, keep=()):
    """Derive the trade columns of order lines."""
    lines = lines.select("account_nr", "ticket", *LINE_COLUMNS, "row_order", "row_order.*")
    balance = "(l_linenumber = 7 and l_orderkey % 3 = 0)"
    pending = "(l_linestatus = 'O' and l_orderkey % 5 = 0)"
    second = "(l_partkey * 97 + l_linenumber * 3571) % 86400"
    code, quantity = "(l_partkey + l_orderkey) % 10", "cast(l_quantity as int)"
    duration = f"case {code} when 0 then 30 + {quantity} when 1 then 28800 + {quantity} * 600 else {quantity} * 300 end"
    open_price = _money("1 + cast(l_partkey % 5000 as decimal(18,6)) / 10000")
    symbols = ", ".join(f"'{symbol}'" for symbol in SYMBOLS)
    base = lines.selectExpr(
        "*",
        f"{balance} as is_balance",
        f"{pending} as is_open",
        f"{open_price} as open_px",
        _money(f"{open_price} + {_money('(cast(l_discount as decimal(18,6)) - 0.05) / 10')}") + " as close_px",
        _money("cast(l_quantity as decimal(18,6)) / 100") + " as size",
        f"""case when {balance} then 'balance' when l_returnflag = 'A' then 'buy' when l_returnflag = 'R' then 'sell'
            when l_partkey % 2 = 0 then 'buy' else 'sell' end as type""",
        f"timestampadd(SECOND, cast({second} as int), o_orderdate) as open_datetime",
        f"case when not {pending} then timestampadd(SECOND, cast({second} + {duration} as int), o_orderdate) end as close_datetime",
    )
    key = "cast(year({0}) * 10000 + month({0}) * 100 + dayofmonth({0}) as bigint)"
    parity = "(l_orderkey + l_linenumber) % 6"
    cell = lambda value, name: f"case when not is_balance then {_money(value)} end as {name}"
    return base.selectExpr(
        "account_nr",
        "ticket",
        "open_datetime",
        "close_datetime",
        f"{key.format('open_datetime')} as open_date_key",
        f"{key.format('close_datetime')} as close_date_key",
        "type",
        f"case when not is_balance then element_at(array({symbols}), cast(l_suppkey % 8 + 1 as int)) end as symbol",
        "size",
        "open_px as open_price",
        "case when not is_open then close_px end as close_price",
        cell("l_tax", "commission"),
        cell("case when l_linenumber % 2 = 0 then 0.02 else 0 end", "swap"),
        f"""case when is_balance then {_money("l_extendedprice")} when is_open then {_money("0")}
            else {_money("case when type = 'buy' then close_px - open_px else open_px - close_px end * size * 100000")} end as profit""",
        cell(f"case when {parity} = 0 then close_px else open_px - 0.01 end", "stop_loss"),
        cell(f"case when {parity} = 1 then close_px when {parity} <> 2 then open_px + 0.01 end", "take_profit"),
        *keep,
    )


def _money(value):
    return f"cast({value} as decimal(18,6))"


def accounts(spark, sf_dir):
    """One account per customer."""
    customers = read_table(spark, sf_dir, "customer")
    return customers.select(
        F.col("c_custkey").cast("long").alias("account_number"),
        F.col("c_name").alias("account_name"),
        F.element_at(F.array(*map(F.lit, CURRENCIES)), F.col("c_nationkey") % 4 + 1).alias("account_currency"),
    )


def ledger_as_of(trades, moment):
    """The trades as a statement taken at `moment` would show them."""
    moment = F.lit(moment).cast("timestamp_ntz")
    pending = F.col("close_datetime") >= moment
    hidden = {c: F.when(~F.coalesce(pending, F.lit(False)), F.col(c)) for c in ["close_datetime", "close_date_key", "close_price"]}
    hidden["profit"] = F.when(pending, money(F.lit(0))).otherwise(F.col("profit"))
    return trades.filter(F.col("open_datetime") < moment).withColumns(hidden)


def _cell_time(ts):
    return F.replace(F.substring(ts.cast("string"), 1, 19), F.lit("-"), F.lit("."))


def statement_grid(spark, sf_dir):
    """Raw trades laid out as statement grids, one file per account and opening year.

    Row positions come from the row itself (part, supplier, shipping day), not from a window.
    """
    c = F.col
    raw = raw_trades(spark, sf_dir)
    file = F.concat(F.lit("statement_"), c("account_nr").cast("string"), F.lit("_"), F.year("open_datetime").cast("string"))
    text = {cell: c(name).cast("string") for cell, name in GRID_TO_TRADE.items()}
    text["c1"], text["c8"] = _cell_time(c("open_datetime")), _cell_time(c("close_datetime"))
    text["c11"] = F.lit(None).cast("string")
    shipped = F.date_diff(c("row_order.l_shipdate").cast("date"), F.lit("1990-01-01").cast("date"))
    position = 4 + c("row_order.l_partkey") * 100_000_000 + (c("row_order.l_suppkey") % 10_000) * 10_000 + shipped
    body = raw.select(file.alias("file"), position.alias("row_idx"), *[text[cell].alias(cell) for cell in GRID_CELLS])

    files = raw.select(file.alias("file"), "account_nr").distinct()
    owners = files.join(accounts(spark, sf_dir), c("account_nr") == c("account_number"))
    empty = F.lit(None).cast("string")
    lines = [
        {"c0": F.lit("Statement")},
        {
            "c0": F.concat(F.lit("Account: "), c("account_nr").cast("string")),
            "c2": F.concat(F.lit("Name: "), c("account_name")),
            "c7": F.concat(F.lit("Currency: "), c("account_currency")),
        },
        {"c0": F.lit("Closed Transactions:")},
        {cell: F.lit(name) for cell, name in GRID_TO_TRADE.items()},
    ]
    preamble = owners.select(
        "file",
        F.posexplode(F.array(*[F.struct(*[line.get(cell, empty).alias(cell) for cell in GRID_CELLS]) for line in lines])).alias(
            "row_idx", "line"
        ),
    ).select("file", c("row_idx").cast("long").alias("row_idx"), "line.*")
    return body.unionByName(preamble)


# Header texts of the HTML statements and the trade columns they stand for.
HTML_COLUMNS = {
    "Ticket": "ticket",
    "Open Time": "open_datetime",
    "Type": "type",
    "Size": "size",
    "Item": "symbol",
    "Open Price": "open_price",
    "S / L": "stop_loss",
    "T / P": "take_profit",
    "Close Time": "close_datetime",
    "Close Price": "close_price",
    "Commission": "commission",
    "Swap": "swap",
    "Profit": "profit",
}
TICKETS_PER_DOCUMENT = 10_000


def html_statements(spark, sf_dir):
    """Latest trades as HTML documents of one account and at most 10,000 tickets each."""
    trades = latest_trades(spark, sf_dir)
    text = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in HTML_COLUMNS.values()}
    for name in ("open_datetime", "close_datetime"):
        text[name] = F.coalesce(_cell_time(F.col(name)), F.lit(""))
    cells = lambda values: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), v, F.lit("</td>")) for v in values], F.lit("</tr>"))
    part = F.floor(F.col("ticket") / TICKETS_PER_DOCUMENT).cast("string")
    docs = (
        trades.select(
            "account_nr",
            F.concat_ws("-", F.col("account_nr").cast("string"), part).alias("doc_id"),
            F.struct("ticket", cells(text.values()).alias("row")).alias("line"),
        )
        .groupBy("doc_id", "account_nr")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )
    title = cells([F.concat(F.lit("Account: "), F.col("account_nr").cast("string"))])
    return docs.select(
        "doc_id",
        F.concat(
            F.lit("<html><body><table>"),
            title,
            cells([F.lit("Closed Transactions:")]),
            cells([F.concat(F.lit("<b>"), F.lit(h), F.lit("</b>")) for h in HTML_COLUMNS]),
            F.array_join(F.col("lines.row"), "\n"),
            F.lit("</table><table><tr><td>Working Orders:</td></tr></table></body></html>"),
        ).alias("html"),
    )


def order_open_times(spark, sf_dir):
    """Opening times of the latest trades, for their date range."""
    return latest_trades(spark, sf_dir).select("open_datetime")


# Statements and rows with known faults, made from the tables by fixed rules.


def _account_of(file):
    return F.split_part(file, F.lit("_"), F.lit(2)).cast("long")


def damaged_grid(spark, sf_dir):
    """Statement grids where some files lack their header or all rows, and some rows cannot be read."""
    return damaged(statement_grid(spark, sf_dir))


def damaged(grid):
    """The faults of `damaged_grid` in a grid, which may be stored and may lack cells.

    On a stored grid the faults are no part of the method that makes the cells, which grows too large to be compiled with them.
    """
    account, year = _account_of(F.col("file")), F.split_part("file", F.lit("_"), F.lit(3))
    part = F.floor((F.col("row_idx") - 4) / 100_000_000)
    body = F.col("row_idx") >= 4
    gone = ((F.col("row_idx") == 1) & (account % 10 == 3)) | (body & (year == "1995") & (account % 10 == 7))
    broken = {"c0": (50, "n/a"), "c1": (70, "31.02.1996"), "c2": (90, "buy limit")}
    return grid.filter(~gone).withColumns(
        {c: F.when(body & (part % n == n // 5), F.lit(text)).otherwise(F.col(c)) for c, (n, text) in broken.items() if c in grid.columns}
    )


def damaged_html(spark, sf_dir):
    """HTML statements of which some have no table, no header row, other headers or no data rows."""
    docs = html_statements(spark, sf_dir)
    kind = F.split_part("doc_id", F.lit("-"), F.lit(1)).cast("long") % 10
    rows = F.split("html", "</tr>")
    cut = lambda n: F.concat(F.array_join(F.slice(rows, 1, n), "</tr>"), F.lit("</tr></table></body></html>"))
    return docs.withColumn(
        "html",
        F.when(kind == 1, F.lit("<html><body><p>No statement</p></body></html>"))
        .when(kind == 2, cut(2))
        .when(kind == 3, cut(3))
        .when(kind == 4, F.replace(F.col("html"), F.lit("<b>"), F.lit("<b>Old ")))
        .otherwise(F.col("html")),
    )


def flawed_trades(spark, sf_dir):
    """Raw trades with missing values, overlong texts and unknown accounts."""
    ticket = F.col("ticket")
    spoilt = {
        "account_nr": F.when(ticket % 83 == 0, F.col("account_nr") + 1_000_000_000).otherwise(F.col("account_nr")),
        "open_datetime": F.when(ticket % 101 != 0, F.col("open_datetime")),
        "open_date_key": F.when(ticket % 79 != 0, F.col("open_date_key")),
        "type": F.when(ticket % 97 == 0, F.lit("b" * 26)).when(ticket % 103 != 0, F.col("type")),
        "symbol": F.when(ticket % 89 == 0, F.lit("s" * 51)).otherwise(F.col("symbol")),
    }
    return raw_trades(spark, sf_dir).withColumns(spoilt).withColumn("ticket", F.when(ticket % 107 != 0, ticket))


def flawed_accounts(spark, sf_dir):
    """Accounts with missing values, overlong texts and repeated numbers."""
    number = F.col("account_number")
    rows = accounts(spark, sf_dir)
    rows = rows.unionByName(rows.filter(number % 17 == 0))
    return rows.select(
        F.when(number % 23 != 0, number).alias("account_number"),
        F.when(number % 19 == 0, F.lit("n" * 256)).when(number % 11 != 0, F.col("account_name")).alias("account_name"),
        F.when(number % 13 == 0, F.lit("DOLLAR")).when(number % 29 != 0, F.col("account_currency")).alias("account_currency"),
    )


def staging_loads(spark, sf_dir, moments):
    """Three loads of trades: as of two moments, the second without a third of the tickets; then even tickets only."""
    trades = stored_trades(spark, sf_dir)
    first, second = (ledger_as_of(trades, m) for m in moments)
    return [first, second.filter("ticket % 3 <> 0"), trades.filter("ticket % 2 = 0")]


def account_loads(spark, sf_dir):
    """Two loads of accounts: all, then every seventh in another currency and every fifth left out."""
    first = accounts(spark, sf_dir)
    moved = F.when(F.col("account_number") % 7 == 0, F.lit("EUR")).otherwise(F.col("account_currency"))
    return [first, first.filter("account_number % 5 <> 0").withColumn("account_currency", moved)]
