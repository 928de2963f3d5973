"""Column lists, types and fixed values shared by the package."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 6)
TOTAL = "decimal(28,6)"

# Ledger row types and feature codes.
TRADE_TYPES = ("buy", "sell")
LEDGER_TYPES = ("buy", "sell", "balance")
WON, LOST, NEUTRAL, UNDECIDED = 1, -1, 0, 9999

# Currency code to currency name.
CURRENCY_NAMES = {
    "GBP": "POUND STERLING",
    "USD": "US DOLLARS",
    "CAD": "CANADIAN DOLLARS",
}

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

TEXT_TIMESTAMP = "yyyy.MM.dd HH:mm:ss"
ROW_KEY_SEPARATOR = "-;-"

TRADE_SCHEMA = T.StructType(
    [
        T.StructField("account_nr", T.LongType()),
        T.StructField("ticket", T.LongType()),
        T.StructField("open_datetime", T.TimestampNTZType()),
        T.StructField("close_datetime", T.TimestampNTZType()),
        T.StructField("open_date_key", T.LongType()),
        T.StructField("close_date_key", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("size", MONEY),
        T.StructField("open_price", MONEY),
        T.StructField("close_price", MONEY),
        T.StructField("commission", MONEY),
        T.StructField("swap", MONEY),
        T.StructField("profit", MONEY),
        T.StructField("stop_loss", MONEY),
        T.StructField("take_profit", MONEY),
    ]
)
TRADE_COLUMNS = TRADE_SCHEMA.fieldNames()
MONEY_COLUMNS = [f.name for f in TRADE_SCHEMA if f.dataType == MONEY]

ACCOUNT_SCHEMA = T.StructType(
    [
        T.StructField("account_number", T.LongType()),
        T.StructField("account_name", T.StringType()),
        T.StructField("account_currency", T.StringType()),
    ]
)
ACCOUNT_COLUMNS = ACCOUNT_SCHEMA.fieldNames()

# Cleaned fact files spell three columns differently from the warehouse.
FACT_FILE_NAMES = {"account_nr": "account_number", "stop_loss": "sl", "take_profit": "tp"}
ACCOUNT_FILE_NAMES = {
    "account_number": "acct_nr",
    "account_name": "acct_name",
    "account_currency": "acct_currency",
}

GRID_WIDTH = 14
GRID_CELLS = [f"c{i}" for i in range(GRID_WIDTH)]
GRID_SCHEMA = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("row_idx", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in GRID_CELLS]
)

# Statement cell position to trade column (cell 11 is unused).
GRID_TO_TRADE = {
    "c0": "ticket",
    "c1": "open_datetime",
    "c2": "type",
    "c3": "size",
    "c4": "symbol",
    "c5": "open_price",
    "c6": "stop_loss",
    "c7": "take_profit",
    "c8": "close_datetime",
    "c9": "close_price",
    "c10": "commission",
    "c12": "swap",
    "c13": "profit",
}
GRID_PREAMBLE_ROWS = 4
HTML_HEADER_ROW = 2

# Columns published by the gold views.
GOLD_TRADE_COLUMNS = [
    "account_nr",
    "ticket",
    "open_date_key",
    "close_date_key",
    "open_time",
    "close_time",
    "type",
    "symbol",
    "size",
    "open_price",
    "close_price",
    "commission",
    "swap",
    "profit",
    "stop_loss",
    "take_profit",
    "minutes_spent",
    "pips_gained",
    "net_profit",
    "trade_closed",
    "trade_won",
    "cumulative_profit",
    "balance",
    "initial_balance",
    "three_consecutive_losses",
    "trade_return",
    "sl_triggered",
    "tp_triggered",
    "trade_scalping",
    "overnight_trade",
]
GOLD_ACCOUNT_COLUMNS = ["account_number", "account_name", "account_currency", "currency_name"]
GOLD_DATE_COLUMNS = [
    "cal_date",
    "date_key",
    "cal_year",
    "cal_quarter",
    "quarter_name",
    "quarter_ending",
    "cal_month",
    "month_name",
    "month_start",
    "month_end",
    "week_year_num",
    "week_of_year",
    "week_month_num",
    "week_of_month",
    "week_day_num",
    "cal_day",
    "day_name",
    "is_business_day",
]
GOLD_CLOCK_COLUMNS = [
    "clock",
    "clock_hour",
    "clock_minute",
    "clock_second",
    "is_working_hour",
    "is_daytime",
    "part_of_day",
    "part_of_day_num",
]
