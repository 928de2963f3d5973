import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tradeloom.schemas import MONEY_COLUMNS, TRADE_COLUMNS, TRADE_SCHEMA
from tradeloom.session import build_session

# 14 raw trades: row|account|ticket|type|symbol|open|close|size|open_price|close_price|commission|swap|profit|sl|tp
EDGE = """
1|1001|1|balance||2024-01-01 08:00:00|||||||1000||
2|1001|2|buy|eurusd|2024-01-01 09:00:00|2024-01-01 09:01:00|0.1|1.1000|1.1010|0.5|0|10|1.0950|1.1010
3|1001|3|sell|gbpusd|2024-01-01 10:00:00|2024-01-01 18:30:00|0.1|1.2500|1.2600|0.5|0.2|-100|1.2600|1.2400
4|1001|4|buy|eurusd|2024-01-01 10:00:00|2024-01-01 10:30:00|0.2|1.1010|1.1000|0|0|-20||
5|1001|5|buy|eurusd|2024-01-02 09:00:00|2024-01-02 09:10:00|0.1|1.1000|1.0995|0|0|-5||
6|1001|6|balance||2024-01-02 10:00:00|||||||-100||
7|1001|7|sell|usdjpy|2024-01-02 11:00:00|2024-01-02 11:30:30|0.1|1.4500|1.4510|0|0|-10||
8|1001|8|buy|eurusd|2024-01-03 09:00:00|2024-01-04 09:00:00|0.1|1.1000|1.1000|0|0|0||
9|1001|9|buy|eurusd|2024-01-05 09:00:00||0.1|1.1000||0|0|3||
10|1001|9|buy|eurusd|2024-01-05 09:00:00||0.1|1.1000||0|0|4||
11|1002|20|buy|gbpusd|2024-01-02 09:00:00|2024-01-02 09:02:00|0.1|1.2000|1.2001|0|0|1||
12|1002|21|balance||2024-01-02 10:00:00|||||||-1||
13|1002|22|buy|gbpusd|2024-01-02 11:00:00|2024-01-02 11:01:59|0.1|1.2000|1.2002|0|0|2||
14|1002|23|buy|gbpusd|2024-01-03 09:00:00|2024-01-03 17:00:00|0.1|1.2000|1.1900||0|-10||
"""


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def trade(account, ticket, type_, symbol, opened, closed=None, **money):
    """One trade as a dict; times as text, money as anything Decimal takes."""
    parse = lambda t: dt.datetime.fromisoformat(t) if t else None
    key = lambda t: int(t.strftime("%Y%m%d")) if t else None
    row = dict.fromkeys(TRADE_COLUMNS)
    opened, closed = parse(opened), parse(closed)
    row.update(
        account_nr=account,
        ticket=ticket,
        type=type_,
        symbol=symbol,
        open_datetime=opened,
        close_datetime=closed,
        open_date_key=key(opened),
        close_date_key=key(closed),
    )
    for c in MONEY_COLUMNS:
        value = money.get(c)
        row[c] = None if value in (None, "") else Decimal(str(value)).quantize(Decimal("0.000001"))
    return row


def trade_frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in TRADE_COLUMNS) for r in rows], TRADE_SCHEMA)


def edge_rows():
    out = []
    for line in EDGE.strip().splitlines():
        idx, account, ticket, type_, symbol, opened, closed, *money = line.split("|")
        names = ["size", "open_price", "close_price", "commission", "swap", "profit", "stop_loss", "take_profit"]
        row = trade(int(account), int(ticket), type_, symbol or None, opened, closed, **dict(zip(names, money)))
        out.append((int(idx), row))
    return out


@pytest.fixture(scope="session")
def edge_raw(spark):
    rows = edge_rows()
    schema = type(TRADE_SCHEMA)(list(TRADE_SCHEMA.fields)).add("row_idx", "long")
    return spark.createDataFrame([(*[r[c] for c in TRADE_COLUMNS], i) for i, r in rows], schema)


@pytest.fixture(scope="session")
def skewed_rows():
    """Random trades: one account has most rows, with shared seconds and several ticket ranges."""
    import random

    rng = random.Random(7)
    rows = []
    for n in range(600):
        account = 1 if rng.random() < 0.6 else rng.randint(2, 12)
        ticket = n + (rng.randint(0, 3) << 20) + (n << 23)
        opened = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 0, 1, 2, 5, 9]), hours=rng.randint(8, 9), minutes=rng.choice([0, 30]))
        closed = opened + dt.timedelta(seconds=rng.choice([30, 89, 90, 119, 120, 30600, 90000])) if rng.random() < 0.9 else None
        type_ = rng.choice(["buy", "sell", "buy", "sell", "balance"])
        if type_ == "balance":
            rows.append(trade(account, ticket, type_, None, str(opened), profit=rng.choice([1000, -500])))
            continue
        price = Decimal("1.1")
        close_price = price + Decimal(rng.randint(-20, 20)) / 10000 if closed else None
        rows.append(
            trade(
                account,
                ticket,
                type_,
                rng.choice(["eurusd", "gbpusd", "usdjpy"]),
                str(opened),
                str(closed) if closed else None,
                size=rng.choice(["0.1", "0.25", "1"]),
                open_price=price,
                close_price=close_price,
                commission=rng.choice([None, "0.5", "0"]),
                swap=rng.choice(["0", "0.02"]),
                profit=rng.choice([-100, -20, -5, 0, 1, 10, 250]) if closed else 0,
                stop_loss=rng.choice([None, "1.09", close_price]),
                take_profit=rng.choice([None, "1.11", close_price]),
            )
        )
    return rows
