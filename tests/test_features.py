from pyspark.sql import functions as F
from decimal import Decimal

import pytest
from brute import cleaned as brute_cleaned
from brute import warehouse as brute_warehouse
from conftest import trade, trade_frame

from tradeloom.operators.cleaned import cleaned_features
from tradeloom.operators.dedupe import dedupe_last
from tradeloom.operators.features import trade_features, trade_history
from tradeloom.operators.skew import hot_keys, split_ledger

# ticket: minutes, pips, net, closed, won, cumulative, balance, initial, streak, return, sl, tp, scalping, overnight
EXPECTED = {
    1: (None, None, None, 0, 9999, None, 1000.0, None, 0, None, 0, 0, 0, 0),
    2: (1.0, 10.0, 9.5, 1, 1, 9.5, 1009.5, 1000.0, 0, 0.0095, 0, 1, 1, 0),
    3: (510.0, -100.0, -100.7, 1, -1, -111.2, 888.8, 1009.5, 0, -0.0998, 1, 0, 0, 1),
    4: (30.0, -10.0, -20.0, 1, -1, -111.2, 888.8, 888.8, 0, -0.0225, 0, 0, 0, 0),
    5: (10.0, -5.0, -5.0, 1, -1, -116.2, 883.8, 888.8, 1, -0.0056, 0, 0, 0, 0),
    6: (None, None, None, 0, 9999, -116.2, 783.8, 883.8, 0, None, 0, 0, 0, 0),
    7: (30.5, -10.0, -10.0, 1, -1, -126.2, 773.8, 783.8, 0, -0.0128, 0, 0, 0, 0),
    8: (1440.0, 0.0, 0.0, 1, 0, -126.2, 773.8, 773.8, 0, 0.0, 0, 0, 0, 1),
    9: (None, None, 4.0, 0, 9999, -122.2, 777.8, 773.8, 0, 0.0052, 0, 0, 0, 0),
    20: (2.0, 1.0, 1.0, 1, 1, 1.0, 1.0, None, 0, None, 0, 0, 0, 0),
    21: (None, None, None, 0, 9999, 1.0, 0.0, 1.0, 0, None, 0, 0, 0, 0),
    22: (2.0, 2.0, 2.0, 1, 1, 3.0, 2.0, 0.0, 0, None, 0, 0, 0, 0),
    23: (480.0, -100.0, None, 1, 9999, 3.0, -8.0, 2.0, 0, None, 0, 0, 0, 0),
}
COLUMNS = [
    "minutes_spent", "pips_gained", "net_profit", "trade_closed", "trade_won", "cumulative_profit", "balance", "initial_balance",
    "three_consecutive_losses", "trade_return", "sl_triggered", "tp_triggered", "trade_scalping", "overnight_trade",
]

# No hot accounts, the larger account hot, all accounts hot.
HOT_ROWS = [1000, 6, 0]


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


@pytest.mark.parametrize("hot_rows", HOT_ROWS)
def test_edge_fixture(edge_raw, hot_rows):
    rows = trade_features(split_ledger(edge_raw, "row_idx", hot_rows)).collect()
    got = {r["ticket"]: tuple(plain(r[c]) for c in COLUMNS) for r in rows}
    assert got == EXPECTED


def test_streak_of_cleaned_path_skips_balance_rows(edge_raw):
    rows = cleaned_features(split_ledger(edge_raw, "row_idx")).collect()
    flags = {r["ticket"]: r["three_consecutive_losses"] for r in rows}
    assert flags[5] == 1 and flags[7] == 1
    overnight = {r["ticket"]: r["overnight_trade"] for r in rows}
    assert overnight[3] == 0 and overnight[8] == 1
    assert 6 not in flags


def test_history_has_trades_only(edge_raw):
    rows = trade_history(trade_features(split_ledger(edge_raw, "row_idx"))).collect()
    assert {r["type"] for r in rows} == {"buy", "sell"} and len(rows) == 10


@pytest.mark.parametrize("hot_rows", [10_000, 100, 0])
def test_warehouse_features_match_brute_force(spark, skewed_rows, hot_rows):
    frame = trade_frame(spark, skewed_rows)
    assert hot_keys(frame, "account_nr", 100).count() == 1
    rows = trade_features(split_ledger(frame, hot_rows=hot_rows)).collect()
    got = {
        (r["account_nr"], r["ticket"]): (
            r["cumulative_profit"], r["balance"], r["initial_balance"], r["trade_won"], r["three_consecutive_losses"],
        )
        for r in rows
    }
    assert got == brute_warehouse(skewed_rows)
    assert sum(v[4] for v in got.values()) > 0


@pytest.mark.parametrize("hot_rows", [10_000, 100, 0])
def test_cleaned_features_match_brute_force(spark, skewed_rows, hot_rows):
    rows = cleaned_features(split_ledger(trade_frame(spark, skewed_rows), hot_rows=hot_rows)).collect()
    got = {
        (r["account_nr"], r["ticket"]): (
            r["net_profit"], r["cumulative_profit"], r["balance"], r["initial_balance"], r["trade_return"], r["trade_won"],
            r["trade_duration_minutes"], r["pips_gained"], r["sl_triggered"], r["tp_triggered"], r["trade_scalping"],
            r["overnight_trade"], r["three_consecutive_losses"], r["high_drawdown"],
        )
        for r in rows
    }
    want = {
        (r["account_nr"], r["ticket"]): (
            r["net"], r["cumulative"], r["balance"], r["initial"], r["ret"], r["won"], r["minutes"], r["pips"], r["sl"],
            r["tp"], r["scalping"], r["overnight"], r["streak"], r["drawdown"],
        )
        for r in brute_cleaned(skewed_rows)
    }
    assert got == want


def test_one_second_may_hold_a_whole_account(spark):
    """All rows share one opening second; ticket ranges still split and order them."""
    rows = [
        trade(5, (n << 19) + n, "buy", "eurusd", "2024-03-01 09:00:00", "2024-03-01 09:30:00", size=1, open_price=1, close_price=1,
              commission=0, swap=0, profit=-1 if n % 5 else 1)
        for n in range(40)
    ]
    rows = trade_features(split_ledger(trade_frame(spark, rows), hot_rows=0)).orderBy("ticket").collect()
    assert [r["three_consecutive_losses"] for r in rows] == [int(n % 5 >= 3) for n in range(40)]
    assert {r["balance"] for r in rows} == {Decimal("-24.000000")}
    assert rows[0]["initial_balance"] is None and rows[1]["initial_balance"] == Decimal("-24.000000")


def test_dedupe_keeps_last_of_many_copies(spark):
    rows = [trade(1, 7, "buy", "eurusd", "2024-01-01 09:00:00", profit=n) for n in range(200)]
    frame = trade_frame(spark, rows)
    kept = dedupe_last(frame, "profit").collect()
    assert len(kept) == 1 and kept[0]["profit"] == 199
    plan = dedupe_last(frame, "profit")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ordinary_plan_has_one_exchange_on_account(spark, edge_raw):
    plan = trade_features(split_ledger(edge_raw, "row_idx"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(account_nr") == 1


def test_null_keys_give_equal_rows_on_every_path(spark, skewed_rows):
    """A NULL ticket, opening time or account loses no row, whatever counts as hot."""
    rows = [dict(r) for r in skewed_rows[:200]]
    by_account = {}
    for r in rows:
        by_account.setdefault(r["account_nr"], []).append(r)
    for own in by_account.values():
        own[0]["ticket"] = None
        if len(own) > 2:
            own[1]["open_datetime"] = own[1]["open_date_key"] = None
    rows.append(dict(rows[-1], account_nr=None, ticket=77))
    frame = trade_frame(spark, rows)
    results = [
        sorted(map(repr, trade_features(split_ledger(frame, hot_rows=hot)).select(*COMPARED).collect())) for hot in (10_000, 20, 0)
    ]
    assert len(results[0]) == len(rows) and results[0] == results[1] == results[2]


COMPARED = ["account_nr", "ticket", "open_datetime", "cumulative_profit", "balance", "initial_balance", "three_consecutive_losses"]


def test_last_day_ends_calendar_and_report(spark, edge_raw):
    from tradeloom.plans.cubes import daily_main
    from tradeloom.plans.kpi import kpi_report

    cleaned = cleaned_features(split_ledger(edge_raw, "row_idx"))
    for last_day, accounts in (("2023-12-31", 0), ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-09", 2)):
        days = daily_main(cleaned, last_day).select("account_nr", F.col("calendar_day").cast("string")).collect()
        assert {d for _, d in days} <= {f"2024-01-{k:02d}" for k in range(1, int(last_day[-2:]) + 1)}
        assert len({a for a, _ in days}) == accounts
        assert kpi_report(cleaned, last_day).count() == accounts
