"""Plain Python versions of the per-trade and daily rules, for small fixtures."""

import datetime as dt
import math
from collections import defaultdict
from decimal import Decimal

FAR = dt.datetime(9999, 1, 1)
ZERO = Decimal(0)


def won_code(closed, net):
    if closed and net is not None:
        return (net > 0) - (net < 0)
    return 9999


def by_account(rows, order):
    groups = defaultdict(list)
    for r in rows:
        groups[r["account_nr"]].append(r)
    return {a: sorted(g, key=order) for a, g in groups.items()}


def net_of(r):
    parts = (r["profit"], r["commission"], r["swap"])
    return None if None in parts else parts[0] - parts[1] - parts[2]


def change_of(r):
    return r["profit"] - (r["commission"] or ZERO) - (r["swap"] or ZERO)


def warehouse(rows):
    """(account, ticket) -> (cumulative, balance, initial, won, streak)."""
    out = {}
    for account, group in by_account(rows, lambda r: (r["open_datetime"], r["ticket"])).items():
        previous = []
        for i, r in enumerate(group):
            upto = [x for x in group if x["open_datetime"] <= r["open_datetime"]]
            nets = [net_of(x) for x in upto if net_of(x) is not None]
            cumulative = sum(nets) if nets else None
            balance = sum(change_of(x) for x in upto)
            won = won_code(r["close_datetime"] is not None, net_of(r))
            streak = int(won == -1 and [w for _, w in previous[-2:]] == [-1, -1])
            initial = previous[-1][0] if previous else None
            out[account, r["ticket"]] = (cumulative, balance, initial, won, streak)
            previous.append((balance, won))
    return out


def np_round(x, digits):
    y = x * 10.0**digits
    floor = math.floor(y)
    if y - floor == 0.5:
        y = floor + floor % 2
    else:
        y = math.floor(y + 0.5)
    return y / 10.0**digits


def cleaned(rows):
    """Buys and sells with the cleaned-path features, as dicts."""
    out = []
    order = lambda r: (r["open_datetime"], r["close_datetime"] or FAR, r["symbol"] or "~", r["type"], r["ticket"])
    for group in by_account(rows, order).values():
        cumulative, balance, done = ZERO, ZERO, []
        for r in group:
            net = net_of(r)
            cumulative += net or ZERO
            balance += change_of(r)
            if r["type"] == "balance":
                continue
            closed = r["close_datetime"] is not None
            minutes = None
            if closed:
                seconds = int((r["close_datetime"] - r["open_datetime"]).total_seconds())
                minutes = int(np_round(seconds / 60, 0))
            initial = balance - (net or ZERO)
            ret = None if net is None or initial == 0 else np_round(float(net) / float(initial), 4)
            sign = 1 if r["type"] == "buy" else -1
            done.append(
                dict(
                    r,
                    net=net,
                    cumulative=None if net is None else cumulative,
                    balance=balance,
                    initial=initial,
                    ret=ret,
                    closed=int(closed),
                    won=won_code(closed, net),
                    minutes=minutes,
                    pips=sign * (r["close_price"] - r["open_price"]) * 10000 if closed else None,
                    sl=int(r["stop_loss"] is not None and r["stop_loss"] == r["close_price"]),
                    tp=int(r["take_profit"] is not None and r["take_profit"] == r["close_price"]),
                    scalping=int(closed and minutes < 2),
                    overnight=int(closed and np_round(minutes / 60, 0) > 8),
                )
            )
        losses = [float(r["profit"]) for r in done if r["won"] == -1]
        limit = np_round(sum(losses) / len(losses), 2) * 0.5 if losses else None
        for i, r in enumerate(done):
            r["streak"] = int(i >= 2 and all(x["won"] == -1 for x in done[i - 2 : i + 1]))
            r["drawdown"] = int(limit is not None and float(r["profit"]) < limit)
        out.extend(done)
    return out


def std(values):
    if len(values) < 2:
        return 0.0
    units = [round(v * 10000) for v in values]
    n = len(units)
    return np_round(math.sqrt((n * sum(u * u for u in units) - sum(units) ** 2) / (n * (n - 1))) / 10000, 4)


def mean(values, digits):
    return np_round(float(sum(values)) / len(values), digits) if values else 0.0


def main_days(rows):
    """(account, day) -> selected measures over the full calendar of the account."""
    out = {}
    accounts = defaultdict(list)
    for r in cleaned(rows):
        accounts[r["account_nr"]].append(r)
    for account, trades in accounts.items():
        days = [r["open_datetime"].date() for r in trades]
        day, running = min(days), 0.0
        while day <= max(days):
            here = [r for r in trades if r["open_datetime"].date() == day]
            net = np_round(float(sum(r["net"] for r in here if r["net"] is not None)), 4)
            running = round(running + net, 4)
            returns = [r["ret"] for r in here if r["ret"] is not None]
            out[account, day] = (
                net,
                running if here else 0.0,
                mean([Decimal(str(v)) for v in returns], 4),
                std(returns),
                std([r["ret"] for r in here if r["won"] == -1 and r["ret"] is not None]),
                sum(r["scalping"] for r in here),
            )
            day += dt.timedelta(days=1)
    return out
