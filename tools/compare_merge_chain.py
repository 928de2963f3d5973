"""Daily summary two ways over the same stored trades: one aggregation, or one per measure plus joins.

The second form is how a table-at-a-time script computes it: every measure is its own
filter and group-by, and all of them are left-joined to the first.

Usage: python tools/compare_merge_chain.py SF_DIR
"""

import os
import sys
import time
from functools import reduce

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tradeloom.functions.columns import float_round
from tradeloom.operators.cleaned import cleaned_features
from tradeloom.operators.measures import DAILY_SUMMARY, is_count, names
from tradeloom.plans.cubes import daily_summary
from tradeloom.session import build_session, stored
from tradeloom.sources.driver_tables import latest_ledger

KEYS = ["account_nr", "open_date", "symbol"]
FLAGS = {
    "rows": "true", "closed": "trade_closed = 1", "ongoing": "trade_closed = 0", "stop_loss": "sl_triggered = 1",
    "take_profit": "tp_triggered = 1", "scalping": "trade_scalping = 1", "overnight": "overnight_trade = 1",
    "scalping_net": "trade_scalping = 1", "overnight_net": "overnight_trade = 1",
}
VALUES = {
    "net": "net_profit", "scalping_net": "net_profit", "overnight_net": "net_profit", "size": "size", "pips": "pips_gained",
    "minutes": "trade_duration_minutes", "profit": "profit",
}


def one_measure(features, m):
    rows = features.filter(FLAGS.get(m.base, "true"))
    if m.won is not None:
        rows = rows.filter(F.col("trade_won") == m.won)
    value = VALUES.get(m.base)
    how = {
        "count": lambda: F.count("*"),
        "sum": lambda: F.sum(value).cast("double"),
        "mean": lambda: F.try_divide(F.sum(value).cast("double"), F.count(value)),
        "mean_return": lambda: F.avg("trade_return"),
        "std_return": lambda: F.stddev_samp("trade_return"),
        "max": lambda: F.max(value).cast("double"),
        "min": lambda: F.min(value).cast("double"),
    }[m.how]()
    return rows.groupBy(*KEYS).agg((how if m.digits is None else float_round(how, m.digits)).alias(m.name))


def merge_chain(features):
    rows = features.filter("symbol is not null")
    parts = [one_measure(rows, m) for m in DAILY_SUMMARY]
    joined = reduce(lambda a, b: a.join(b, KEYS, "left"), parts)
    return joined.fillna(0)


def main():
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "10g",
           "spark.sql.shuffle.partitions": "8"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    features = stored(cleaned_features(latest_ledger(spark, sys.argv[1])), "cleaned")
    forms = {
        "one aggregation": lambda: daily_summary(features, empty_days="count"),
        "one group-by and join per measure": lambda: merge_chain(features),
    }
    for label, form in forms.items():
        for _ in range(2):
            start = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
        print(f"{label}: {spent:.1f} s", flush=True)
    counts = [m.name for m in DAILY_SUMMARY if is_count(m)]
    sums = lambda df: df.agg(*[F.sum(c).cast("long").alias(c) for c in counts]).head()
    print("same counts:", sums(forms["one aggregation"]()) == sums(merge_chain(features)), len(names(DAILY_SUMMARY)), "measures")


if __name__ == "__main__":
    main()
