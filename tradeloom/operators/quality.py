"""Staging constraints as violation counts."""

from functools import reduce

from pyspark.sql import functions as F

# Constraints of the staging tables.
TRADE_NOT_NULL = ["account_nr", "ticket", "open_datetime", "open_date_key", "type"]
TRADE_MAX_LENGTH = {"type": 25, "symbol": 50}
ACCOUNT_NOT_NULL = ["account_number", "account_name", "account_currency"]
ACCOUNT_MAX_LENGTH = {"account_name": 255, "account_currency": 5}


def _checks(not_null, max_length):
    checks = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
    return checks + [("max_length", c, F.count_if(F.length(c) > n)) for c, n in max_length.items()]


def _table_checks(df, table, key, not_null, max_length):
    """All checks of a table that need no other table, from one aggregation by its unique key."""
    checks = _checks(not_null, max_length)
    per_key = df.groupBy(key).agg(F.count("*").alias("copies"), *[n.alias(f"n{i}") for i, (_, _, n) in enumerate(checks)])
    repeated = F.count_if((F.col("copies") > 1) & F.col(key).isNotNull()).alias("repeated")
    totals = per_key.agg(repeated, *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(checks))])
    found = [(check, c, F.coalesce(f"n{i}", F.lit(0))) for i, (check, c, _) in enumerate(checks)] + [("unique", key, F.col("repeated"))]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(check).alias("check_name"),
                        F.lit(c).alias("column_name"),
                        n.cast("long").alias("violations"),
                    )
                    for check, c, n in found
                ]
            )
        )
    )


def repeated_keys(df, key):
    """Keys that occur more than once, with their count."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")


def orphans(trades, accounts):
    """Accounts of trades that the account table lacks, with their trade count.

    Trades are counted per account before the join, so a large account is one row in it.
    """
    per_account = trades.filter(F.col("account_nr").isNotNull()).groupBy("account_nr").count()
    known = accounts.select(F.col("account_number").alias("account_nr"))
    return per_account.join(known, "account_nr", "left_anti")


def validate_staging(trades, accounts):
    """One row per constraint with the number of violations (0 when it holds); two passes over the trades."""
    lost = orphans(trades, accounts).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
    foreign = lost.selectExpr("'trade_history' as table_name", "'foreign_key' as check_name", "'account_nr' as column_name", "violations")
    parts = [
        _table_checks(trades, "trade_history", "ticket", TRADE_NOT_NULL, TRADE_MAX_LENGTH),
        _table_checks(accounts, "dim_account", "account_number", ACCOUNT_NOT_NULL, ACCOUNT_MAX_LENGTH),
        foreign,
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
