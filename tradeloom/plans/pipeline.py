"""The two end-to-end jobs: statements to warehouse, statements to daily tables and report.

Every stage writes a table in the shared folder and the next one reads it, so a lost
executor costs one stage at most.
"""

from pyspark.sql import functions as F

from tradeloom.functions.frames import distinct_rows
from tradeloom.operators.cleaned import cleaned_features
from tradeloom.operators.dims import trade_day_bounds
from tradeloom.operators.features import trade_features
from tradeloom.operators.quality import validate_staging
from tradeloom.operators.staging import BUCKETS, StagingTable, current, load, refresh
from tradeloom.plans.cubes import daily_main, daily_side, daily_summary
from tradeloom.plans.gold import export_gold, gold_views
from tradeloom.plans.kpi import kpi_report
from tradeloom.schemas import ACCOUNT_COLUMNS, ACCOUNT_FILE_NAMES, ACCOUNT_SCHEMA, TRADE_COLUMNS, TRADE_SCHEMA
from tradeloom.session import stored
from tradeloom.sources.files import publish
from tradeloom.sources.statements import checked_rows, rejected_rows, statement_accounts, statement_trades, trades_of


def _end(last_day):
    return F.current_date() if last_day is None else last_day


def account_table(grid):
    """One row per account under its warehouse names; of unlike statements the last file's holds."""
    names = {v: k for k, v in ACCOUNT_FILE_NAMES.items()}
    heads = statement_accounts(grid).withColumnsRenamed(names).filter("account_number is not null")
    rest = F.struct(*[c for c in ACCOUNT_COLUMNS if c != "account_number"])
    return heads.groupBy("account_number").agg(F.max_by(rest, "file").alias("last")).select("account_number", "last.*")


def trade_staging(root, buckets=BUCKETS):
    return StagingTable(f"{root}/staging/trade_history", TRADE_COLUMNS, ["account_nr", "ticket"], "account_nr", buckets)


def account_staging(root, buckets=BUCKETS):
    return StagingTable(f"{root}/staging/dim_account", ACCOUNT_COLUMNS, ["account_number"], "account_number", buckets)


def load_staging(trades, accounts, root):
    """One load of both staging tables: {table: (load number or None, counts of new, changed, equal, gone)}."""
    return {"dim_account": load(accounts, account_staging(root)), "trade_history": load(trades, trade_staging(root))}


def run_warehouse(grid, root, last_day=None):
    """Grids to staging tables, trade features and exported gold views.

    Rows that cannot be loaded are published as `rejected_rows` with their reason. Staging keeps every
    version of a trade and an account; features, and the features' refresh, see the last one. Trades
    that a later source no longer holds stay. `staging_checks` holds the violated constraints.
    """
    spark = grid.sparkSession
    rows = stored(checked_rows(grid), "checked")
    publish(rejected_rows(rows, statement_accounts(grid)), root, "rejected_rows")
    load_staging(trades_of(rows), account_table(grid), root)
    staged = current(spark, trade_staging(root), TRADE_SCHEMA).select(*TRADE_COLUMNS)
    staged_accounts = current(spark, account_staging(root), ACCOUNT_SCHEMA).select(*ACCOUNT_COLUMNS)
    publish(validate_staging(staged, staged_accounts), root, "staging_checks")
    features, _ = refresh_features(spark, root)
    views = gold_views(features, staged_accounts, trade_day_bounds(staged, _end(last_day)), register=True)
    return export_gold(views, f"{root}/export")


def refresh_features(spark, root, buckets=BUCKETS):
    """The stored per-trade features, made again for the accounts' buckets that loads have touched since."""
    return refresh(spark, trade_staging(root, buckets), TRADE_SCHEMA, trade_features, f"{root}/trade_features")


def run_daily_tables(grid, root, last_day=None):
    """Grids to cleaned trades, the four daily tables and the report, all published."""
    last_day = _end(last_day)
    features = publish(cleaned_features(statement_trades(grid)), root, "cleaned_features")
    tables = {
        "daily_summary": daily_summary(features, last_day),
        "daily_main": daily_main(features, last_day),
        "daily_long": daily_side(features, "long", last_day),
        "daily_short": daily_side(features, "short", last_day),
        "kpi_report": kpi_report(features, last_day),
    }
    return {name: publish(df, root, name) for name, df in tables.items()}
