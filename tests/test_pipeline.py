import os
import re

import pytest

import __spark_entry__ as entry
from tools.check_oracles import compare, connect
from tradeloom.plans.pipeline import run_daily_tables, run_warehouse
from tradeloom.session import shared_folder
from tradeloom.sources import driver_tables

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


# Queries of the optional subpackage have tests of their own.
NAMES = sorted(n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n))


def test_every_query_has_a_twin():
    assert set(NAMES) <= set(entry.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_twin(spark, name):
    problem, _ = compare(spark, connect(SF), name, SF)
    assert problem is None


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@needs_data
def test_warehouse_job_is_repeatable(spark, tmp_path):
    grid = driver_tables.statement_grid(spark, SF)
    paths = run_warehouse(grid, str(tmp_path), "2001-12-31")
    staged = spark.read.parquet(f"{tmp_path}/staging/trade_history").count()
    run_warehouse(grid, str(tmp_path), "2001-12-31")
    assert spark.read.parquet(f"{tmp_path}/staging/trade_history").count() == staged == 4599
    assert spark.table("rejected_rows").count() == 0
    assert spark.table("staging_checks").filter("violations > 0").count() == 0
    assert set(paths) == {"trade_history", "dim_account_info", "dim_date", "dim_clock"}
    assert spark.table("gold_trade_history").count() == spark.read.option("header", True).csv(paths["trade_history"]).count()


@needs_data
def test_warehouse_job_counts_rejects(spark, tmp_path):
    grid = driver_tables.damaged_grid(spark, SF)
    run_warehouse(grid, str(tmp_path), "2001-12-31")
    reasons = {r.reason: r["count"] for r in spark.table("rejected_rows").groupBy("reason").count().collect()}
    assert set(reasons) == {"no account", "other type", "bad ticket", "bad time", "no rows"} and all(reasons.values())


@needs_data
def test_daily_tables_job(spark, tmp_path):
    tables = run_daily_tables(driver_tables.statement_grid(spark, SF), str(tmp_path), "2001-12-31")
    assert tables["kpi_report"].count() == tables["daily_main"].select("account_nr").distinct().count()
    assert len(tables["daily_main"].columns) == 4 + 13 + 1


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark).startswith(named or spark.conf.get("spark.sql.warehouse.dir"))
