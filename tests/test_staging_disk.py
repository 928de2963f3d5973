"""A load leaves no comparison behind, and a refresh moves the rows of an account once for versions and features."""

import os

from conftest import trade_frame

from tradeloom.operators.staging import load
from tradeloom.plans import pipeline
from tradeloom.schemas import TRADE_COLUMNS


def test_a_load_removes_its_comparison(spark, skewed_rows, tmp_path):
    table = pipeline.trade_staging(str(tmp_path), 4)
    rows = trade_frame(spark, skewed_rows).select(*TRADE_COLUMNS).dropDuplicates(["account_nr", "ticket"])
    number, counts = load(rows, table)
    assert number == 1 and sum(counts.values()) == rows.filter("account_nr is not null and ticket is not null").count()
    assert load(rows, table) == (None, {"equal": counts["new"]})
    assert sorted(os.listdir(tmp_path / "staging")) == ["trade_history", "trade_history-sizes"]
