"""Loads by key and version, refreshes, account selection, rejects, real files, exports."""

import datetime as dt
import os

import __spark_entry__ as entry
import pytest
from conftest import trade, trade_frame
from pyspark.sql import functions as F
from test_sources import grid_row, preamble

from tradeloom.operators.features import trade_features
from tradeloom.operators.staging import all_versions, current, load, of_accounts
from tradeloom.plans import gold, pipeline
from tradeloom.schemas import ACCOUNT_SCHEMA, GRID_SCHEMA, TRADE_COLUMNS, TRADE_SCHEMA
from tradeloom.sources.files import LISTING_TASKS, LISTINGS_PER_CORE, list_files, read_named_csv, scan_new_grids, write_grid_files
from tradeloom.sources.statements import checked_rows, rejected_documents, rejected_rows, statement_accounts, trades_of

DAY = "2024-01-0{} 09:00:00"


def buy(ticket, profit, account=1, day=1):
    return trade(account, ticket, "buy", "eurusd", DAY.format(day), DAY.format(day + 1), profit=profit, commission=0, swap=0)


@pytest.fixture()
def table(tmp_path):
    return pipeline.trade_staging(str(tmp_path), 4)


def staged(spark, table):
    return {r.ticket: (float(r.profit), r.load_nr, r.n_versions) for r in current(spark, table, TRADE_SCHEMA).collect()}


def test_a_corrected_trade_stays_one_trade(spark, table):
    """Corrected in the second load, not mentioned in the third: the old version never returns."""
    assert load(trade_frame(spark, [buy(1, 5), buy(2, 1)]), table) == (1, {"new": 2})
    assert load(trade_frame(spark, [buy(1, 9)]), table) == (2, {"changed": 1, "gone": 1})
    assert load(trade_frame(spark, [buy(3, 4)]), table) == (3, {"new": 1, "gone": 2})
    assert staged(spark, table) == {1: (9.0, 2, 2), 2: (1.0, 1, 1), 3: (4.0, 3, 1)}
    assert load(trade_frame(spark, [buy(1, 5)]), table)[0] == 4
    assert staged(spark, table)[1] == (5.0, 4, 3)
    features = trade_features(current(spark, table, TRADE_SCHEMA).select(*TRADE_COLUMNS)).collect()
    assert len(features) == 3 and {float(r.balance) for r in features} == {10.0}


def test_equal_loads_write_nothing(spark, table):
    rows = trade_frame(spark, [buy(1, 5), buy(2, 1, account=2)])
    load(rows, table)
    before = sorted(os.listdir(table.path))
    assert load(rows, table) == (None, {"equal": 2})
    assert sorted(os.listdir(table.path)) == before


def test_same_ticket_of_two_accounts_and_null_keys(spark, table):
    rows = [buy(1, 5), buy(1, 6, account=2), buy(None, 7)]
    assert load(trade_frame(spark, rows), table) == (1, {"new": 2})
    assert current(spark, table, TRADE_SCHEMA).count() == 2


def test_a_load_that_failed_half_way_is_replaced(spark, table):
    load(trade_frame(spark, [buy(1, 5)]), table)
    # Files of a second load that was never finished: a retry writes the same folder anew.
    fresh = trade_frame(spark, [buy(1, 9)])
    number, _ = load(fresh, table)
    leftover = f"{table.path}/load_nr={number}"
    assert os.path.isdir(leftover) and number == 2
    assert staged(spark, table) == {1: (9.0, 2, 2)}


def test_changed_currency_is_one_account(spark, tmp_path):
    accounts = pipeline.account_staging(str(tmp_path), 4)
    load(spark.createDataFrame([(1, "Ann", "USD"), (2, "Bo", "GBP")], ACCOUNT_SCHEMA), accounts)
    load(spark.createDataFrame([(1, "Ann", "GBP")], ACCOUNT_SCHEMA), accounts)
    got = {tuple(r)[:3] for r in current(spark, accounts, ACCOUNT_SCHEMA).select(*ACCOUNT_SCHEMA.fieldNames()).collect()}
    assert got == {(1, "Ann", "GBP"), (2, "Bo", "GBP")}


def test_refresh_touches_only_buckets_of_the_load(spark, tmp_path):
    root = str(tmp_path)
    table = pipeline.trade_staging(root, 4)
    load(trade_frame(spark, [buy(k, k, account=k) for k in range(1, 30)]), table)
    whole, made = pipeline.refresh_features(spark, root, 4)
    assert len(made) == 4 and whole.count() == 29
    files = lambda: {f"{d}/{f}" for d, _, names in os.walk(f"{root}/trade_features") for f in names if f.endswith(".parquet")}
    before = files()
    load(trade_frame(spark, [buy(100, 7, account=3, day=2)]), table)
    features, made = pipeline.refresh_features(spark, root, 4)
    assert len(made) == 1 and len(before & files()) >= 3
    full = trade_features(current(spark, table, TRADE_SCHEMA).select(*TRADE_COLUMNS))
    assert sorted(map(repr, features.select(*full.columns).collect())) == sorted(map(repr, full.collect()))
    assert pipeline.refresh_features(spark, root, 4)[1] == []


def test_sizes_are_counted_while_loading(spark, table):
    from tradeloom.operators.staging import large_accounts

    load(trade_frame(spark, [buy(k, k) for k in range(5)] + [buy(9, 1, account=2)]), table)
    load(trade_frame(spark, [buy(4, 8), buy(5, 1), buy(6, 1)]), table)
    sizes = lambda n: [r.account_nr for r in large_accounts(spark, table, n).collect()]
    assert sizes(6) == [1] and sizes(7) == [] and sorted(sizes(0)) == [1, 2]


def test_refresh_of_large_accounts(spark, tmp_path):
    from tradeloom.operators.staging import refresh

    table = pipeline.trade_staging(str(tmp_path), 4)
    load(trade_frame(spark, [buy(k, k - 20, day=1 + k % 5) for k in range(40)] + [buy(99, 1, account=2)]), table)
    both = [refresh(spark, table, TRADE_SCHEMA, trade_features, f"{tmp_path}/f{n}", n)[0] for n in (10, 1000)]
    columns = both[0].columns
    assert sorted(map(repr, both[0].collect())) == sorted(map(repr, both[1].select(*columns).collect()))


def test_features_read_the_lines_once(spark, monkeypatch):
    """Footers say that no account can be large: the lines are not counted before they are read."""
    from tradeloom.operators import skew
    from tradeloom.sources import driver_tables as tables

    def counted(*_):
        raise AssertionError("the lines are read to count them")

    monkeypatch.setattr(skew, "hot_keys", counted)
    assert trade_features(tables.latest_ledger(spark, "/root/testdata/sf0.001")).count() == 4599
    with pytest.raises(AssertionError, match="read to count"):
        tables.latest_ledger(spark, "/root/testdata/sf0.001", hot_rows=100)


def order_tables(spark, folder):
    """Copies of tickets within and across orders, missing keys, an order listed twice, one account with most lines."""
    day = dt.datetime(1995, 3, 1)
    line = lambda order, part, number: (order, part, 3, number, 5.0, 100.0 + (part or 0), 0.05, 0.02, "A", "F", day)
    lines = [line(1, 7, 1), line(1, 9, 1), line(1, 8, 1), line(1, 4, 12), line(2, 5, 2), line(2, 5, 2), line(3, 1, None), line(3, 2, None)]
    lines += [line(4, None, 3), line(None, 6, 1), line(5, 6, 1)] + [line(n, n, 1) for n in range(10, 30)]
    orders = [(1, 11, day), (2, 11, day), (3, 12, day), (3, 13, day + dt.timedelta(1)), (4, 12, day), (6, 12, day), (None, 12, day)]
    orders += [(n, 14, day + dt.timedelta(n)) for n in range(10, 30)]
    types = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    types += ", l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, types).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_copies_go_before_the_account_shuffle(spark, tmp_path):
    """of large tables copies within an order go first; the ledger is that of small tables, by either path."""
    from tradeloom.sources import driver_tables as tables

    folder = order_tables(spark, tmp_path)
    assert tables.order_lines(spark, folder, latest=True).filter("account_nr = 11").count() == 3  # order 1 line 12 is ticket 22 too
    ledgers = [tables.latest_ledger(spark, folder, hot_rows) for hot_rows in (1000, 30, 15, 1)]
    assert [ledger.hot is None for ledger in ledgers] == [True, True, False, False]
    rows = [sorted(map(repr, ledger.union().collect())) for ledger in ledgers]
    assert rows[0] == rows[1] == rows[2] == rows[3] and len(rows[0]) == 2 + 3 + 20


def test_no_search_for_large_accounts_without_large_orders(spark, tmp_path, monkeypatch):
    """the most orders of an account times the most lines of an order tell that no account is large."""
    from tradeloom.operators import skew
    from tradeloom.sources import driver_tables as tables

    def counted(*_):
        raise AssertionError("searched")

    folder = order_tables(spark, tmp_path)
    lines = tables.read_table(spark, folder, "lineitem").filter("l_orderkey > 9").withColumn("l_linenumber", F.lit(1))
    lines.write.parquet(f"{folder}/few/lineitem.parquet")
    orders = tables.read_table(spark, folder, "orders").withColumn("o_custkey", F.col("o_custkey") + F.coalesce("o_orderkey", F.lit(0)))
    orders.write.parquet(f"{folder}/few/orders.parquet")
    monkeypatch.setattr(skew, "hot_keys", counted)
    assert tables.latest_ledger(spark, f"{folder}/few", hot_rows=10).hot is None
    assert tables.most_lines(spark, folder, 10) == 31 and tables.most_lines(spark, f"{folder}/few", 10) < 10


def test_export_derives_the_trades_once(spark, monkeypatch, tmp_path):
    """F16, F17: the calendar's bounds are seen while the trades are written, with rows that the view leaves out."""

    def derived(*_):
        raise AssertionError("derived for the calendar")

    expected = {r.view_name: r.n_rows for r in entry.queries()["export_gold"](spark, "/root/testdata/sf0.001").collect()}
    days = entry.queries()["dim_date"](spark, "/root/testdata/sf0.001").count()
    monkeypatch.setattr(entry.tables, "order_open_times", derived)
    got = entry.queries()["export_order"](spark, "/root/testdata/sf0.001").collect()
    assert {r.view_name: r.n_rows for r in got} == expected and expected["dim_date"] == days
    features = spark.createDataFrame([(dt.datetime(2024, 1, 2, 9), "balance"), (dt.datetime(2024, 1, 5, 9), "buy"), (None, "buy")], "open_datetime timestamp_ntz, type string")
    watched, bounds = gold.watched_days(features)
    assert watched.filter("type = 'buy'").count() == 2
    assert tuple(bounds().first()) == (dt.date(2024, 1, 2), dt.date(2024, 1, 5))
    watched, bounds = gold.watched_days(features.limit(0))
    watched.collect()
    assert tuple(bounds().first()) == (None, None)


def test_account_selection_reads_fewer_files(spark, table):
    load(trade_frame(spark, [buy(k, k, account=k) for k in range(1, 60)]), table)
    rows = all_versions(spark, table, TRADE_SCHEMA)
    one = of_accounts(rows, table, [7])
    assert [r.account_nr for r in one.collect()] == [7]
    assert 0 < len({f for f in one.inputFiles()}) <= len(rows.inputFiles())
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(account_bucket" in plan and "EqualTo(account_nr,7)" in plan or "In(account_nr" in plan
    read = one.select("_metadata.file_path").distinct().count()
    assert read < len(rows.inputFiles())
    chosen = spark.createDataFrame([(7,), (8,), (7,)], "a long")
    assert sorted(r.account_nr for r in of_accounts(rows, table, chosen).collect()) == [7, 8]


LINE = dict(c1="2024.01.02 09:00:00", c2="buy", c3="0.10", c4="eurusd", c8="2024.01.02 09:30:00", c13="5")


def test_rejected_rows_have_reasons_and_positions(spark):
    rows = preamble("a", 11) + [
        grid_row("a", 4, c0="100", **LINE),
        grid_row("a", 5, c0="x1", **LINE),
        grid_row("a", 6, c0="101", **(LINE | {"c2": "buy limit"})),
        grid_row("a", 7, c0="102", **(LINE | {"c1": "31.02.2024"})),
        grid_row("a", 8, c0="103", **(LINE | {"c1": None})),
        grid_row("a", 9, c0="104", **(LINE | {"c8": "soon"})),
        grid_row("a", 10, c0="100", **(LINE | {"c8": "soon", "c13": "6"})),
        grid_row("a", 11, c0="105", **LINE),
        grid_row("a", 12, c0="105", **(LINE | {"c2": "sell stop"})),
    ]
    rows += [grid_row("b", 0, c0="no header at all"), grid_row("b", 4, c0="200", **LINE)] + preamble("c", 12)
    grid = spark.createDataFrame(rows, GRID_SCHEMA)
    checked = checked_rows(grid)
    got = {tuple(r) for r in rejected_rows(checked, statement_accounts(grid)).collect()}
    assert got == {
        ("a", 5, "bad ticket"), ("a", 6, "other type"), ("a", 7, "bad time"), ("a", 8, "bad time"), ("a", 9, "bad time"),
        ("a", 10, "bad time"), ("a", 12, "other type"), ("b", 4, "no account"), ("c", None, "no rows"),
    }
    assert {(r.account_nr, r.ticket, float(r.profit)) for r in trades_of(checked).collect()} == {(11, 100, 5.0)}
    assert checked.count() == grid.filter("row_idx >= 4").count()


def test_checks_need_few_cells(spark):
    """the cells that tell are enough, and of the text only the reason travels to the headers."""
    from tradeloom.sources.statements import CHECKED_CELLS

    rows = preamble("a", 11) + [grid_row("a", k, c0=str(k), **(LINE | {"c1": "soon" if k == 5 else LINE["c1"]})) for k in range(4, 7)]
    rows += [grid_row("b", 4, c0="n/a", **LINE)]
    grid = spark.createDataFrame(rows, GRID_SCHEMA)
    few = grid.select("file", "row_idx", *CHECKED_CELLS)
    got = {tuple(r) for r in rejected_rows(checked_rows(few), statement_accounts(few)).collect()}
    assert got == {("a", 5, "bad time"), ("b", 4, "no account")}
    plan = checked_rows(few, most_rows=1).select("file", "reason")._jdf.queryExecution().optimizedPlan().toString()
    join = next(k for k, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line)
    assert "reason" in plan.splitlines()[join + 1] and "open_datetime" not in plan.splitlines()[join]


@pytest.mark.parametrize("hot_rows", [1000, 2, 0])
def test_headerless_files_stay_on_the_hot_path(spark, hot_rows):
    rows = preamble("a", 11) + [grid_row(f, k, c0=str(k), **LINE) for f in "ab" for k in range(4, 8)]
    checked = checked_rows(spark.createDataFrame(rows, GRID_SCHEMA), hot_rows).collect()
    assert len(checked) == 8 and {r.reason for r in checked if r.file == "b"} == {"no account"}


def test_rejected_documents(spark):
    table = lambda *rows: "<html><table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table></html>"
    head, data = "<td>Ticket</td><td>Profit</td>", "<td>1</td><td>2</td>"
    docs = [
        ("good", table("<td>a</td>", "<td>b</td>", head, data)), ("none", "<p>x</p>"), ("short", table("<td>a</td>")),
        ("other", table("<td>a</td>", "<td>b</td>", "<td>x</td>", data)), ("bare", table("<td>a</td>", "<td>b</td>", head)), ("null", None),
    ]
    got = {tuple(r) for r in rejected_documents(spark.createDataFrame(docs, "doc_id string, html string"), {"Ticket": "ticket", "Profit": "profit"}).collect()}
    assert got == {("none", "no table"), ("null", "no table"), ("short", "no header row"), ("other", "unknown header"), ("bare", "no rows")}


def test_rejects_read_documents_once(spark):
    cells = lambda *texts: "".join(f"<td>{t}</td>" for t in texts) + "</tr>"
    late = "<table>" + "</tr>" * 50 + cells("a") + cells("b") + cells("Ticket")
    docs = [("late", late + cells(1)), ("bare", late), ("twice", "<p>x</p>"), ("twice", late), (None, late)]
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame(docs, "doc_id string, html string").mapInPandas(lambda parts: (seen.add(len(p)) or p for p in parts), "doc_id string, html string")
    got = [tuple(r) for r in rejected_documents(rows, {"Ticket": "ticket"}).collect()]
    assert sorted(got, key=repr) == [("bare", "no rows"), ("twice", "no rows"), ("twice", "no rows"), (None, "no table")]
    assert seen.value == len(docs)


def test_only_unseen_files_are_read(spark, tmp_path):
    folder, seen = f"{tmp_path}/files", f"{tmp_path}/seen"
    grids = [spark.createDataFrame(preamble(f, n) + [grid_row(f, 4, c0=str(n), **LINE)], GRID_SCHEMA) for n, f in enumerate("ab", 1)]
    write_grid_files(grids[0], folder)
    rows, remember = scan_new_grids(spark, folder, seen)
    assert {r.file for r in rows.collect()} == {"a"}
    assert {r.file for r in scan_new_grids(spark, folder, seen)[0].collect()} == {"a"}  # not remembered yet
    remember()
    write_grid_files(grids[1], folder)
    rows, remember = scan_new_grids(spark, folder, seen)
    assert {(r.file, r.scan_nr) for r in rows.collect()} == {("b", 2)}
    remember()
    assert scan_new_grids(spark, folder, seen)[0].count() == 0


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    most, before = LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism, spark.conf.get(LISTING_TASKS)
    for n in range(2 * most):
        os.makedirs(tmp_path / f"statement={n}")
        (tmp_path / f"statement={n}" / "a.csv").write_text(f"4,{n}\n")
    spark.sparkContext.setJobGroup("listing", "listing")
    assert list_files(spark, str(tmp_path), "csv", recursive=True).count() == 2 * most
    assert len(scan_new_grids(spark, str(tmp_path), f"{tmp_path}/seen")[0].select("file").distinct().collect()) == 2 * most
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s and s.name.startswith(("load", "csv"))) <= most
    assert spark.conf.get(LISTING_TASKS) == before


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Ticket,Open  Time,Profit\n1,x,5\n2,y,6\n")
    (tmp_path / "b.csv").write_text("PROFIT,extra,ticket\n7,?,3\n")
    (tmp_path / "c.csv").write_text("1,2,3\n")
    names = {"ticket": "ticket", "open_time": "opened", "open": "opened", "profit": "profit"}
    got = {tuple(r)[1:] for r in read_named_csv(spark, str(tmp_path), names, width=4).collect()}
    assert got == {("1", "x", "5"), ("2", "y", "6"), ("3", None, "7"), (None, None, None)}


def test_named_files_are_read_twice_and_stay_in_place(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(" S \t/ L,OPEN  TIME\n1,x\n,\nopen__time,s\n")
    (folder / "b.csv").write_text("open time\n7\n")
    names = {"s_/_l": "stop", "open_time": "opened"}
    few, many = (read_named_csv(spark, str(folder), names, width=3, hot_rows=1, most_headers=n) for n in (10, 0))
    rows = lambda df: sorted(map(repr, df.select("stop", "opened").collect()))
    assert rows(few) == rows(many) and len(rows(few)) == 4
    assert "SortMergeJoin" not in few._jdf.queryExecution().toString() and "LeftSemi" not in few._jdf.queryExecution().toString()


def test_a_failed_export_leaves_the_old_one(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    view = spark.createDataFrame([(2, "b"), (1, "a, \"b\"")], "account_number long, account_name string")
    gold.export_gold({"dim_account_info": view}, folder)
    broken = spark.sql("select raise_error('no') as account_number, 'x' as account_name")
    with pytest.raises(Exception):
        gold.export_gold({"dim_account_info": broken}, folder)
    back = gold.read_export(spark, folder)["dim_account_info"]
    assert [tuple(r) for r in back.collect()] == [(1, "a, \"b\""), (2, "b")]
    assert [tuple(r)[1:] for r in gold.file_order(spark, folder).collect()] == [(2, 2)]
    (path,) = [r.path for r in gold.read_manifest(spark, folder).collect()]
    for f in os.listdir(path):
        if f.endswith(".csv"):
            with open(f"{path}/{f}", "a") as more:
                more.write("3,c\n")
    for f in os.listdir(path):
        if f.endswith(".crc"):
            os.remove(f"{path}/{f}")
    with pytest.raises(ValueError, match="not what was exported"):
        gold.read_export(spark, folder)


def test_rows_out_of_order_are_found(spark, tmp_path, monkeypatch):
    view = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "account_number long, account_name string").coalesce(1)
    monkeypatch.setitem(gold.SORT_COLUMNS, "dim_account_info", [])
    gold.export_gold({"dim_account_info": view}, str(tmp_path))
    monkeypatch.setitem(gold.SORT_COLUMNS, "dim_account_info", ["account_number"])
    assert [tuple(r)[1:] for r in gold.file_order(spark, str(tmp_path)).collect()] == [(3, 2)]


def test_an_exported_view_is_made_alone(spark, monkeypatch):
    def bounds(spark, d):
        raise AssertionError("the trades need no calendar")

    trades = trade_frame(spark, [buy(n, n) for n in (1, 2)])
    monkeypatch.setattr(entry, "_features", lambda s, d: trade_features(trades))
    monkeypatch.setattr(entry, "_bounds", bounds)
    assert {r.ticket for r in entry.queries()["exported_trades"](spark, "").collect()} == {1, 2}


def test_trades_are_derived_once_for_named_files(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    trades = trade_frame(spark, [buy(n, n, account=n) for n in (1, 2, 3)])
    counted = trades.mapInPandas(lambda parts: (seen.add(len(p)) or p for p in parts), TRADE_SCHEMA)
    monkeypatch.setattr(entry.tables, "latest_trades", lambda s, d: counted)
    assert {r.ticket for r in entry.queries()["named_scan"](spark, "").collect()} == {1, 2, 3}
    assert seen.value == 3
