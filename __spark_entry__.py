
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracles import sql as oracles
from tradeloom.functions.columns import switch_values
from tradeloom.functions.frames import distinct_rows, recast, with_row_key
from tradeloom.operators import dims
from tradeloom.operators.cleaned import cleaned_features
from tradeloom.operators.delta import delta_append, delta_stale, delta_upsert
from tradeloom.operators.features import trade_features, trade_history
from tradeloom.operators.measures import CELL_COLUMNS, DAILY_SUMMARY, side_measures
from tradeloom.operators.quality import validate_staging
from tradeloom.operators.staging import current, load
from tradeloom.plans import cubes, gold, pipeline, reports
from tradeloom.plans.kpi import kpi_report
from tradeloom.schemas import ACCOUNT_SCHEMA, GOLD_TRADE_COLUMNS, TRADE_COLUMNS, TRADE_SCHEMA
from tradeloom.session import discard, scratch_path, stored
from tradeloom.sources import driver_tables as tables
from tradeloom.sources.files import (
    list_files, read_fact_files, read_named_csv, scan_new_grids, write_csv, write_fact_files, write_grid_files,
)
from tradeloom.sources.statements import (
    CHECKED_CELLS, checked_rows, html_rows, rejected_documents, rejected_rows, statement_accounts, statement_trades, trades_of, typed_trades,
)

try:
    import tradeloom.llm.queries as llm
except ModuleNotFoundError as missing:  # the subpackage and its pipeline can be left out as a whole
    if missing.name != "corpus_pipeline" and not str(missing.name).startswith("tradeloom.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
BUCKETS = 8  # of the staging tables that queries make; the test tables are small


def _edge(df: DataFrame) -> DataFrame:
    """Exact decimals become doubles where results leave the package."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def _features(spark, d):
    return trade_features(tables.latest_ledger(spark, d))


def _cleaned(spark, d):
    return cleaned_features(tables.latest_ledger(spark, d))


def _bounds(spark, d):
    return dims.trade_day_bounds(tables.order_open_times(spark, d))


def _gold(spark, d):
    """The gold views; the calendar's bounds are known when the trades are written, so they are not derived again."""
    features, bounds = gold.watched_days(_features(spark, d))
    views = gold.gold_views(features, tables.accounts(spark, d), spark.createDataFrame([], "first_day date, last_day date"))
    return views | {"dim_date": lambda: gold.date_view(bounds())}


def _joined_summaries(spark, d):
    """The N-way left join of the three daily tables themselves; their empty days are written after it.

    The cleaned trades are derived once and stored for the three. Hot accounts are left to the tables' own shuffles.
    """
    ledger = tables.latest_ledger(spark, d)
    kept = stored(cleaned_features(ledger).select(*CELL_COLUMNS, "trade_return", "open_date", "close_date"), "cleaned")
    cleaned = kept.repartition("account_nr") if ledger.hot is None else kept
    sides = [cubes.daily_side(cleaned, word, empty_days="count") for word in ("long", "short")]
    joined = cubes.join_summaries(cubes.daily_summary(cleaned, empty_days="count"), *sides)
    full = cubes.with_empty_days(joined, DAILY_SUMMARY + side_measures("long") + side_measures("short"))
    discard(kept)  # the joined table is stored by then
    return full


def _html_statement_rows(spark, d):
    docs = tables.html_statements(spark, d)
    rows = html_rows(docs, tables.HTML_COLUMNS)
    account = F.split_part("doc_id", F.lit("-"), F.lit(1)).cast("long")
    return typed_trades(rows.withColumn("account_nr", account))


def _recast_types(spark, d):
    raw = tables.raw_trades(spark, d)
    text = raw.select(
        "account_nr",
        F.col("ticket").cast("string").alias("ticket"),
        F.col("open_datetime").cast("string").alias("open_datetime"),
        F.col("close_datetime").cast("string").alias("close_datetime"),
        F.coalesce(F.col("close_date_key").cast("string"), F.lit("open")).alias("close_date_key"),
        F.when(F.col("type") == "balance", "n/a").otherwise(F.col("size").cast("string")).alias("size"),
        F.col("profit").cast("string").alias("profit"),
    )
    return recast(
        text,
        date_cols=["open_datetime", "close_datetime"],
        float_cols=["size", "profit"],
        int_cols=["ticket", "close_date_key"],
        str_cols=["account_nr"],
    )


def _value_switch(spark, d):
    raw = tables.raw_trades(spark, d)
    sides = {"buy": "long", "sell": "short", "balance": "cash"}
    currencies = {"eur": "EURO", "gbp": "POUND STERLING", "usd": "US DOLLARS"}
    return (
        raw.select(
            "account_nr",
            switch_values(F.col("type"), sides).alias("side"),
            switch_values(F.left("symbol", F.lit(3)), currencies, strict=False).alias("base_currency"),
        )
        .groupBy("account_nr", "side", "base_currency")
        .agg(F.count("*").alias("n"))
    )


def _row_identity(spark, d):
    raw = tables.raw_trades(spark, d).select("account_nr", "ticket", "type", "symbol", "open_date_key")
    return with_row_key(distinct_rows(raw))


def _csv_roundtrip(spark, d):
    path = scratch_path(spark, "fact")
    write_fact_files(tables.latest_trades(spark, d), path)
    return read_fact_files(spark, path)


def _export_gold(spark, d):
    """The manifest of an export that follows an earlier one."""
    folder = scratch_path(spark, "gold")
    views = _gold(spark, d)
    former = views | {"dim_date": gold.date_view(spark.createDataFrame([], "first_day date, last_day date"))}
    gold.export_gold({name: spark.createDataFrame([], df.schema) for name, df in former.items()}, folder)
    gold.export_gold(views, folder)
    return gold.read_manifest(spark, folder).select("view_name", "n_rows")


def _export_order(spark, d):
    folder = scratch_path(spark, "gold")
    gold.export_gold(_gold(spark, d), folder)
    return gold.file_order(spark, folder)


def _exported(name, view):
    """A view read back from the exported files."""

    def run(spark, d):
        folder = scratch_path(spark, "gold")
        gold.export_gold({name: view(spark, d)}, folder)
        return gold.read_export(spark, folder)[name]

    return run


def _delta(function):
    """The source lacks every seventh ticket and has trades that were closed since."""

    def run(spark, d):
        trades = tables.stored_trades(spark, d)
        return function(trades.filter("ticket % 7 <> 0"), tables.ledger_as_of(trades, oracles.SNAPSHOT))

    return run


def _delta_append(spark, d):
    """Every latest trade is compared with a target that lacks those opened or closed since."""
    trades = tables.stored_trades(spark, d)
    return delta_append(trades, tables.ledger_as_of(trades, oracles.SNAPSHOT))


def _loaded(spark, d):
    """The staging root after three loads of trades, and the counts of each load."""
    root = scratch_path(spark, "warehouse")
    table = pipeline.trade_staging(root, BUCKETS)
    return root, table, [load(rows, table)[1] for rows in tables.staging_loads(spark, d, oracles.LOADS)]


def _staged_trades(spark, d):
    _, table, _ = _loaded(spark, d)
    return current(spark, table, TRADE_SCHEMA).select(*TRADE_COLUMNS, "load_nr", "n_versions")


def _load_states(spark, d):
    _, _, counts = _loaded(spark, d)
    rows = [(n, state, count) for n, found in enumerate(counts, 1) for state, count in found.items()]
    return spark.createDataFrame(rows, "load_nr long, state string, n_rows long")


def _staged_accounts(spark, d):
    table = pipeline.account_staging(scratch_path(spark, "warehouse"), BUCKETS)
    for rows in tables.account_loads(spark, d):
        load(rows, table)
    return current(spark, table, ACCOUNT_SCHEMA).select(*ACCOUNT_SCHEMA.fieldNames(), "load_nr", "n_versions")


def _refreshed_features(spark, d):
    """Stored features after each of three loads, the last two refreshed in part."""
    root = scratch_path(spark, "warehouse")
    table = pipeline.trade_staging(root, BUCKETS)
    for rows in tables.staging_loads(spark, d, oracles.LOADS):
        load(rows, table)
        features, _ = pipeline.refresh_features(spark, root, BUCKETS)
    return features


def _selected_accounts(spark, d):
    """Features of the accounts of one currency, selected before the staging files are read."""
    _, table, _ = _loaded(spark, d)
    chosen = tables.accounts(spark, d).filter("account_currency = 'GBP'").select("account_number")
    return trade_features(current(spark, table, TRADE_SCHEMA, chosen).select(*TRADE_COLUMNS))


def _statement_rejects(spark, d):
    # The checks and the headers are told by few cells; the others need not be made for them.
    grid = tables.damaged(stored(tables.statement_grid(spark, d).select("file", "row_idx", *CHECKED_CELLS), "grid"))
    rejects = rejected_rows(checked_rows(grid, most_rows=tables.most_lines(spark, d)), statement_accounts(grid))
    return rejects.groupBy("file", "reason").agg(F.count("*").alias("n_rows"), F.min("row_idx").alias("first_row"))


def _accepted_trades(spark, d):
    grid = tables.damaged(stored(tables.statement_grid(spark, d), "grid"))
    return trades_of(checked_rows(grid, most_rows=tables.most_lines(spark, d)))


def _inbox_scan(spark, d):
    """Statement files arrive twice; each scan reads those that the listing does not know."""
    root = scratch_path(spark, "inbox")
    grid = tables.statement_grid(spark, d).withColumn("file", F.substring_index("file", "_", 2))
    late, scans = F.split_part("file", F.lit("_"), F.lit(2)).cast("long") % 4 == 0, []
    for part in (~late, late):
        write_grid_files(grid.filter(part), f"{root}/files")
        rows, remember = scan_new_grids(spark, f"{root}/files", f"{root}/seen")
        scans.append(stored(rows, "scan"))
        remember()
    rows = scans[0].unionByName(scans[1])
    body = rows.filter("row_idx >= 4").groupBy("file", "scan_nr").agg(F.count("*").alias("n_rows"), F.sum(F.col("c13").cast("decimal(18,6)")).alias("profit"))
    files = list_files(spark, f"{root}/files", "csv", recursive=True).count()
    return body.withColumn("n_files", F.lit(files).cast("long"))


def _named_scan(spark, d):
    """Trades from files of two spellings and column orders."""
    root = scratch_path(spark, "named")
    trades = tables.stored_trades(spark, d)
    plain = {c: c.replace("_", " ").title() for c in TRADE_COLUMNS}
    shouted = {c: f" {c.upper().replace('_', '  ')}" for c in TRADE_COLUMNS} | {"account_nr": "Account  Number", "stop_loss": "S / L"}
    for side, names, order in (("even", plain, 1), ("odd", shouted, -1)):
        rows = trades.filter(F.col("account_nr") % 2 == int(side == "odd"))
        write_csv(rows.select(*[F.col(c).alias(names[c]) for c in TRADE_COLUMNS[::order]]), f"{root}/{side}")
    spelt = {c: c for c in TRADE_COLUMNS} | {"account_number": "account_nr", "s_/_l": "stop_loss"}
    found = read_named_csv(spark, f"{root}/*", spelt, width=20)
    return found.select(*[F.col(f.name).cast(f.dataType) for f in TRADE_SCHEMA])


def _star_report(spark, d):
    days = dims.dim_date(_bounds(spark, d))
    return reports.star_report(trade_history(_features(spark, d)), tables.accounts(spark, d), days, dims.dim_clock(spark))


def _on_cleaned(function, **options):
    return lambda spark, d: function(_cleaned(spark, d), **options)


def entry(spark: SparkSession) -> DataFrame:
    return queries()["trade_history"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "dedupe_last": tables.latest_trades,
        "trade_features": _features,
        "trade_history": lambda s, d: trade_history(_features(s, d)).select(*GOLD_TRADE_COLUMNS),
        "cleaned_features": _cleaned,
        "dim_account": lambda s, d: dims.dim_account(tables.accounts(s, d)),
        "dim_date": lambda s, d: dims.dim_date(_bounds(s, d)),
        "dim_clock": lambda s, d: reports.clock_activity(_features(s, d), dims.dim_clock(s)),
        "calendar_features": lambda s, d: dims.calendar(_bounds(s, d), features=True),
        "gold_trade_history": lambda s, d: gold.trade_view(_features(s, d)),
        "gold_dim_account_info": lambda s, d: gold.account_view(tables.accounts(s, d)),
        "gold_dim_date": lambda s, d: gold.date_view(_bounds(s, d)),
        "daily_summary": _on_cleaned(cubes.daily_summary),
        "daily_main": _on_cleaned(cubes.daily_main),
        "daily_long": _on_cleaned(cubes.daily_side, word="long"),
        "daily_short": _on_cleaned(cubes.daily_side, word="short"),
        "gold_dim_clock": lambda s, d: reports.clock_activity(_features(s, d), gold.clock_view(s)),
        "joined_cube": _on_cleaned(cubes.joined_cube),
        "joined_summaries": _joined_summaries,
        "kpi_report": _on_cleaned(kpi_report),
        "profit_curve": _on_cleaned(reports.profit_curve),
        "duration_histogram": _on_cleaned(reports.duration_histogram),
        "symbol_wins": _on_cleaned(reports.symbol_wins),
        "symbol_amounts": _on_cleaned(reports.symbol_amounts),
        "weekday_amounts": _on_cleaned(reports.weekday_amounts),
        "daily_net_profit": _on_cleaned(reports.daily_net_profit),
        "pips_vs_duration": _on_cleaned(reports.pips_vs_duration),
        "statement_parse": lambda s, d: statement_trades(tables.statement_grid(s, d), most_rows=tables.most_lines(s, d)),
        "statement_accounts": lambda s, d: statement_accounts(tables.statement_grid(s, d)),
        "html_statement_rows": _html_statement_rows,
        "recast_types": _recast_types,
        "value_switch": _value_switch,
        "row_identity": _row_identity,
        "csv_roundtrip": _csv_roundtrip,
        "delta_append": _delta_append,
        "delta_stale": _delta(delta_stale),
        "delta_upsert": _delta(delta_upsert),
        "validate_staging": lambda s, d: validate_staging(tables.flawed_trades(s, d), tables.flawed_accounts(s, d)),
        "export_gold": _export_gold,
        "export_order": _export_order,
        "exported_trades": _exported("trade_history", lambda s, d: gold.trade_view(_features(s, d))),
        "exported_dates": _exported("dim_date", lambda s, d: gold.date_view(_bounds(s, d))),
        "staged_trades": _staged_trades,
        "load_states": _load_states,
        "staged_accounts": _staged_accounts,
        "refreshed_features": _refreshed_features,
        "selected_accounts": _selected_accounts,
        "statement_rejects": _statement_rejects,
        "accepted_trades": _accepted_trades,
        "html_rejects": lambda s, d: rejected_documents(tables.damaged_html(s, d), tables.HTML_COLUMNS),
        "inbox_scan": _inbox_scan,
        "named_scan": _named_scan,
        "account_counts": lambda s, d: reports.account_counts(tables.latest_trades(s, d)),
        "star_report": _star_report,
    }
    for name in reports.RISK_FLAGS:
        found[name] = _on_cleaned(reports.risk_list, name=name)
    found = {name: (lambda s, d, query=query: _edge(query(s, d))) for name, query in found.items()}
    return found | (llm.QUERIES if llm else {})


def oracle_sql() -> dict[str, str]:
    return oracles.queries() | (llm.ORACLE_SQL if llm else {})
