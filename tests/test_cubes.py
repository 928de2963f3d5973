import datetime as dt

import pytest
from brute import main_days
from conftest import trade_frame
from pyspark.sql import functions as F

from tradeloom.operators.cleaned import cleaned_features
from tradeloom.operators.measures import DAILY_SUMMARY, names, side_measures
from tradeloom.operators.skew import split_ledger
from tradeloom.plans import cubes, reports
from tradeloom.plans.kpi import kpi_report


@pytest.fixture(scope="module")
def features(spark, skewed_rows):
    path_rows = cleaned_features(split_ledger(trade_frame(spark, skewed_rows)))
    return path_rows.cache()


def rows(df):
    return sorted(map(repr, df.collect()))



def test_measure_numbers(features):
    assert len(names(DAILY_SUMMARY)) == 38
    assert len(side_measures("long")) == len(side_measures("short")) == 28
    assert len(cubes.daily_main(features).drop("account_nr", "calendar_day", "date_key", "day_name", "carried_profit").columns) == 13


def test_daily_main_matches_brute_force(features, skewed_rows):
    got = {
        (r["account_nr"], r["calendar_day"]): (
            r["net_profit"], r["cumulative_profit"], r["avg_return"], r["std_return"], r["std_neg_return"], r["trade_scalping"],
        )
        for r in cubes.daily_main(features).collect()
    }
    assert got == main_days(skewed_rows)


def test_last_day_extends_the_calendar(features):
    last = dt.date(2024, 2, 1)
    ends = cubes.daily_main(features, last).groupBy("account_nr").agg(F.max("calendar_day").alias("d")).collect()
    assert {r["d"] for r in ends} == {last}


def spine_join(features, rows, measures):
    """Calendar left join aggregate, the long way round."""
    spine = (
        features.groupBy("account_nr")
        .agg(F.min("open_date").alias("a"), F.max("open_date").alias("b"))
        .select("account_nr", F.explode(F.sequence("a", "b")).alias("calendar_day"))
    )
    on = (spine.account_nr == rows.account_nr) & (spine.calendar_day == rows.day)
    return spine.join(rows, on, "left").select(
        spine.account_nr, "calendar_day", "symbol", *[F.coalesce(F.col(m.name), F.lit(0)).alias(m.name) for m in measures]
    )


def test_gap_filling_equals_calendar_join(features):
    aggregated = cubes.symbol_days(cubes.trade_cells(features), DAILY_SUMMARY).filter("symbol is not null")
    want = spine_join(features, aggregated, DAILY_SUMMARY)
    got = cubes.daily_summary(features).select(want.columns)
    assert rows(got.select(*[F.col(c).cast("string") for c in want.columns])) == rows(
        want.select(*[F.col(c).cast("string") for c in want.columns])
    )


@pytest.mark.parametrize("word", ["long", "short"])
def test_short_form_counts_the_empty_days(features, word):
    full = cubes.daily_side(features, word)
    short = cubes.daily_side(features, word, empty_days="count")
    assert full.count() == short.agg(F.sum(F.col("empty_days_after") + 1)).head()[0]
    kept = full.filter("symbol is not null").select(*[c for c in full.columns])
    assert rows(kept) == rows(short.filter("symbol is not null").drop("empty_days_after"))


def test_trades_without_symbol_are_an_empty_day(spark, features):
    blank = features.withColumn("symbol", F.when(F.col("account_nr") != 3, F.col("symbol")))
    got = cubes.daily_summary(blank).filter("account_nr = 3")
    assert got.filter("symbol is not null or trades_opened > 0").count() == 0
    days = features.filter("account_nr = 3").agg(F.date_diff(F.max("open_date"), F.min("open_date")) + 1).head()[0]
    assert got.count() == days


def test_joined_cube_equals_joins_of_the_tables(features):
    parts = [cubes.daily_summary(features), cubes.daily_side(features, "long"), cubes.daily_side(features, "short")]
    want = cubes.join_summaries(*parts)
    got = cubes.joined_cube(features)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_invariants(features):
    cube = cubes.joined_cube(features, empty_days="count")
    sums = cube.agg(*[F.sum(c).alias(c) for c in ("trades_opened", "trades_closed", "trades_won", "trades_lost", "trades_neutral", "longs_opened", "shorts_opened")]).head()
    assert sums["trades_opened"] == features.count() == sums["longs_opened"] + sums["shorts_opened"]
    known = features.filter("trade_closed = 1 and net_profit is not null").count()
    assert sums["trades_won"] + sums["trades_lost"] + sums["trades_neutral"] == known
    main = cubes.daily_main(features)
    last = main.groupBy("account_nr").agg(
        F.max_by("carried_profit", "calendar_day").alias("end"), F.round(F.sum("net_profit"), 4).alias("total")
    )
    assert last.filter(F.abs(F.col("end") - F.col("total")) > 1e-6).count() == 0


def test_kpis_from_the_daily_tables(features):
    """The report against plain sums over the joined cube and daily main."""
    cube = cubes.joined_cube(features).toPandas()
    main = cubes.daily_main(features).toPandas()
    for r in kpi_report(features).collect():
        d, m = cube[cube.account_nr == r["account_nr"]], main[main.account_nr == r["account_nr"]]
        assert r["closed_trades"] == d.trades_closed.sum() and r["n_longs"] == d.longs_closed.sum()
        assert r["amount_won"] == pytest.approx(d.amount_won.sum(), abs=0.006)
        assert r["max_profit"] == pytest.approx(d.max_profit.max(), abs=0.006)
        assert r["max_loss"] == pytest.approx(d.max_loss.min(), abs=0.006)
        first = d[d.max_loss == d.max_loss.min()].sort_values(["calendar_day", "symbol"]).iloc[0]
        assert r["max_loss_date"] == first.calendar_day
        assert r["average_return"] == pytest.approx(m.avg_return.mean() * 100, abs=0.006)
        assert r["std_return"] == pytest.approx(m.std_return.mean() * 100, abs=0.006)
        assert r["scalping_trades"] == m.trade_scalping.sum()
        if r["std_return"]:
            assert r["sharpe_ratio"] == pytest.approx(r["average_return"] / r["std_return"] * 252**0.5, abs=0.006)
        assert r["start_date"] == d[d.trades_opened > 0].calendar_day.min()


def test_duration_histogram_matches_numpy(features):
    import numpy as np

    main = cubes.daily_main(features).toPandas()
    got = reports.duration_histogram(features).toPandas()
    for account, days in main.groupby("account_nr"):
        counts, edges = np.histogram(days.minutes_spent, bins=15)
        mine = got[got.account_nr == account].sort_values("bin")
        assert list(mine.days) == list(counts)
        assert np.allclose(mine.bin_start, edges[:-1]) and np.allclose(mine.bin_end, edges[1:])


def test_weekday_amounts_cover_gaps(features):
    main = cubes.daily_summary(features)
    want = main.groupBy("account_nr", "day_name").agg(F.round(F.sum("amount_won"), 2).alias("w"))
    got = reports.weekday_amounts(features).select("account_nr", "day_name", F.round("amount_won", 2).alias("w"))
    assert rows(got) == rows(want)


def test_risk_lists(features):
    for name, column in reports.RISK_FLAGS.items():
        assert reports.risk_list(features, name).count() == features.filter(f"{column} = 1").count()


def test_join_in_short_equals_the_join_of_full_tables(features):
    tables = lambda how: [cubes.daily_summary(features, empty_days=how), *(cubes.daily_side(features, w, empty_days=how) for w in ("long", "short"))]
    short = cubes.join_summaries(*tables("count"))
    got = cubes.with_empty_days(short, DAILY_SUMMARY + side_measures("long") + side_measures("short"))
    want = cubes.join_summaries(*tables("rows"))
    assert got.columns == want.columns and rows(got) == rows(want)
