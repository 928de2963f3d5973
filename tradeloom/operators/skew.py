"""Running totals over keys of any size.

A window partitioned by account puts a whole account into one task. Accounts up to
`HOT_ROWS` rows take that path. Larger ones are split off and computed level by level
(day, second, ticket range), so no task ever holds more than one small bucket of rows.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import null_safe_plus
from tradeloom.operators.dedupe import dedupe_last
from tradeloom.session import stored

HOT_ROWS = 2_000_000
# Tickets are unique within an account, so one ticket range holds at most 2**20 rows.
TICKET_RANGE_BITS = 20


def ticket_range(c="ticket"):
    return F.shiftright(F.col(c), TICKET_RANGE_BITS)


def hot_keys(df, key, hot_rows=HOT_ROWS):
    """Keys with more than `hot_rows` rows. At most (rows of df / hot_rows) of them exist."""
    return df.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)


def found_hot(df, key, hot_rows, hot=None, most_rows=None):
    """Hot keys as a frame, or None when there are none, by the cheapest way there is.

    hot:       keys that are known to be hot already, from counts kept beside a stored table.
    most_rows: how many rows a key can have at most, where that is known without reading `df`, for
               instance the row count in the footers of the files; few enough, and nothing is read.
    Without either the keys of `df` are counted, which reads those columns once more.
    """
    if hot is None and most_rows is not None and most_rows <= hot_rows:
        return None
    hot = hot_keys(df, key, hot_rows) if hot is None else hot
    return None if hot.isEmpty() else hot


def split_hot(df, key, hot_rows=HOT_ROWS, hot=None, most_rows=None):
    """(rows of ordinary keys, rows of hot keys or None when there are none).

    Ordinary data gets the plain plan. The broadcast list is bounded by rows / hot_rows: 10**12
    rows give at most 500,000 keys. See `found_hot`.
    """
    hot = found_hot(df, key, hot_rows, hot, most_rows)
    if hot is None:
        return df, None
    listed = F.broadcast(hot)
    return df.join(listed, key, "left_anti"), df.join(listed, key, "left_semi")


def join_lookup(rows, lookup, key, hot_rows=HOT_ROWS, how="inner", most_rows=None):
    """Inner or left join with a table of one row per key, where few keys may hold most rows.

    Lookup rows of hot keys are broadcast; they are as few as the hot keys themselves.
    """
    hot = found_hot(rows, key, hot_rows, most_rows=most_rows)
    if hot is None:
        return rows.join(lookup, key, how)
    listed = F.broadcast(hot)
    ordinary = rows.join(listed, key, "left_anti").join(lookup, key, how)
    few = F.broadcast(lookup.join(listed, key, "left_semi"))
    return ordinary.unionByName(rows.join(listed, key, "left_semi").join(few, key, how))


class Ledger(NamedTuple):
    """Account rows in two parts: ordinary accounts, partitioned by account, and hot ones."""

    ordinary: DataFrame
    hot: DataFrame | None

    def map(self, function):
        return Ledger(function(self.ordinary), None if self.hot is None else function(self.hot))

    def combine(self, ordinary, hot):
        """Apply one function per part and put the parts together again.

        The hot part is written to the shared folder first: its function reads the rows
        several times, and stored rows also survive the loss of executors.
        """
        done = ordinary(self.ordinary)
        return done if self.hot is None else done.unionByName(hot(stored(self.hot, "hot-accounts")))

    def union(self):
        return self.ordinary if self.hot is None else self.ordinary.unionByName(self.hot)


def split_ledger(rows, row_order=None, hot_rows=HOT_ROWS, hot=None, most_rows=None, keep_order=False):
    """Partition rows by account, hot accounts apart; keep the last copy of each ticket.

    Copies are dropped when `row_order` names the column that ranks them; with `keep_order` that
    column stays, so no second copy of it has to travel. For ordinary accounts that takes no shuffle of its own: the account partitioning serves both.
    """
    ordinary, hot = split_hot(rows, "account_nr", hot_rows, hot, most_rows)
    ledger = Ledger(ordinary.repartition("account_nr"), hot)
    if row_order:
        ledger = ledger.map(lambda part: dedupe_last(part, row_order))
        if not keep_order:
            ledger = ledger.map(lambda part: part.drop(row_order))
    return ledger


def same_bucket(columns, prefix):
    """Join condition: each column equals its `prefix` namesake, NULL included."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns])


def renamed(df, columns, prefix):
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def join_buckets(rows, totals, columns):
    """Inner join on bucket columns, NULL matching NULL; `totals` has one row per bucket."""
    return rows.join(renamed(totals, columns, "__t_"), same_bucket(columns, "__t_")).drop(*[f"__t_{c}" for c in columns])


def bucket_prefix(rows, key, levels, measures, nulls_first=False):
    """Totals of each finest bucket and running totals of everything before it.

    levels:   column lists from coarse to fine; together they order the rows of a key.
    measures: name -> ("sum" | "max", column expression).
    nulls_first: where NULL level values stand in that order.
    Returns one row per (key, all level columns) with, per measure and level depth d,
    `<name>_before_<d>` (within the enclosing bucket, up to but not including this one)
    and `<name>_own_<d>`. Aggregation runs bottom up with partial aggregation; each
    window sees only the children of one bucket.
    """
    function = {"sum": F.sum, "max": F.max}
    ordered = lambda c: F.col(c).asc_nulls_first() if nulls_first else F.col(c).asc_nulls_last()
    paths = [[key] + [c for level in levels[: d + 1] for c in level] for d in range(len(levels))]

    totals = rows.groupBy(*paths[-1]).agg(
        *[function[how](expr).alias(f"{m}_own_{len(levels) - 1}") for m, (how, expr) in measures.items()]
    )
    frames = [totals]
    for d in range(len(levels) - 2, -1, -1):
        totals = totals.groupBy(*paths[d]).agg(
            *[function[how](f"{m}_own_{d + 1}").alias(f"{m}_own_{d}") for m, (how, _) in measures.items()]
        )
        frames.insert(0, totals)

    result = None
    for d, frame in enumerate(frames):
        parent = paths[d - 1] if d else [key]
        before = (
            Window.partitionBy(*parent)
            .orderBy(*[ordered(c) for c in levels[d]])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        frame = frame.withColumns(
            {
                f"{m}_before_{d}": function[how](f"{m}_own_{d}").over(before)
                for m, (how, _) in measures.items()
            }
        )
        if result is None:
            result = frame
        else:
            outer = renamed(result, parent, "__")
            result = frame.join(outer, same_bucket(parent, "__")).drop(*[f"__{c}" for c in parent])
    return result


def running_sum(measure, through, include_own):
    """Combine the per-level parts of `measure` down to level `through`."""
    parts = [F.col(f"{measure}_before_{d}") for d in range(through + 1)]
    if include_own:
        parts.append(F.col(f"{measure}_own_{through}"))
    return null_safe_plus(*parts)


def running_max(measure, through):
    """Largest value of `measure` before the bucket at level `through`."""
    parts = [F.col(f"{measure}_before_{d}") for d in range(through + 1)]
    return F.greatest(*parts) if len(parts) > 1 else parts[0]
