"""Delta loads: typed, NULL-safe comparison of whole rows."""

from functools import reduce

from pyspark.sql import functions as F

from tradeloom.schemas import TRADE_COLUMNS


def rows_not_in(rows, other, columns=TRADE_COLUMNS, unique=False):
    """Rows of the first frame without an equal row in the second; copies are kept.

    A hash of the row leads the join key, so the sort is decided by one long; the columns
    are compared too, hence a hash collision cannot lose a row. Copies in `rows` all meet
    one key; adaptive execution splits that side. Copies in `other` are merged before the
    shuffle, unless `unique` says there are none.
    """
    columns = list(columns)
    other = other.select(*columns)
    if not unique:
        other = other.dropDuplicates()
    left = rows.withColumn("__h", F.xxhash64(*columns)).alias("l")
    right = other.withColumn("__h", F.xxhash64(*columns)).alias("r")
    same_values = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns]
    same_row = reduce(lambda a, b: a & b, same_values, F.col("l.__h") == F.col("r.__h"))
    return left.join(right, same_row, "left_anti").drop("__h")


def delta_append(source, target, columns=TRADE_COLUMNS):
    """Source rows the target does not hold yet; the target's key makes its rows unique."""
    return rows_not_in(source, target, columns, unique=True)


def delta_stale(source, target, columns=TRADE_COLUMNS):
    """Target rows the source no longer holds; they are reported, not removed."""
    return rows_not_in(target, source, columns)


def delta_upsert(source, target, key=("account_nr", "ticket")):
    """Target after the load: source rows, one per key, replace the target's rows of their key."""
    untouched = target.join(source.select(*key), list(key), "left_anti")
    return untouched.select(*source.columns).unionByName(source)
