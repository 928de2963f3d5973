"""Staging tables: every load keeps its new and changed rows, readers see the last version per key.

A table is a folder of loads (`load_nr=1`, `load_nr=2`, ...), each partitioned by a hash bucket of
the account. A load compares its rows with the last versions of the buckets it touches and writes
those that are new or differ. Writing a load again replaces its own folder, so a load that failed
half way leaves nothing behind, and a load without news writes none. Rows whose key has a NULL are
refused; they belong to the rejects.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators.skew import HOT_ROWS
from tradeloom.session import remove, shuffles_dropped

LOAD, BUCKET, THROUGH = "load_nr", "account_bucket", "through_load"
BUCKETS = 64


class StagingTable(NamedTuple):
    path: str
    columns: list
    key: list
    account: str
    buckets: int = BUCKETS


def bucket_of(column, buckets=BUCKETS):
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def clustered(rows, table):
    """Rows with their bucket, one bucket's rows together; adaptive execution splits large buckets."""
    return rows.withColumn(BUCKET, bucket_of(table.account, table.buckets)).hint("rebalance", BUCKET)


def all_versions(spark, table, schema):
    """Every row ever loaded with its load number, or None before the first load."""
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name in table.columns]
    try:
        return spark.read.schema(", ".join([*names, f"{LOAD} long", f"{BUCKET} int"])).parquet(table.path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def last_versions(rows, table):
    """The last version of each key with its load number and the number of versions."""
    rest = [c for c in rows.columns if c not in table.key]
    newest = F.max_by(F.struct(*rest), LOAD).alias("newest")
    return rows.groupBy(*table.key).agg(newest, F.count("*").cast("long").alias("n_versions")).select(*table.key, "newest.*", "n_versions")


def _same(columns, one, other):
    return reduce(lambda a, b: a & b, [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in columns])


def compared(fresh, known, table):
    """Every key of either side with `state`: new, changed, equal or gone, and both rows as structs."""
    side = lambda rows, name: rows.select(*[F.col(k).alias(f"{name}_{k}") for k in table.key], F.struct(*table.columns).alias(name))
    same_key = reduce(lambda a, b: a & b, [F.col(f"fresh_{k}") == F.col(f"known_{k}") for k in table.key])
    both = side(fresh, "fresh").join(side(known, "known"), same_key, "full")
    state = (
        F.when(F.col("known").isNull(), "new")
        .when(F.col("fresh").isNull(), "gone")
        .when(_same(table.columns, "fresh", "known"), "equal")
        .otherwise("changed")
    )
    return both.select(state.alias("state"), "fresh", "known")


def load(fresh, table):
    """Write what `fresh` brings as the next load; returns (load number or None, state counts).

    `fresh` has one row per key. Only the buckets it touches are read from the table; keys that a
    touched bucket holds and `fresh` lacks are counted as gone and stay.
    """
    spark = fresh.sparkSession
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in table.key])
    fresh = fresh.select(*table.columns).filter(whole)
    versions = all_versions(spark, table, fresh.schema)
    number = 1
    if versions is not None:
        number += versions.agg(F.max(LOAD)).first()[0] or 0
        # At most `buckets` values.
        touched = [r[0] for r in fresh.select(bucket_of(table.account, table.buckets)).distinct().collect()]
        versions = versions.filter(F.col(BUCKET).isin(touched))
        known = last_versions(versions, table)
    else:
        known = fresh.limit(0)
    # What the comparison tells is written, since both the counts and the load are read from it: the rows of news alone.
    path = f"{table.path.rstrip('/')}-compared"
    told = compared(fresh, known, table).select("state", F.when(F.col("state").isin("new", "changed"), F.col("fresh")).alias("fresh"))
    with shuffles_dropped(spark):
        told.write.mode("overwrite").parquet(path)
    states = spark.read.schema(told.schema).parquet(path)
    try:
        return _written(states, table, number)
    finally:
        remove(spark, path)


def _written(states, table, number):
    """Write the news of a comparison as load `number`; what `load` returns."""
    counts = {r.state: r["count"] for r in states.groupBy("state").count().collect()}
    news = states.filter("state in ('new', 'changed')").select("fresh.*")
    if not counts.get("new", 0) + counts.get("changed", 0):
        return None, counts
    with shuffles_dropped(states.sparkSession):
        clustered(news, table).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{table.path.rstrip('/')}/{LOAD}={number}")
    # Keys of an account never go away, so its size is the sum of what loads have added.
    added = states.filter("state = 'new'").groupBy(F.col(f"fresh.{table.account}").alias(table.account)).agg(F.count("*").alias("n"))
    added.write.mode("overwrite").parquet(f"{table.path.rstrip('/')}-sizes/{LOAD}={number}")
    return number, counts


def large_accounts(spark, table, hot_rows):
    """Accounts with more than `hot_rows` keys, from the counts that loads keep; the table is not read."""
    sizes = spark.read.parquet(f"{table.path.rstrip('/')}-sizes").groupBy(table.account).agg(F.sum("n").alias("n"))
    return sizes.filter(F.col("n") > hot_rows).select(table.account)


def current(spark, table, schema, accounts=None):
    """The table as readers see it: one row per key. `accounts` selects some before anything is read."""
    versions = all_versions(spark, table, schema)
    if accounts is not None:
        versions = of_accounts(versions, table, accounts)
    return last_versions(versions, table)


def of_accounts(rows, table, accounts):
    """Rows of the chosen accounts: a list prunes bucket folders and row groups, a frame prunes when it runs."""
    if isinstance(accounts, DataFrame):
        chosen = accounts.select(F.col(accounts.columns[0]).alias("chosen")).distinct()
        chosen = chosen.withColumn("chosen_bucket", bucket_of("chosen", table.buckets))
        return rows.join(chosen, (F.col(BUCKET) == F.col("chosen_bucket")) & (F.col(table.account) == F.col("chosen")), "left_semi")
    literal = [F.lit(a).cast(rows.schema[table.account].dataType) for a in accounts]
    wanted = reduce(lambda a, b: a | b, [F.col(BUCKET) == bucket_of(a, table.buckets) for a in literal])
    return rows.filter(wanted & F.col(table.account).isin(*literal))


def refresh(spark, table, schema, derive, path, hot_rows=HOT_ROWS):
    """Stored derived rows of the table, made again for the buckets that changed since they were made.

    derive: rows of whole accounts, and the accounts that are large (`large_accounts`), to derived
    rows (per-trade features, for instance), which keep the account column. Each derived row carries the last load of its bucket, so a refresh that
    failed, or never ran, is made up for by the next one; other buckets keep their files.
    """
    versions = all_versions(spark, table, schema)
    loads = versions.groupBy(BUCKET).agg(F.max(LOAD).alias("due"))  # partition values alone
    large = large_accounts(spark, table, hot_rows)
    derived = derive(versions.select(*table.columns).limit(0), large)
    kept = derived.schema.add(THROUGH, T.LongType()).add(BUCKET, T.IntegerType())
    try:
        made = spark.read.schema(kept).parquet(path)
        due = loads.join(made.groupBy(BUCKET).agg(F.max(THROUGH).alias("through")), BUCKET, "left").filter("through is null or through < due")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        due = loads
    due = {r[0]: r[1] for r in due.select(BUCKET, "due").collect()}  # at most `buckets` entries
    if due:
        changed = versions.filter(F.col(BUCKET).isin(list(due)))
        if large.isEmpty():
            # One shuffle by account serves the last versions and what is derived per account.
            changed = changed.repartition(table.account)
        rows = derive(last_versions(changed, table).select(*table.columns), large)
        rows = clustered(rows, table).withColumn(THROUGH, F.lit(max(due.values())).cast("long"))
        with shuffles_dropped(spark):
            rows.write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return spark.read.schema(kept).parquet(path).drop(BUCKET, THROUGH), sorted(due)
