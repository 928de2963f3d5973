"""Gold layer: explicit projections, temporary views and file export."""

import time
import uuid
from functools import reduce

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from tradeloom.operators.dims import dim_account, dim_clock, dim_date
from tradeloom.operators.features import trade_history
from tradeloom.schemas import (
    GOLD_ACCOUNT_COLUMNS,
    GOLD_CLOCK_COLUMNS,
    GOLD_DATE_COLUMNS,
    GOLD_TRADE_COLUMNS,
)
from tradeloom.sources.files import write_csv

# Order in which each export is written.
SORT_COLUMNS = {
    "trade_history": ["account_nr", "ticket"],
    "dim_account_info": ["account_number"],
    "dim_date": ["cal_date"],
    "dim_clock": ["clock"],
}


def trade_view(features):
    return trade_history(features).select(*GOLD_TRADE_COLUMNS)


def account_view(accounts):
    return dim_account(accounts).select(*GOLD_ACCOUNT_COLUMNS)


def date_view(bounds):
    return dim_date(bounds).select(*GOLD_DATE_COLUMNS)


def clock_view(spark):
    return dim_clock(spark).select(*GOLD_CLOCK_COLUMNS)


def gold_views(features, accounts, bounds, register=False):
    """The four published frames by name; registered as temporary views on request."""
    views = {
        "trade_history": trade_view(features),
        "dim_account_info": account_view(accounts),
        "dim_date": date_view(bounds),
        "dim_clock": clock_view(features.sparkSession),
    }
    if register:
        for name, df in views.items():
            df.createOrReplaceTempView(f"gold_{name}")
    return views


def watched_days(features):
    """(features, a function that gives the bounds of their opening days as one row).

    The bounds are taken while the features are written for another view; before the first
    action on the returned features the function waits.
    """
    seen, day = Observation(), F.to_date("open_datetime")
    watched = features.observe(seen, F.min(F.unix_date(day)).alias("first"), F.max(F.unix_date(day)).alias("last"))

    def bounds():
        days = [seen.get[name] for name in ("first", "last")]
        return features.sparkSession.range(1).select(
            *[F.date_from_unix_date(F.lit(n).cast("int")).alias(name) for n, name in zip(days, ("first_day", "last_day"))]
        )

    return watched, bounds


def checksum(df):
    """Sum of row hashes: the same for the same rows in any order."""
    return F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")), F.lit(0)).cast("string")


def export_gold(views, folder):
    """Write each view as CSV and publish all of them in one step; returns the paths by view name.

    A view may be a function that makes it, called when the views before it are written.
    Views go to a fresh folder. Its files are read back into the manifest (view, path, rows,
    checksum, columns); writing that makes them the current export. An export that fails on the
    way leaves the former one current.
    """
    folder = folder.rstrip("/")
    spark = next(iter(views.values())).sparkSession
    paths = {name: f"{folder}/version={uuid.uuid4().hex}/{name}" for name in views}
    made = {}
    for name, view in views.items():
        made[name] = view() if callable(view) else view
        write_csv(made[name], paths[name], SORT_COLUMNS[name])
    listed = []
    for number, (name, df) in enumerate(made.items()):
        back = spark.read.schema(df.schema).option("header", True).option("mode", "FAILFAST").csv(paths[name])
        listed.append(
            back.agg(F.count("*").alias("n_rows"), checksum(back).alias("checksum")).select(
                F.lit(number).alias("place"), F.lit(name).alias("view_name"), F.lit(paths[name]).alias("path"), "n_rows", "checksum",
                F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)).alias("columns"),
            )
        )
    manifest = reduce(lambda a, b: a.unionByName(b), listed).withColumn("published", F.lit(time.time_ns()))
    manifest.coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return paths


def read_manifest(spark, folder):
    """The current export: (view_name, path, n_rows, checksum, columns)."""
    schema = "place int, view_name string, path string, n_rows long, checksum string, columns string, published long"
    every = spark.read.schema(schema).json(f"{folder.rstrip('/')}/manifest")
    last = every.agg(F.max("published")).first()[0]
    return every.filter(F.col("published") == last).orderBy("place").drop("place", "published")


def read_export(spark, folder, verify=True):
    """Frames of the current export by view name; a file that does not hold what was listed is an error."""
    found = {}
    for r in read_manifest(spark, folder).collect():
        df = spark.read.schema(r.columns).option("header", True).option("mode", "FAILFAST").csv(r.path)
        if verify:
            now = df.agg(F.count("*").alias("n"), checksum(df).alias("sum")).first()
            if (now.n, now.sum) != (r.n_rows, r.checksum):
                raise ValueError(f"{r.view_name} at {r.path} is not what was exported")
        found[r.view_name] = df
    return found


def file_order(spark, folder):
    """Per exported view the rows, and those that do not come before their predecessor in the same file."""
    found = []
    for r in read_manifest(spark, folder).collect():
        rows = spark.read.schema(r.columns).option("header", True).csv(r.path)
        rows = rows.select(
            "_metadata.file_path",
            "_metadata.file_block_start",  # a split of a file is read by one task, from top to bottom
            F.monotonically_increasing_id().alias("line"),
            F.struct(*SORT_COLUMNS[r.view_name]).alias("key"),
        )
        split = Window.partitionBy("file_path", "file_block_start").orderBy("line")
        rows = rows.withColumn("before", F.lag("key").over(split))
        in_order = F.count_if(F.col("before").isNull() | (F.col("before") <= F.col("key")))
        found.append(rows.agg(F.count("*").alias("n_rows"), in_order.alias("n_in_order")).withColumn("view_name", F.lit(r.view_name)))
    return reduce(lambda a, b: a.unionByName(b), found).select("view_name", "n_rows", "n_in_order")
