"""CSV and Parquet scans and sinks, file listing, atomic publishing."""

import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tradeloom.operators.skew import HOT_ROWS, join_lookup
from tradeloom.schemas import (
    ACCOUNT_FILE_NAMES,
    ACCOUNT_SCHEMA,
    FACT_FILE_NAMES,
    GRID_SCHEMA,
    TRADE_SCHEMA,
)
from tradeloom.session import stored


def _inverse(names):
    return {v: k for k, v in names.items()}


def read_csv(spark, path, schema):
    """CSV with a header row; the schema is given, never inferred."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_csv(df, path, sort_columns=()):
    """CSV with a header row, overwriting; rows are sorted within each output file."""
    if sort_columns:
        df = df.sortWithinPartitions(*sort_columns)
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_fact_files(trades, path):
    write_csv(trades.withColumnsRenamed(FACT_FILE_NAMES), path, ["account_number", "ticket"])


def read_fact_files(spark, path):
    schema = type(TRADE_SCHEMA)()
    for field in TRADE_SCHEMA:
        schema = schema.add(FACT_FILE_NAMES.get(field.name, field.name), field.dataType)
    return read_csv(spark, path, schema).withColumnsRenamed(_inverse(FACT_FILE_NAMES))


def write_account_files(accounts, path):
    write_csv(accounts.withColumnsRenamed(ACCOUNT_FILE_NAMES), path, ["acct_nr"])


def read_account_files(spark, path):
    schema = type(ACCOUNT_SCHEMA)()
    for field in ACCOUNT_SCHEMA:
        schema = schema.add(ACCOUNT_FILE_NAMES[field.name], field.dataType)
    return read_csv(spark, path, schema).withColumnsRenamed(_inverse(ACCOUNT_FILE_NAMES))


def _type_glob(file_types):
    """Names that contain `.type` for one of the types; `.xls` therefore also takes `.xlsx`."""
    if file_types is None:
        return None
    types = [file_types] if isinstance(file_types, str) else list(file_types)
    return "*{" + ",".join(f".{t}" for t in types) + "}*"


MOST_HEADERS = 50_000  # of a kilobyte or less
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTINGS_PER_CORE = 8


@contextmanager
def _listed_by_few_tasks(spark):
    """Inside, folders and files are found by a few tasks per core: Spark starts up to 10,000 for them.

    The session gets its own setting back.
    """
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, min(int(before), LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def list_files(spark, folder, file_types=None, recursive=False):
    """Name and full path of the files in a folder; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    glob = _type_glob(file_types)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    with _listed_by_few_tasks(spark):
        found = reader.load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path")


def read_grid_files(spark, folder, file_types="csv"):
    """Statement grids exported as CSV: row position first, then the 14 cells, no header."""
    schema = type(GRID_SCHEMA)(GRID_SCHEMA.fields[1:])
    grid = spark.read.schema(schema).option("pathGlobFilter", _type_glob(file_types)).csv(folder)
    return grid.select(F.col("_metadata.file_name").alias("file"), *schema.fieldNames())


def statement_of(path):
    """The statement a file belongs to: its `statement=` folder, or its own name."""
    folder = F.regexp_extract(path, r"/statement=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.element_at(F.split(path, "/"), -1))


def write_grid_files(grid, folder):
    """Statement grids as CSV, a folder per statement; files already there stay."""
    named = grid.withColumnRenamed("file", "statement").repartition("statement").sortWithinPartitions("statement", "row_idx")
    named.write.mode("append").partitionBy("statement").csv(folder)


def unseen_files(spark, folder, seen, file_types="csv"):
    """Paths below `folder` that the listing at `seen` does not hold; the listing is a table that grows."""
    listed = list_files(spark, folder, file_types, recursive=True).select("path")
    schema = "path string, scan_nr long"
    try:
        known = spark.read.schema(schema).parquet(seen)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], schema)
    return listed.join(known, "path", "left_anti"), known


def scan_new_grids(spark, folder, seen, file_types="csv"):
    """Grid rows of the files that no earlier scan has read, with the number of this scan.

    The paths reach the driver, as Spark's own file index does. The listing is written when the
    rows have been taken over: call `remember` then; a scan that failed is simply made again.
    """
    fresh, known = unseen_files(spark, folder, seen, file_types)
    paths = [r.path for r in fresh.collect()]
    scan = (known.agg(F.max("scan_nr")).first()[0] or 0) + 1
    schema = type(GRID_SCHEMA)(GRID_SCHEMA.fields[1:])
    if not paths:
        return spark.createDataFrame([], GRID_SCHEMA).withColumn("scan_nr", F.lit(scan).cast("long")), lambda: None
    with _listed_by_few_tasks(spark):
        grid = spark.read.schema(schema).csv(paths)
    grid = grid.select(statement_of(F.col("_metadata.file_path")).alias("file"), *schema.fieldNames())

    def remember():
        rows = spark.createDataFrame([(p, scan) for p in paths], "path string, scan_nr long")
        rows.coalesce(1).write.mode("append").parquet(seen)

    return grid.withColumn("scan_nr", F.lit(scan).cast("long")), remember


def read_named_csv(spark, folder, names, width=64, hot_rows=HOT_ROWS, most_headers=MOST_HEADERS):
    """CSV files whose columns are found by each file's own header row.

    names: normalised header text (lower case, blanks as one underscore) to output name, several
    spellings for one output allowed. A file may order and spell its columns as it likes; columns
    it lacks are NULL, columns that no name stands for are left out. The header row is the row that
    holds most names of `names` as cells, at least half of the outputs; rows of files without one
    come with every column NULL except `file`. Header rows are stored; up to `most_headers` of them are
    broadcast, so that the other rows stay where they were read.
    """
    cells = [f"c{i}" for i in range(width)]
    rows = spark.read.schema(", ".join(f"{c} string" for c in cells)).option("mode", "PERMISSIVE").csv(folder)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.array(*cells).alias("cells"))
    plain = F.transform("cells", lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s+", "_")))
    outputs = list(dict.fromkeys(names.values()))
    # Most rows have no cell that could be a name, which shows without a regular expression.
    bare = lambda text: F.translate(F.lower(text), " \t\n\x0b\f\r_", "")
    near = list(dict.fromkeys("".join(c for c in n if c != "_") for n in names))
    likely = F.exists("cells", lambda c: bare(c).isin(near)) if near else F.lit(True)
    rows = rows.withColumn("likely", F.coalesce(likely, F.lit(False)))
    known = F.size(F.array_intersect(plain, F.array(*map(F.lit, names))))
    rows = rows.withColumn("known", F.when(F.col("likely"), known).otherwise(0))
    is_header = F.col("known") >= F.lit((len(outputs) + 1) // 2)
    heads = rows.filter(is_header).groupBy("file").agg(F.max_by(plain, "known").alias("header"))
    heads, body = stored(heads, "headers"), rows.filter(~is_header).select("file", "cells")
    if heads.count() <= most_headers:
        body = body.join(F.broadcast(heads), "file", "left")
    else:
        body = join_lookup(body, heads, "file", hot_rows, "left")
    place = lambda spelling: F.nullif(F.array_position("header", F.lit(spelling)), F.lit(0).cast("long"))
    spelt = {o: [place(n) for n, out in names.items() if out == o] for o in outputs}
    cell = lambda o: F.get("cells", (F.coalesce(*spelt[o]) - 1).cast("int")).alias(o)
    return body.select("file", *[cell(o) for o in outputs])


def read_html_files(spark, folder, file_types="htm"):
    """One row per HTML file with its whole text."""
    reader = spark.read.option("pathGlobFilter", _type_glob(file_types))
    return reader.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("html"))


def append_table(df, path):
    df.write.mode("append").parquet(path)


def publish(df, root, name):
    """Write a fresh version of a table and point its temporary view at it.

    Readers of the previous version keep their files; a failed write changes nothing.
    """
    path = f"{root.rstrip('/')}/{name}/version={uuid.uuid4().hex}"
    df.write.parquet(path)
    published = df.sparkSession.read.schema(df.schema).parquet(path)
    published.createOrReplaceTempView(name)
    return published
