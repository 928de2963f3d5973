"""Whole-frame helpers: naming, typing and row identity."""

from pyspark.sql import functions as F

from tradeloom.functions.columns import row_key
from tradeloom.schemas import ROW_KEY_SEPARATOR


def normalise_names(df):
    """Runs of blanks in column names become one underscore; names become lower case."""
    return df.toDF(*["_".join(c.split()).lower() for c in df.columns])


def recast(df, date_cols=(), float_cols=(), int_cols=(), str_cols=(), date_format=None):
    """Enforce column types: bad numbers become NULL, bad dates raise.

    An integer is read through a decimal, so that text such as "12.0" keeps its value.
    """
    typed = {}
    for c in date_cols:
        if date_format:
            typed[c] = F.to_timestamp_ntz(F.col(c), F.lit(date_format))
        else:
            typed[c] = F.col(c).cast("timestamp_ntz")
    for c in float_cols:
        typed[c] = F.col(c).try_cast("double")
    for c in int_cols:
        number = F.col(c).try_cast("decimal(38,10)")
        typed[c] = F.when(number == F.floor(number), number.try_cast("long"))
    for c in str_cols:
        typed[c] = F.col(c).cast("string")
    return df.withColumns(typed)


def with_row_key(df, columns=None, name="delta_id", separator=ROW_KEY_SEPARATOR):
    """Add a text key of the chosen columns (all by default)."""
    return df.withColumn(name, row_key(list(columns or df.columns), separator))


def distinct_rows(df):
    """Full-row distinct; partial aggregation removes copies before the shuffle."""
    return df.dropDuplicates()
