"""Column expressions used across the package. All are built-in Spark functions."""

from functools import reduce

from pyspark.sql import functions as F

from tradeloom.schemas import MONEY, ROW_KEY_SEPARATOR, TEXT_TIMESTAMP, WEEKDAYS


def money(c):
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def date_key(ts):
    """yyyymmdd as a number, without going through text or a time zone."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("long")


def day_name(day):
    """English name of a date's weekday, looked up by number: no text formatter runs per row."""
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(day) + 1)


def day_of_key(key):
    """Date of a yyyymmdd number."""
    return F.make_date(
        (key / 10000).cast("int"), (key / 100 % 100).cast("int"), (key % 100).cast("int")
    )


def time_of_day(ts):
    """HH:mm:ss text of a timestamp without time zone."""
    return F.substring(ts.cast("string"), 12, 8)


def seconds_between(start, end):
    """Exact seconds, as a decimal, between two timestamps without time zone."""
    return (end - start).cast("interval second").cast(MONEY)


def parse_text_timestamp(c):
    """Timestamp of yyyy.MM.dd HH:mm:ss text; other non-NULL text raises."""
    return F.to_timestamp_ntz(c, F.lit(TEXT_TIMESTAMP))


def text_date_key(c):
    """Day part of yyyy.MM.dd HH:mm:ss text as a number."""
    return F.replace(F.split_part(c, F.lit(" "), F.lit(1)), F.lit("."), F.lit("")).try_cast("long")


def float_round(c, digits):
    """Round a double half to even after scaling, the rule of binary floating point tables."""
    if digits == 0:
        return F.rint(c)
    scale = F.lit(float(10**digits))
    return F.rint(c * scale) / scale


def null_safe_plus(*cols):
    """Sum of the non-NULL arguments; NULL when all are NULL."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])
    return F.when(reduce(lambda a, b: a | b, [c.isNotNull() for c in cols]), total)


def flag(condition):
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def switch_values(c, mapping, strict=True):
    """Replace each value by its entry in `mapping`; a missing key raises when strict."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    if not pairs:
        found = F.lit(None).cast("string")
    else:
        found = F.create_map(*pairs)[c]
    if not strict:
        return found
    known = c.isin(*mapping) if mapping else F.lit(False)
    return F.when(known, found).otherwise(
        F.raise_error(F.concat(F.lit("no mapping for "), F.coalesce(c.cast("string"), F.lit("NULL"))))
    )


def row_key(columns, separator=ROW_KEY_SEPARATOR):
    """One text per row from the given columns; NULL is spelled out so that it takes part."""
    return F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns])
