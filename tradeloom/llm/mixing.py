"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Each document of a source is expected `target / source_size` times (at most `cap`). Expected
copies are summed up along the source's documents, one random offset per source is added, and
a document is emitted once per integer boundary its share crosses. Documents are ordered by
size class, so every stretch of the sum holds all sizes and the words taken stay close to the
target.

A source of any size is split: the prefix sum runs over counts of small cells (size class,
remainder of the id), of which a source has at most `SIZE_CLASSES * CELLS`, and then over the
rows of one cell. Only cell counts and the source table (one row per source) meet in a task.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
CELLS = 512
SEED = "mix"


def word_count(text):
    """Number of runs of other characters than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size):
    """Sizes by their leading six binary digits: within 3 % of each other, ascending."""
    return F.expr(f"length(bin({size})) * 64 + shiftright({size}, greatest(length(bin({size})) - 6, 0))")


def source_targets(cells, weights=WEIGHTS, cap=CAP):
    """Per source key: __source_size, __target, __expected (copies of each document).

    Sources take the weights in turn, by code point, null last, and share the sum of all sizes.
    A target stops at `cap` times its source's size; what is over goes to the others by weight.
    A source is full when the level (words per weight) reaches its room by weight, so with
    sources in ascending order of that ratio the full ones come first and one pass over prefix
    sums finds the level. Sources without words have target 0.
    """
    null_last = [F.col("__key") == "", F.col("__key")]
    size = F.sum("__words").cast("double")
    each = F.array(*[F.lit(float(w)) for w in weights])
    turn = F.row_number().over(Window.orderBy(*null_last)) - 1
    sources = (
        cells.groupBy("__key")
        .agg(size.alias("__source_size"), (size * float(cap)).alias("room"))
        .withColumn("weight", F.element_at(each, turn % len(weights) + 1))
        .withColumn("ratio", F.col("room") / F.col("weight"))
    )
    ascending = Window.orderBy("ratio", *null_last)
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    rest = ascending.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    taken = F.coalesce(F.sum("room").over(before), F.lit(0.0))
    level = (F.sum("__source_size").over(everything) - taken) / F.sum("weight").over(rest)
    leveled = sources.withColumn("level", level).withColumn("full", F.col("level") >= F.col("ratio"))
    first_open = F.min(F.when(~F.col("full"), F.struct("ratio", *null_last, "level"))).over(everything)
    target = F.when(F.col("full"), F.col("room")).otherwise(F.col("weight") * first_open["level"])
    return leveled.withColumn("__target", target).select(
        "__key",
        F.col("__source_size").cast("long").alias("__source_size"),
        "__target",
        F.coalesce(F.try_divide("__target", "__source_size"), F.lit(0.0)).alias("__expected"),
    )


def mix_sources(docs, id="doc_id", text="text", source="source", weights=WEIGHTS, cap=CAP, seed=SEED):
    """Every document with size, source_size, target, copies and taken (words the mix takes).

    All columns of `docs` stay; the new ones replace columns of the same name. Null and empty
    texts have size 0 and take nothing. Null sources form one source. Rows that repeat are
    documents of their own; documents equal in (size, id) are interchangeable. Null ids form a
    cell of their own. An empty table gives an empty result.
    """
    made = ["size", "source_size", "target", "copies", "taken"]
    c = F.col
    named = docs.withColumns({"__id": c(id), "__key": F.coalesce(F.concat(F.lit("="), source), F.lit("")), "__size": word_count(c(text))})
    rows = named.withColumns(
        {"__class": size_class("__size"), "__cell": F.coalesce(F.pmod("__id", F.lit(CELLS)), F.lit(-1))}
    )
    cell = ["__key", "__class", "__cell"]
    cells = rows.groupBy(*cell).agg(F.count("*").alias("__n"), F.sum("__size").alias("__words"))
    before = Window.partitionBy("__key").orderBy("__class", "__cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.md5(F.concat(F.lit(f"{seed}:"), c("__key")).cast("binary"))
    cells = (
        cells.join(source_targets(cells, weights, cap), "__key")
        .withColumns(
            {
                "__before": F.coalesce(F.sum("__n").over(before), F.lit(0)),
                "__offset": F.conv(F.substring(start, 1, 12), 16, 10).cast("double") / float(1 << 48),
            }
        )
        .select(*cell, "__before", "__offset", "__source_size", "__target", "__expected")
    )
    rank = c("__before") + F.row_number().over(Window.partitionBy(*cell).orderBy("__size", "__id"))
    share = lambda n: F.floor(c("__offset") + c("__expected") * n)
    kept = [x for x in docs.columns if x not in made]
    return (
        rows.join(cells, cell)
        .withColumn("__rank", rank)
        .withColumn("__copies", (share(c("__rank")) - share(c("__rank") - 1)).cast("long"))
        .select(
            *kept,
            c("__size").alias("size"),
            c("__source_size").alias("source_size"),
            c("__target").alias("target"),
            c("__copies").alias("copies"),
            (c("__copies") * c("__size")).alias("taken"),
        )
    )


def emit_copies(mixed):
    """One row per copy that the mix takes, numbered from 1 in `copy`; `copies` is dropped."""
    return mixed.filter("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


ORACLE_SQL = """
with sized as (
  select doc_id, source, coalesce('=' || source, '') as key,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
  from documents),
sources as (
  select key, sum(size)::double as source_size, 3.0::double * sum(size) as room,
    ([5.0, 2.0, 1.0])[((row_number() over (order by key = '', key) - 1) % 3 + 1)::int]::double as weight
  from sized group by key),
levels as (
  select *, ((select sum(size) from sized)::double
      - coalesce(sum(room) over (order by room / weight, key = '', key rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by room / weight, key = '', key rows between current row and unbounded following) as level
  from sources),
open as (select level from levels where level < room / weight order by room / weight, key = '', key limit 1),
targets as (
  select key, source_size, case when level >= room / weight then room else weight * (select level from open) end as target,
    ('0x' || substr(md5('mix:' || key), 1, 12))::bigint::double / 281474976710656 as u
  from levels),
ranked as (
  select s.doc_id, s.size, t.source_size, t.target, t.u,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as expected,
    row_number() over (partition by s.key order by length(bin(size)) * 64 + (size >> greatest(length(bin(size)) - 6, 0)),
      coalesce((doc_id % 512 + 512) % 512, -1), size, doc_id nulls first) as rank
  from sized s join targets t using (key))
select doc_id, size, source_size::bigint as source_size, target,
  (size * (floor(u + expected * rank) - floor(u + expected * (rank - 1))))::bigint as taken
from ranked
"""
