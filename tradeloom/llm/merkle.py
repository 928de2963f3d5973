"""Merkle manifest of a dataset: a tree of sixteens per source, one tree over the sources.

A leaf is the hash of a document's fields. Nodes of a group (first the leaves of a source, later
the subroots of all sources) have positions 0, 1, ...; sixteen consecutive ones are a run. In a
window over the run, lag and lead columns of fixed offsets 1 to 15, masked by the node's slot
and the run's length, supply its siblings; the row of slot 0 hashes the parent. A level is a
sixteenth of the one below; levels end when each group has one node. Siblings are then handed
down: children meet their parent's path by (group, run), which is the window's partitioning too.

Positions come from one range sort: partitions are numbered in order, rows are numbered within
them, and the counts of (partition, group) are summed up. No task holds a whole source.

Defined results: a null field is `-`. Null ids come first in their source, null sources first of
all; rows of one id and source are ordered by their leaf. Repeated rows are leaves of their own.
An empty text is `0:`; texts of any length are hashed whole. An empty table gives no rows.
Columns other than the five fields are ignored.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.llm.linking import counted_small
from tradeloom.session import discard, stored

RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts):
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(column):
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs):
    """(source, doc_id, leaf, now): the leaf as listed, and as it is after tampering."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = fields | {"text": F.translate("text", UPPER, LOWER)}
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_OF == 0
    return docs.select(*FIELDS).select(
        "source",
        "doc_id",
        digest(*map(_field, fields.values())).alias("leaf"),
        F.when(struck, digest(*map(_field, changed.values()))).alias("now"),
    )


def positioned(nodes, group, order):
    """Stored `nodes` with at (position within the group, by `order`) and size (nodes of the group).

    group, order: lists of columns, nulls first. Equal rows are told apart by a row number, so a
    range never has to hold more of them than others.
    """
    nodes = nodes.withColumn("row", F.monotonically_increasing_id())
    rows = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [*group, *order, "row"]
    numbered = nodes.repartitionByRange(rows, *by).sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id())
    numbered = stored(numbered.withColumn("part", F.shiftright("row", 33)), "numbered")
    keys = F.struct(*group)
    cells = numbered.groupBy(keys.alias("cell"), "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    # A row per range and group: a group that fills many ranges has one row for each of them.
    ranges = Window.partitionBy("cell").orderBy("part")
    before = F.coalesce(F.sum("n").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select("cell", "part", "first", before.alias("before"), F.sum("n").over(Window.partitionBy("cell")).alias("size"))
    cells = stored(cells.withColumnRenamed("part", "cell_part"), "cells")
    same = (F.col("part") == F.col("cell_part")) & keys.eqNullSafe(F.col("cell"))
    placed = numbered.join(counted_small(cells), same).withColumn("at", F.col("before") + F.col("row") - F.col("first"))
    return placed.drop("cell", "cell_part", "first", "before", "row", "part"), (numbered, cells)


def with_siblings(level):
    """`level` (group, at, size, node) with run, left and right: the run's other nodes, concatenated."""
    level = level.withColumn("run", F.floor(F.col("at") / RUN)).withColumn("slot", F.col("at") % RUN)
    length = F.least(F.lit(RUN), F.col("size") - F.col("at") + F.col("slot"))
    window = Window.partitionBy("group", "run").orderBy("at")
    left = [F.when(F.col("slot") >= k, F.lag("node", k).over(window)).otherwise("") for k in range(RUN - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < length, F.lead("node", k).over(window)).otherwise("") for k in range(1, RUN)]
    return level.withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def tree(base):
    """Levels above `base` (group, at, size, node): [base, ..., one node a group], all but the first stored."""
    levels, most = [base], base.agg(F.max("size")).first()[0] or 0
    while most > 1:
        first = with_siblings(levels[-1].filter("size > 1")).filter("slot = 0")
        size = F.ceil(F.col("size") / RUN)
        above = first.select("group", F.col("run").alias("at"), size.alias("size"), digest("node", "right").alias("node"))
        levels.append(stored(above, "level"))
        most = -(-most // RUN)
    return levels


def tops(levels):
    """(group, node) of each group's last node."""
    found = [level.filter("size = 1").select("group", "node") for level in levels]
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out


def paths(levels, ends, keep=()):
    """The lowest level's rows with path: the siblings of each level, as an array of (left, right).

    ends: (group, path, ...) continues the path of a group's last node; None ends it there.
    """
    above, used, ends = None, [], ends if ends is None else counted_small(ends)
    for level in reversed(levels):
        lowest = level is levels[0]
        columns = ["group", "at", *(keep if lowest else ())]
        last = level.filter("size = 1").select(*columns)
        if ends is None:
            rows = last.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
        else:
            rows = last.join(ends, F.col("group").eqNullSafe(F.col("end")), "left").drop("end")
        if above is not None:
            inner = with_siblings(level.filter("size > 1"))
            parent = above.select(F.col("group").alias("up"), F.col("at").alias("up_run"), *[c for c in above.columns if c not in ("group", "at")])
            joined = inner.join(parent, F.col("group").eqNullSafe(F.col("up")) & (F.col("run") == F.col("up_run")))
            path = F.concat(F.array(F.struct("left", "right")), "path").alias("path")
            rest = [c for c in rows.columns if c not in (*columns, "path")]
            rows = rows.unionByName(joined.select(*columns, path, *rest))
        if not lowest:
            rows = stored(rows, "paths")
            used.append(rows)
        above = rows
    return above, used


def manifest(docs):
    """doc_id, source, leaf, subroot, root, path, proof_sha256, folded_root, verified for every row of `docs`."""
    base = stored(leaves(docs), "leaves")
    placed, made = positioned(base, ["source"], ["doc_id", "leaf"])
    low = stored(placed.select(F.col("source").alias("group"), "at", "size", "doc_id", F.col("leaf").alias("node"), "now"), "placed")
    discard(base, *made)
    low_levels = tree(low)

    subroots, made = positioned(stored(tops(low_levels), "subroots"), [F.lit(0).alias("all")], ["group"])
    high = stored(subroots.select(F.lit(0).alias("group"), "at", "size", F.col("group").alias("source"), "node"), "sources")
    discard(*made)
    high_levels = tree(high)
    root = tops(high_levels).first()  # one node, or none for an empty table

    over, used = paths(high_levels, None, keep=("source", "node"))
    root = F.lit(root.node if root else None).cast("string").alias("root")
    ends = stored(over.select(F.col("source").alias("end"), "path", F.col("node").alias("subroot"), root), "ends")
    discard(*used, *high_levels)

    done, _ = paths(low_levels, ends, keep=("doc_id", "node", "now"))
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    folded = F.aggregate("path", F.coalesce("now", "node"), lambda node, x: digest(x["left"], node, x["right"]))
    return done.select(
        "doc_id",
        F.col("group").alias("source"),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        "path",
        digest(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql(levels=7):
    """DuckDB SQL for op13; `levels` unrolled levels hold sources of up to 16^levels documents."""
    field = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(field, FIELDS[:-1]), field(text)]) + ")"
    crc = """(4294967295 - list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint),
        lambda c, x: list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(c, x)), 4294967295::bigint))"""
    parts = [
        f"""w0 as materialized (select *, {leaf('text')} as h,
            case when {crc} % 5 = 0 then {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} end as now from documents)""",
        """l0 as materialized (select doc_id, source as g, now, h,
            row_number() over (partition by source order by doc_id nulls first, h) - 1 as p, count(*) over (partition by source) as n from w0)""",
    ]

    def climb(name, carried):
        for k in range(levels):
            parts.append(f"""{name}{k + 1} as materialized (select g, p // 16 as p, (any_value(n) + 15) // 16 as n,
                sha256(string_agg(h, '' order by p)) as h from {name}{k} where n > 1 group by g, p // 16)""")
        parts.append(f"{name}_top as materialized (" + " union all ".join(f"select g, h from {name}{k} where n = 1" for k in range(levels + 1)) + ")")
        for k in range(levels + 1):
            columns = "a.g, a.p, a.n, a.h"
            parts.append(f"""{name}_sib{k} as materialized (select {columns},
                coalesce(string_agg(b.h, '' order by b.p) filter (b.p < a.p), '') as lo,
                coalesce(string_agg(b.h, '' order by b.p) filter (b.p > a.p), '') as hi
                from {name}{k} a join {name}{k} b on a.g is not distinct from b.g and a.p // 16 = b.p // 16 where a.n > 1 group by all)""")

    climb("l", "doc_id")
    parts.append("t0 as materialized (select 0 as g, g as src, h, row_number() over (order by g nulls first) - 1 as p, count(*) over () as n from l_top)")
    climb("t", "src")
    steps, joins, column = [], [], {}
    for name, group, at in (("l", "d.g", "d.p"), ("t", "0", "s.p")):
        for k in range(levels + 1):
            x = f"{name}{k}x"
            joins.append(f"left join {name}_sib{k} {x} on {x}.g is not distinct from {group} and {x}.p = {at} // {16 ** k}")
            steps.append(x)
    proof = " || ".join(f"coalesce({x}.lo || {x}.hi, '')" for x in steps)
    source = "\n".join(j for j in joins if " l_sib" in j) + "\njoin t0 s on s.src is not distinct from d.g\n" + "\n".join(j for j in joins if " t_sib" in j)
    for k, x in enumerate(steps):
        before = "start" if k == 0 else f"f{k - 1}"
        column[f"f{k}"] = f"case when {x}_lo is null then {before} else sha256({x}_lo || {before} || {x}_hi) end"
    sides = ", ".join(f"{x}.lo as {x}_lo, {x}.hi as {x}_hi" for x in steps)
    parts.append(f"""base as materialized (select d.doc_id, d.h as leaf, s.h as subroot, (select h from t_top) as root,
        sha256({proof}) as proof_sha256, coalesce(d.now, d.h) as start, {sides} from l0 d {source})""")
    last = "base"
    for k, (name, expression) in enumerate(column.items()):
        parts.append(f"fold{k} as (select *, {expression} as {name} from {last})")
        last = f"fold{k}"
    end = list(column)[-1]
    return (
        "with " + ",\n".join(parts) + f"\nselect doc_id, leaf, subroot, root, proof_sha256, {end} as folded_root, {end} = root as verified from {last}"
    )


ORACLE_SQL = oracle_sql()
