"""Exact top-k search by inner product: histogram selection of each query's kth score.

Every query is scored against every other row, in blocks. A round counts, for each query, the
scores by their next few bits (those that share the bits found so far); the counts of all tasks are
summed up, and the bin in which the kth largest score lies gives the query's next bits. After the
last round the kth score is known exactly; a last pass keeps the scores above it, and of those equal
to it as many as are still wanted, with the smallest ids. Scores are made anew in each pass: nothing
that grows with queries times rows is kept. A task hands on the top of its histograms only, down to
the bin with its own kth score, since the kth of all rows cannot be below.

Blocks of candidates and of queries meet on a grid: query block g goes to every salt s, a block of
candidates to one salt and every g, so each (g, s) is a task's work of bounded size, whatever vector
is common. Rows tied at the kth score are cut to the wanted number in the task, by smallest id.

Defined results: vectors that are null or hold a null or non-finite component take no part.
Components are floor(scale * x), held to -2^23..2^23. A shorter vector counts as filled with 0. Null
ids are candidates, after all others in ties, never queries; a repeated row is a row of its own, so
its copies find it. Fewer rows than k give fewer results, an empty table none. Columns other than the
two named are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.llm import vectors as vec
from tradeloom.session import discard, stored

K, EVERY, SCALE = 20, 20, 64
LIMIT = 1 << 23
BLOCK, QUERIES = 1024, 4096  # rows of a block of candidates, of queries
SALT_BLOCKS = 16  # blocks of candidates that a task scores against its queries
BITS = 8  # bits of a score found in a round, at most
NO_ID = np.iinfo(np.int64).max

VECTORS = "ids array<long>, n int, size int, data binary, most double"
QUERY = "id long, block long, place int, width int, data binary"
GROUPS = "ids array<long>, blocks array<long>, places array<int>, n int, size int, data binary"


def _candidate_blocks(batches):
    for batch in batches:
        rows, flat, at = vec.usable(batch.column("vector"))
        for first in range(0, len(rows), BLOCK):
            part = rows[first : first + BLOCK]
            numbers = vec.matrix(flat, at, part, SCALE, LIMIT)
            data, _, size = vec.pack(numbers)
            most = float((numbers.astype(float) ** 2).sum(axis=1).max(initial=0))
            columns = [[batch.column("id").take(pa.array(part)).to_pylist()], [len(part)], [size], [data], [most]]
            kinds = [pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [f.split()[0] for f in VECTORS.split(", ")])


def _query_rows(every):
    def run(batches):
        for row in (row for batch in batches for row in batch.to_pylist()):
            chosen = [k for k, i in enumerate(row["ids"]) if i is not None and i % every == 0]
            numbers = vec.unpack(row["data"], row["n"], row["size"])[chosen].astype("<i4")
            columns = [[row["ids"][k] for k in chosen], [row["block"]] * len(chosen), chosen, [numbers.shape[1]] * len(chosen)]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)] + [pa.array([x.tobytes() for x in numbers], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in QUERY.split(", ")])

    return run


def _query_blocks(batches):
    """Rows of a partition, packed; a block never holds more than QUERIES."""
    held = []

    def packed():
        numbers = np.zeros((len(held), max(r["width"] for r in held)), np.int64)
        for k, r in enumerate(held):
            numbers[k, : r["width"]] = np.frombuffer(r["data"], "<i4")
        data, _, size = vec.pack(numbers)
        columns = [[[r[c] for r in held]] for c in ("id", "block", "place")] + [[len(held)], [size], [data]]
        kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [f.split()[0] for f in GROUPS.split(", ")])

    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            if len(held) == QUERIES:
                yield packed()
                held = []
    if held:
        yield packed()


def _scored(queries, candidates, bound, half):
    """For each block of candidates: its ids and the scores plus `half` (queries, rows); 0, no score, at own rows."""
    q = queries.to_pylist()[0]
    numbers = vec.unpack(q["data"], q["n"], q["size"])
    blocks, places = np.array(q["blocks"]), np.array(q["places"])
    kind = np.int32 if half < 1 << 29 else np.int64
    for row in candidates.select(["block", "ids", "n", "size", "data"]).to_pylist():
        scores = vec.products(numbers, vec.unpack(row["data"], row["n"], row["size"]), bound).astype(kind)
        scores += kind(half)
        own = np.flatnonzero(blocks == row["block"])
        scores[own, places[own]] = 0
        yield row["ids"], scores


def _known(q, column, n, missing):
    values = q.column(column)[0].as_py()
    return np.full(n, missing, np.int64) if values is None else np.array(values, np.int64)


def _histograms(bound, half, shift, last_shift):
    bins, first = 1 << (last_shift - shift), half >> last_shift == 0

    def run(queries, candidates):
        n = queries.column("n")[0].as_py()
        found, wanted = _known(queries, "found", n, 0), _known(queries, "wanted", n, 0)
        counts = np.zeros(n * bins, np.int64)
        for _, scores in _scored(queries, candidates, bound, half):
            if first:
                own = np.flatnonzero((scores == 0).any(axis=1))
                low = (scores >> shift) + (np.arange(n) * bins).astype(scores.dtype)[:, None]
                counts += np.bincount(low.ravel(), minlength=n * bins)
                counts[own * bins] -= 1
                continue
            rows, columns = np.nonzero(((scores >> last_shift) == found[:, None].astype(scores.dtype)) & (scores > 0))
            low = (scores[rows, columns] >> shift) & (bins - 1)
            counts += np.bincount(rows * bins + low, minlength=n * bins)
        counts = counts.reshape(n, bins)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        rows, low = np.nonzero((counts > 0) & (above < wanted[:, None]))
        group = queries.column("g")[0].as_py()
        return pa.table(
            {"g": pa.array([group] * len(rows), pa.int64()), "place": pa.array(rows, pa.int32()), "bin": pa.array(low, pa.int32()), "n": counts[rows, low]}
        )

    return run


def _smallest(rows, ids, wanted):
    """Mask of the entries that are among the `wanted` smallest ids of their row."""
    order = np.lexsort((ids, rows))
    starts = np.searchsorted(rows[order], rows[order])
    keep = np.zeros(len(rows), bool)
    keep[order] = np.arange(len(rows)) - starts < wanted[rows[order]]
    return keep


def _winners(bound, half):
    def run(queries, candidates):
        n = queries.column("n")[0].as_py()
        kth, wanted = _known(queries, "found", n, 0), _known(queries, "wanted", n, 0)
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for ids, scores in _scored(queries, candidates, bound, half):
            ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
            rows, columns = np.nonzero((scores >= kth[:, None].astype(scores.dtype)) & (scores > 0))
            values = scores[rows, columns].astype(np.int64)
            tied = values == kth[rows]
            keep = ~tied
            keep[tied] = _smallest(rows[tied], ids[columns[tied]], wanted)
            parts.append((rows[keep], ids[columns[keep]], values[keep]))
        rows, ids, values = map(np.concatenate, zip(*parts))
        group, names = queries.column("g")[0].as_py(), queries.column("ids")[0].as_py()
        return pa.table(
            {
                "g": pa.array([group] * len(rows), pa.int64()),
                "place": pa.array(rows, pa.int32()),
                "query_id": pa.array([names[r] for r in rows], pa.int64()),
                "vec_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                "score": pa.array(values - half, pa.int64()),
            }
        )

    return run


def exact_top_k(table, id="vec_id", vector="embedding", k=K, every=EVERY):
    """query_id, rank, vec_id, score: the k highest inner products of each row whose id `every` divides."""
    spark = table.sparkSession
    named = table.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    packed = named.mapInArrow(_candidate_blocks, VECTORS).withColumn("block", F.monotonically_increasing_id())
    blocks = stored(packed, "candidates")
    rows = stored(blocks.mapInArrow(_query_rows(every), QUERY), "query-rows")
    n_blocks, n_queries = blocks.count(), rows.count()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n_queries:
        return spark.createDataFrame([], schema)
    bound = int(blocks.agg(F.max("most")).first()[0] * (1 + 1e-9)) + 1  # Cauchy-Schwarz
    if bound >= 1 << 61:
        raise ValueError("vectors are too long for scores of 64 bits")
    bits = bound.bit_length() + 1
    half = 1 << (bits - 1)

    groups = rows.repartition(-(-n_queries // QUERIES)).mapInArrow(_query_blocks, GROUPS)
    groups = stored(groups.withColumn("g", F.monotonically_increasing_id()), "queries")
    discard(rows)
    salts = max(-(-n_blocks // SALT_BLOCKS), min(n_blocks, 2 * spark.sparkContext.defaultParallelism))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    # Candidates come once for each group of queries: each group's number is a row to join on.
    wide = blocks.select("block", "ids", "n", "size", "data", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("own_s"))
    spread = groups.select(F.col("g").alias("for_g"), every_salt.alias("for_s"))

    def passed(function, state, out):
        known = groups.join(state, "g", "left").select("g", "ids", "blocks", "places", "n", "size", "data", "found", "wanted", every_salt.alias("s"))
        met = wide.join(spread, F.col("own_s") == F.col("for_s"))
        return known.groupBy("g", "s").cogroup(met.groupBy("for_g", "for_s")).applyInArrow(function, out)

    state = groups.select("g", F.array_repeat(F.lit(0).cast("long"), F.col("n")).alias("found"))
    state = state.withColumn("wanted", F.transform("found", lambda _: F.lit(k).cast("long")))
    rounds, last, made = -(-bits // BITS), bits, []
    for left in range(rounds - 1, -1, -1):
        shift = -(-bits * left // rounds)
        counts = passed(_histograms(bound, half, shift, last), state, "g long, place int, bin int, n long")
        by = Window.partitionBy("g", "place").orderBy(F.desc("bin"))
        summed = counts.groupBy("g", "place", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(by))
        old = state.select("g", F.posexplode(F.arrays_zip("found", "wanted")).alias("place", "was"))
        # The bin of the kth score; a query with fewer rows than k keeps 0 and takes all.
        hit = summed.join(old, ["g", "place"]).filter("upto >= was.wanted and upto - n < was.wanted and was.wanted > 0")
        hit = hit.select("g", "place", F.expr(f"shiftleft(was.found, {last - shift}) + bin").alias("f"), F.expr("was.wanted - (upto - n)").alias("w"))
        new = old.join(hit, ["g", "place"], "left").groupBy("g").agg(
            F.array_sort(F.collect_list(F.struct("place", F.coalesce("f", F.lit(0)).cast("long").alias("f"), F.coalesce("w", F.lit(0)).cast("long").alias("w")))).alias("all")
        )  # at most QUERIES elements
        state, last = stored(new.select("g", F.col("all.f").alias("found"), F.col("all.w").alias("wanted")), "selected"), shift
        made.append(state)
    winners = passed(_winners(bound, half), state, "g long, place int, query_id long, vec_id long, score long")
    best = Window.partitionBy("g", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return winners.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
with v as materialized (select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as e
    from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, q.r as q, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
    from v q join v c on q.r <> c.r where q.vec_id % {EVERY} = 0),
ranked as (select *, row_number() over (partition by q order by score desc, vec_id nulls last)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= {K}"""
