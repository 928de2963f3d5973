"""Centroid clustering: Lloyd's rounds in integers, vectors rescanned only when their bound expires.

After a scan a vector knows its distance to its own centroid (upper) and to the next one (lower).
While centroids move, upper grows by at most its centroid's movement and lower shrinks by at most
the largest movement of another one, so each cluster accumulates one drift for all its vectors. A
cluster's heap is ordered by gap (lower - upper) plus the drift at the time of insertion; vectors
whose key is within the drift of now are popped, scanned exactly against all centroids, and pushed
to the heap of their cluster. All others keep their cluster: for them lower > upper still holds.

Vectors are written once, as blocks, bucketed by block; a block's heaps (one per cluster, as arrays
in heap order) are a row of a table bucketed alike, so a round joins the two without a shuffle,
and a block without an expired head passes through as it is. Only sums of moved vectors, one row
per component, reach the driver: they move the centroids, as exact integers.

Defined results: vectors with another number of components, null, or with a null or non-finite
component are left out. Components are floor(scale * x), held to -2^26..2^26 (so squared distances
fit a long). Null ids are clustered, and start no centroid unless ids run out. Fewer vectors than
k give fewer centroids; repeated rows are vectors of their own; an empty table gives no rows.
Columns other than the two named are ignored.
"""

import uuid
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradeloom.llm import vectors as vec
from tradeloom.session import discard, scratch_path, stored

K, ROUNDS, SCALE, DIMS, SEED = 8, 10, 1024, 64, "3"
LIMIT = 1 << 26
BLOCK = 2048  # vectors of a block
SLACK = 1e-3  # rounding of square roots and sums of drifts, which are below 2^40

BLOCKS = "ids array<long>, n int, size int, data binary"
STATE = "block long, n int, cluster binary, keys binary, places binary, ends array<int>, moved array<long>"


def _blocks(dims):
    def run(batches):
        for batch in batches:
            rows, flat, at = vec.usable(batch.column("vector"), dims)
            for first in range(0, len(rows), BLOCK):
                part = rows[first : first + BLOCK]
                data, _, size = vec.pack(vec.matrix(flat, at, part, SCALE, LIMIT))
                ids = pa.array([batch.column("id").take(pa.array(part)).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(part)], pa.int32()), pa.array([size], pa.int32()), pa.array([data], pa.binary())],
                    ["ids", "n", "size", "data"],
                )

    return run


def distances(numbers, centroids):
    """Exact squared distances (vectors, centroids)."""
    most = max(np.abs(numbers).max(initial=0), np.abs(centroids).max(initial=0))
    kind = np.float64 if 4 * int(most) ** 2 * centroids.shape[1] < 1 << 53 else np.int64
    x, c = numbers.astype(kind), centroids.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def scan(numbers, centroids):
    """Nearest centroid (ties: the smaller number), its squared distance and the gap to the next one."""
    found = distances(numbers, centroids)
    nearest = found.argmin(axis=1)
    least = found[np.arange(len(found)), nearest]
    if centroids.shape[0] == 1:
        return nearest, least, np.full(len(found), np.inf)
    second = np.partition(found, 1, axis=1)[:, 1]
    return nearest, least, np.sqrt(second) - np.sqrt(least)


def rescan(numbers, heaps, cluster, centroids, drift):
    """Pop what has expired, scan it, push it again; returns (rows, old clusters, new clusters) of what was popped."""
    popped = []
    for c, heap in enumerate(heaps):
        while heap and heap[0][0] <= drift[c] + SLACK:
            popped.append(heappop(heap)[1])
    rows = np.array(popped, np.int64)
    old = cluster[rows].astype(np.int64)
    new, _, gap = scan(numbers[rows], centroids)
    for row, c, key in zip(popped, new.tolist(), (gap + np.array(drift)[new]).tolist()):
        heappush(heaps[c], (key, row))
    cluster[rows] = new
    return rows, old, new


def _moves(numbers, rows, old, new, k):
    """Change of each cluster's count and sums, flat; old clusters below 0 are none."""
    out = np.zeros((k, numbers.shape[1] + 1), np.int64)
    own = np.column_stack((np.ones(len(rows), np.int64), numbers[rows].astype(np.int64)))
    for c in range(k):
        out[c] = own[(new == c) & (old != c)].sum(axis=0) - own[(old == c) & (new != c)].sum(axis=0)
    return out.ravel()


def _state(block, n, cluster, heaps, moved):
    keys = np.array([x[0] for heap in heaps for x in heap])
    places = np.array([x[1] for heap in heaps for x in heap], np.int32)
    ends = np.cumsum([len(heap) for heap in heaps]).astype(np.int32)
    columns = [[block], [n], [cluster.astype(np.int16).tobytes()], [keys.tobytes()], [places.tobytes()], [ends], [moved]]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    names = ["block", "n", "cluster", "keys", "places", "ends", "moved"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _first_scan(centroids):
    def run(batches):
        drift = [0.0] * len(centroids)
        for row in (row for batch in batches for row in batch.to_pylist()):
            numbers = vec.unpack(row["data"], row["n"], row["size"])
            new, _, gap = scan(numbers, centroids)
            heaps = [[] for _ in drift]
            for place, (c, key) in enumerate(zip(new.tolist(), gap.tolist())):
                heaps[c].append((key, place))
            for heap in heaps:
                heapify(heap)
            moved = _moves(numbers, np.arange(len(new)), np.full(len(new), -1), new, len(heaps))
            yield _state(row["block"], row["n"], new, heaps, moved)

    return run


def _next_scan(centroids, drift):
    def run(batches):
        for row in (row for batch in batches for row in batch.to_pylist()):
            cluster = np.frombuffer(row["cluster"], np.int16).copy()
            keys = np.frombuffer(row["keys"])
            starts = [0, *row["ends"]]
            heads = [keys[a] if a < b else np.inf for a, b in zip(starts, starts[1:])]
            heaps = []
            if any(head <= d + SLACK for head, d in zip(heads, drift)):
                pairs = list(zip(keys.tolist(), np.frombuffer(row["places"], np.int32).tolist()))
                heaps = [pairs[a:b] for a, b in zip(starts, starts[1:])]
            if heaps:
                numbers = vec.unpack(row["data"], row["n"], row["size"])
                rows, old, new = rescan(numbers, heaps, cluster, centroids, drift)
                yield _state(row["block"], row["n"], cluster, heaps, _moves(numbers, rows, old, new, len(drift)))
            else:
                kept = {c: [row[c]] for c in ("block", "n", "cluster", "keys", "places", "ends")} | {"moved": [[]]}
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(kept.values(), kinds)], list(kept))

    return run


def _distances(centroids):
    def run(batches):
        for row in (row for batch in batches for row in batch.to_pylist()):
            cluster = np.frombuffer(row["cluster"], np.int16).astype(np.int64)
            apart = vec.unpack(row["data"], row["n"], row["size"]).astype(np.int64) - centroids[cluster]
            columns = [pa.array(row["ids"], pa.int64()), pa.array(cluster, pa.int32()), pa.array((apart * apart).sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return run


class Bucketed:
    """A table in the shared folder with one file per bucket of blocks."""

    def __init__(self, df, name):
        spark = df.sparkSession
        self.name = f"{name}_{uuid.uuid4().hex}"
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        path = scratch_path(spark, name)
        df.write.bucketBy(buckets, "block").option("path", path).format("parquet").saveAsTable(self.name)
        self.rows = spark.table(self.name)
        self.rows.stored_at = path

    def drop(self):
        self.rows.sparkSession.sql(f"drop table {self.name}")
        discard(self.rows)


def starting(vectors, k, seed):
    """The k vectors whose sha256 of `seed:id` is smallest, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    numbers = F.transform("vector", lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))))
    rows = vectors.select(order.alias("h"), numbers.alias("numbers")).orderBy(F.asc_nulls_last("h"), "numbers").limit(k).collect()
    return np.array([list(r.numbers) for r in rows], np.int64)


def moved_centroids(centroids, counts, sums):
    return np.array([[s // n for s in row] if n else old for old, n, row in zip(centroids.tolist(), counts, sums)], np.int64)


def cluster_vectors(table, id="vec_id", vector="embedding", k=K, rounds=ROUNDS, dims=DIMS, seed=SEED):
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = table.sparkSession
    named = table.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    centroids = starting(named.filter((F.size("vector") == dims) & ~broken), k, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    packed = named.mapInArrow(_blocks(dims), BLOCKS).withColumn("block", F.monotonically_increasing_id())
    # One file per bucket; a shuffle of the packed vectors, the only one.
    packed = packed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
    blocks = Bucketed(packed, "vectors")
    state = Bucketed(blocks.rows.mapInArrow(_first_scan(centroids), STATE), "heaps")
    drift = [0.0] * len(centroids)
    totals = [[0] * (dims + 1) for _ in drift]
    both = lambda: blocks.rows.select("block", "size", "data", "ids").join(state.rows, "block")
    for _ in range(rounds):
        changes = state.rows.select(F.posexplode("moved").alias("place", "change"))
        for r in changes.groupBy("place").agg(F.sum(F.col("change").cast("decimal(38,0)")).alias("change")).collect():
            totals[r.place // (dims + 1)][r.place % (dims + 1)] += int(r.change)
        before, centroids = centroids, moved_centroids(centroids, [t[0] for t in totals], [t[1:] for t in totals])
        steps = np.sqrt(((centroids - before).astype(np.float64) ** 2).sum(axis=1))
        if not steps.any():
            break  # no vector can change its cluster any more
        drift = [d + s + max([0.0, *steps[:c], *steps[c + 1 :]]) for c, (d, s) in enumerate(zip(drift, steps.tolist()))]
        old, state = state, Bucketed(both().mapInArrow(_next_scan(centroids, drift), STATE), "heaps")
        old.drop()
    found = stored(both().mapInArrow(_distances(centroids), "vec_id long, cluster int, distance long"), "clustered")
    blocks.drop()
    state.drop()
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    most, every = (1 << 63) - 1, sum(int(r.s) for r in inertia)
    rows = [(r.cluster, min(int(r.s), most), min(every, most), ",".join(map(str, centroids[r.cluster].tolist()))) for r in inertia]
    ends = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid string")  # at most k rows
    ends = ends.withColumn("centroid_sha256", F.sha2(F.col("centroid").cast("binary"), 256)).drop("centroid")
    return found.join(F.broadcast(ends), "cluster").select(*[c.split()[0] for c in schema.split(", ")])


def oracle_sql(k=K, rounds=ROUNDS):
    parts = [
        f"""v as materialized (select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as e
            from embeddings where len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        "x as materialized (select r, unnest(range(len(e))) as d, unnest(e) as x from v)",
        f"""c0 as materialized (select row_number() over (order by sha256('{SEED}:' || vec_id::varchar), e) - 1 as c, e from v
            order by sha256('{SEED}:' || vec_id::varchar), e limit {k})""",
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} as materialized (select r, min({{'d': d, 'c': c}}) as m from (select v.r, c.c,
            list_sum(list_transform(range(1, {DIMS + 1}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))::bigint as d from v, c{n} c) group by r)""")
        if n < rounds:
            parts.append(f"""s{n} as (select m.c as c, d, sum(x)::bigint as s, count(*) as n from a{n} join x using (r) group by m.c, d),
                c{n + 1} as materialized (select o.c, coalesce(any_value(n.e), any_value(o.e)) as e from c{n} o left join
                (select c, list((s - (((s % n) + n) % n)) // n order by d) as e from s{n} group by c) n on n.c = o.c group by o.c)""")
    return "with " + ",\n".join(parts) + f"""
        select vec_id, m.c::int as cluster, m.d::bigint as distance, sum(m.d) over (partition by m.c)::bigint as cluster_inertia,
            sum(m.d) over ()::bigint as inertia, sha256(array_to_string(list_transform(c.e, lambda z: z::varchar), ',')) as centroid_sha256
        from a{rounds} join v using (r) join c{rounds} c on c.c = m.c"""


ORACLE_SQL = oracle_sql()
