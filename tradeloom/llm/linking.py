"""Connected components of documents or lines that share buckets, for buckets of any size.

A bucket with n members is not expanded into its n*n pairs. Its members are first compared with
one centre, in a few rounds with another centre each, and verified links are grouped by
distributed union-find after each round. What a cheap test on two members rules out (`near`) is
never made a row. Only in buckets whose members are then still in
different groups are members of different groups compared with each other. So no link between nodes that share a bucket is lost: a pair
left out is in one group already.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradeloom.session import discard, stored


BROADCAST_ROWS = 1_000_000
ONE_TASK_LINKS = 200_000  # so many links are grouped by one task, of 3 MB; more by distributed rounds


def counted_small(ids, items=None):
    """A written table of keys, marked for broadcast if its count is small; else Spark shuffles.

    items: a written table with a row for each element, where rows of `ids` hold lists.
    """
    return F.broadcast(ids) if (ids if items is None else items).count() <= BROADCAST_ROWS else ids


def _forest(batches):
    """Union-find over the links of a task: (node, its smallest known partner) for all but the smallest."""
    parent = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = np.array(sorted(parent), np.int64)
    for first in range(0, len(nodes), 1 << 16):
        part = nodes[first : first + (1 << 16)].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(map(root, part), pa.int64())], ["a", "b"])


def components(edges):
    """Smallest node reachable for each node of `edges` (a, b), as (node, root); roots have no row.

    Tasks first contract the links they hold. Few links are then finished by one task. For more,
    union-find goes on by alternating stars: every node hands its larger, then its smaller neighbours to
    the smallest one it knows, until nothing moves. Each round is a written table; only the
    smallest neighbour of a node is aggregated, so a node may have any number of neighbours.
    """
    clean = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, seen = stored(clean.mapInArrow(_forest, "a long, b long"), "links"), None
    if now.count() <= ONE_TASK_LINKS:
        done = stored(now.coalesce(1).mapInArrow(_forest, "a long, b long"), "links")
        discard(now)
        return done.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        old, now = now, stored(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        discard(old)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def bucket_components(buckets, nodes, verify, rounds=2, across=None, near=None):
    """(node, root) for the nodes that verified links connect.

    buckets: (bucket, node), every pair once.
    nodes:   (node, plus columns that `verify` wants as a and b structs), every node once.
    verify:  takes pairs (a struct, b struct, a.node > b.node), returns those that are links.
    near:    a condition on two member structs, the same for either order, that every link meets. It is
             checked within the joins on buckets; pairs then carry their nodes only.
    across:  for the last step: takes the rows (bucket, member, group) of the buckets that still
             hold different groups, returns links (a, b) between groups; by default all pairs
             of members of different groups are verified.

    Ends as soon as no bucket holds different groups. Tables are removed after their last reader.
    """
    # Nodes that are alike share many buckets: of buckets with the same members one is enough. Members
    # are told by their number and 128 bits of their hashes.
    sums = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    several = buckets.groupBy("bucket").agg(F.count("*").alias("n"), *sums).filter("n > 1")
    several = several.groupBy("n", "x1", "x2").agg(F.min("bucket").alias("bucket")).select("bucket")
    found = stored(buckets.join(several, "bucket", "left_semi"), "shared-buckets")
    # Only nodes that share a bucket carry their columns along.
    member = F.struct("node", *[c for c in nodes.columns if c != "node"])
    shared = stored(found.join(nodes, "node").select("bucket", member.alias("member"), F.col("node").alias("group")), "split-buckets")
    discard(found)
    edges, tested, spent = None, None, []
    for turn in range(rounds + 1):
        if turn == rounds and across:
            links = across(shared)
        else:
            pairs = _with_centre(shared, turn, near) if turn < rounds else _across(shared, near)
            if near:
                pairs = pairs.select(*[F.struct(f"{x}.node").alias(x) for x in "ab"])
            pairs = pairs.distinct()
            if tested is not None:
                pairs = pairs.join(tested, F.struct("a.node", "b.node") == F.col("done"), "left_anti")
            pairs = stored(pairs, "pairs")
            spent.append(pairs)
            done = pairs.select(F.struct("a.node", "b.node").alias("done"))
            tested = done if tested is None else tested.unionByName(done)
            links = verify(pairs).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
        if edges is not None:
            links = links.unionByName(edges)
        roots = components(links)
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        if turn == rounds:
            break
        named = roots.select(F.col("node").alias("known"), "root")
        old, shared = shared, shared.join(named, F.col("member.node") == F.col("known"), "left").select(
            "bucket", "member", F.coalesce("root", "member.node").alias("group")
        )
        open_ones = shared.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"))
        shared = stored(shared.join(open_ones.filter("low < high").select("bucket"), "bucket", "left_semi"), "split-buckets")
        discard(old)
        if shared.isEmpty():
            break
    discard(shared, *spent)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _ordered(one, other):
    swap = F.col(f"{one}.node") < F.col(f"{other}.node")
    return [
        F.when(swap, F.col(other)).otherwise(F.col(one)).alias("a"),
        F.when(swap, F.col(one)).otherwise(F.col(other)).alias("b"),
    ]


def _with_centre(shared, turn, near=None):
    """Every member with its bucket's centre, where they are in different groups.

    The first centre is the smallest node, so that copies meet the same partner in every bucket;
    later ones differ from bucket to bucket.
    """
    order = F.struct(F.lit(0).alias("x") if turn == 0 else F.xxhash64("bucket", "member.node", F.lit(turn)).alias("x"), "member", "group")
    centres = shared.groupBy("bucket").agg(F.min(order).alias("centre"))
    both = shared.join(centres, "bucket").filter(F.col("group") != F.col("centre.group"))
    if near:
        both = both.filter(near("member", "centre.member"))
    return both.select("member", F.col("centre.member").alias("centre")).select(*_ordered("member", "centre"))


def _across(shared, near=None):
    """All members of different groups that share a bucket."""
    sides = [shared.select("bucket", F.col("member").alias(x), F.col("group").alias(f"group_{x}")) for x in "ab"]
    both = sides[0].join(sides[1], "bucket").filter("a.node > b.node and group_a <> group_b")
    return (both.filter(near("a", "b")) if near else both).select("a", "b")
