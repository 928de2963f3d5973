"""MinHash near-duplicate detection with SuperMinHash signatures.

SuperMinHash gives every element one random permutation of the signature's slots and the ranks
r + 0, r + 1, ...; a slot keeps the least rank it meets. Round j hands out rank j of all
elements; a text whose slots are all filled by then is done, as later rounds only bring larger
ranks. Bands of the signature are buckets; pairs found through them are confirmed on the full
shingle sets, and documents are grouped by union-find (`linking`). Texts with equal sets are one
node from the start, so a group of copies of any size costs one aggregated row.

With 32 bands of 4 slots a pair of similarity 0.75 shares no band with probability 5e-6.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradeloom.llm import textbatch as tb
from tradeloom.llm.linking import bucket_components, components, counted_small
from tradeloom.session import discard, stored

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 32, 4
BLOCK = 400_000  # elements of the sets that are compared in one task, twice
SLICE = 512 << 10  # bytes of text whose signatures are computed at once
U64 = np.uint64


def super_minhash(elements, counts, slots=BANDS * ROWS):
    """Signatures (rows, slots) of the distinct 64-bit elements of each row; a row without any stays at the maximum."""
    signature = np.full(len(counts) * slots, np.iinfo(U64).max, U64)
    rows = np.repeat(np.arange(len(counts)), counts)
    drawn = []  # position drawn in each earlier round, of the elements still active
    for j in range(slots):
        if not len(elements):
            break
        x = tb.mix(elements + U64((j + 1) * tb.MULTIPLIER % (1 << 64)))
        drawn.append((j + (((x & U64(0xFFFFFFFF)) * U64(slots - j)) >> U64(32)).astype(np.int64)).astype(np.int16))
        # What stands at the drawn position after the earlier exchanges of this element's shuffle.
        slot = drawn[j]
        for i in range(j - 1, -1, -1):
            slot = np.where(slot == drawn[i], np.int16(i), slot)
        np.minimum.at(signature, rows * slots + slot, (U64(j) << U64(32)) | (x >> U64(32)))
        filled = (signature.reshape(-1, slots) != np.iinfo(U64).max).all(axis=1)
        keep = ~filled[rows]
        elements, rows, drawn = elements[keep], rows[keep], [d[keep] for d in drawn]
    return signature.reshape(-1, slots)


def _sets(part):
    """(slice, hashes of the distinct shingles, number per row) for each slice of (id, text)."""
    for rows, data, offsets in tb.slices(part, limit=SLICE):
        starts, ends, counts = tb.word_spans(data, offsets)
        shingles, counts = tb.shingle_hashes(tb.word_hashes(data, starts, ends), counts, WIDTH)
        yield rows, *tb.distinct_per_row(shingles, counts)


def _signature_rows(part):
    factors = tb.constants(ROWS, 3)
    for rows, elements, counts in _sets(part):
        bands = super_minhash(elements, counts).reshape(len(counts), BANDS, ROWS)
        bands = tb.mix((bands * factors).sum(axis=2, dtype=U64) + tb.constants(BANDS, 4))
        filled = counts > 0
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("id"),
                pa.array(counts, pa.int64()),
                pa.array(tb.signed(tb.sums_per_row(tb.mix(elements ^ U64(5)), counts))),
                pa.array(tb.signed(tb.sums_per_row(tb.mix(elements ^ U64(6)), counts))),
                tb.lists(tb.signed(bands[filled].ravel()), np.where(filled, BANDS, 0), pa.int64()),
            ],
            ["id", "n", "set_a", "set_b", "bands"],
        )


def _set_rows(part):
    for rows, elements, counts in _sets(part):
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), tb.lists(tb.signed(elements), counts, pa.int64())], ["id", "elements"]
        )


def _block_links(percent):
    def links(table):
        """One link for each node and other group, among the nodes of two blocks (or within one)."""
        node, group, block = (table.column(c).to_numpy() for c in ("node", "group", "block"))
        elements = table.column("elements").combine_chunks()
        sizes = np.diff(elements.offsets.to_numpy())
        owner = np.repeat(np.arange(len(node)), sizes)
        _, element = np.unique(elements.flatten().to_numpy(), return_inverse=True)
        by_element = np.argsort(element, kind="stable")
        holders = owner[by_element]
        first = np.concatenate(([0], np.cumsum(np.bincount(element))))
        edges = np.concatenate(([0], np.cumsum(sizes)))
        same_block = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        a, b = [], []
        for x in range(len(node)):
            own = element[edges[x] : edges[x + 1]]
            starts, counts = first[own], first[own + 1] - first[own]
            at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            common = np.bincount(holders[at], minlength=len(node))
            linked = (100 * common >= percent * (sizes[x] + sizes - common)) & (group != group[x]) & (node < node[x])
            if not same_block:
                linked &= block != block[x]
            partners = np.flatnonzero(linked)
            partners = partners[np.unique(group[partners], return_index=True)[1]]
            a.extend([node[x]] * len(partners))
            b.extend(node[partners])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links


def near_duplicates(docs, id="doc_id", text="text", percent=PERCENT):
    """Per row: id, n_shingles, component_id, kept.

    Words are runs of other bytes than white space, in lower case (A-Z only). A text's set is its
    distinct five-word shingles; a text with fewer words, but some, is one shingle; null and empty
    texts have no shingles and no links. Texts are linked when 100 * intersection >= percent *
    union of the sets; component_id is the smallest id reachable, kept marks id = component_id.
    Rows that share an id are one node with a result row each. Rows without id have links with
    nothing: component_id null, kept true. Texts of any length are compared whole; other columns are
    ignored. An empty table gives an empty result.
    """
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n long, set_a long, set_b long, bands array<long>"
    signatures = stored(narrow.mapInArrow(_signature_rows, schema), "signatures")
    same = ["n", "set_a", "set_b"]
    classes = stored(signatures.filter("n > 0").groupBy(*same).agg(F.min("id").alias("node")).filter("node is not null"), "classes")

    # One row per set: whatever rows hold it have the same bands, so their aggregate is that of any.
    nodes = signatures.filter("n > 0 and id is not null").join(
        classes.withColumnRenamed("node", "id"), [*same, "id"], "left_semi"
    )
    # Rows that repeat an id come once; of an id with several texts the largest set's size counts.
    buckets = nodes.dropDuplicates(["id", *same]).select(F.explode("bands").alias("bucket"), F.col("id").alias("node"))
    repeated = classes.groupBy("node").agg(F.max("n").alias("n"), F.min("n").alias("low"))

    def sets_of(wanted):
        wanted = stored(wanted.select(F.col("node").alias("id")).distinct(), "compared")
        return narrow.join(counted_small(wanted), "id", "left_semi").mapInArrow(_set_rows, "id long, elements array<long>")

    def across(shared):
        """Links between groups: nodes that buckets connect are compared in blocks of bounded size."""
        hub = shared.groupBy("bucket").agg(F.min("member.node").alias("b"))
        meet = shared.join(hub, "bucket").select(F.col("member.node").alias("a"), "b").distinct()
        areas = components(meet).unionByName(meet.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy("node")
        areas = areas.agg(F.min("root").alias("area"))
        own = stored(shared.select("member.node", "member.n", "group").distinct().join(areas, "node"), "areas")
        sizes = own.groupBy("area").agg(
            F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"), F.min("group").alias("low"), F.max("group").alias("high")
        )
        placed = own.join(sizes.filter("low < high").select("area", "blocks"), "area").withColumn(
            "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        )
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        placed = placed.withColumn("other", other).select(
            "area", "node", "group", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
        )
        sets = sets_of(own.select("node")).withColumnRenamed("id", "node")
        return placed.join(sets, "node").groupBy("area", "i", "j").applyInArrow(_block_links(percent), "a long, b long")

    def verify(pairs):
        close = pairs.filter(f"100 * least(a.n, b.n) >= {percent} * greatest(a.low, b.low)")
        close = stored(close, "close-pairs")
        sets = stored(sets_of(close.select("a.node").unionAll(close.select("b.node"))), "sets")
        one, two = (sets.select(F.col("id").alias(f"id_{x}"), F.col("elements").alias(f"set_{x}")) for x in "ab")
        both = close.join(one, F.col("a.node") == F.col("id_a")).join(two, F.col("b.node") == F.col("id_b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        links = stored(both.filter(100 * common >= percent * union).select("a", "b"), "links-found")
        discard(close, sets)
        return links

    roots = bucket_components(buckets, repeated, verify, across=across)
    labels = classes.join(roots, "node", "left").select(*same, F.coalesce("root", "node").alias("component"))
    result = signatures.select("id", *same).join(labels, same, "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return result.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == own)).alias("kept"),
    )
