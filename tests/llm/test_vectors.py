"""op11 to op13 against brute force, with nulls, ties, repeated rows, odd lengths and hot vectors."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import centroids, merkle, topk

NAN = float("nan")
SCHEMA = "vec_id long, embedding array<float>, rank int, cluster string"


def vectors(n=150, width=64):
    rng = random.Random(9)
    single = lambda x: float(np.float32(x))
    rows = [(k, [single(rng.uniform(-1, 1)) for _ in range(width)]) for k in range(n)]
    hot = rows[5][1]
    rows += [(1000 + k, hot) for k in range(60)] + [(40, rows[40][1]), (40, rows[41][1]), (None, rows[3][1])]
    rows += [(2000, None), (2020, [None] * width), (2040, [NAN] * width), (2060, [math.inf] + [0.0] * (width - 1)), (2080, [0.0] * width)]
    return rows + [(2100, []), (2120, [0.5, -0.5]), (2140, [0.0] * width)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def best(rows, k, every):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j) for c, (j, w) in enumerate(kept) if c != q]
        out += [(i, rank + 1, j, -s) for rank, (s, _, j) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, bits", [(1024, 8), (16, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, block, bits):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "BITS", bits)
    rows = vectors()
    got = topk.exact_top_k(frame(spark, rows).repartition(3), k=7, every=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == best(rows, 7, 5)


def test_top_k_of_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [3.0]), (7, [-1.0, 0.5])]
    assert sorted(map(tuple, topk.exact_top_k(frame(spark, rows)).collect()), key=repr) == best(rows, 20, 20)
    assert topk.exact_top_k(frame(spark, [])).count() == 0
    assert topk.exact_top_k(frame(spark, [(1, [1.0])])).count() == 0
    assert topk.exact_top_k(frame(spark, [(20, [1.0])])).count() == 0


def lloyd(rows, k, rounds, width):
    kept = [(i, np.array([math.floor(1024 * x) for x in v], object)) for i, v in rows if v is not None and len(v) == width]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "~", list(v)) for i, v in kept)
    centres = [np.array(v, object) for _, v in order[:k]]
    apart = lambda a, b: int(((a - b) ** 2).sum())
    nearest = lambda v: min((apart(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        groups = [[v for (_, v), c in zip(kept, own) if c == n] for n in range(len(centres))]
        centres = [np.array([sum(x) // len(g) for x in zip(*g)], object) if g else c for g, c in zip(groups, centres)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, c in found if c == n) for n in range(len(centres))}
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), name[c]) for i, d, c in found), key=repr)


@pytest.mark.parametrize("block, k", [(2048, 8), (16, 3), (16, 1)])
def test_clusters_equal_lloyd(spark, monkeypatch, block, k):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = [(i, v) for i, v in vectors() if v is None or all(x is not None and math.isfinite(x) for x in v)]
    odd = [(2020, [None] * 64), (2040, [NAN] * 64), (2060, [math.inf] + [0.0] * 63)]
    got = centroids.cluster_vectors(frame(spark, rows + odd).repartition(3), k=k)
    assert sorted(map(tuple, got.collect()), key=repr) == lloyd(rows, k, 10, 64)


def test_clusters_of_few_vectors(spark):
    rows = [(1, [0.5] * 64), (1, [0.5] * 64), (2, [-0.5] * 64)]
    assert sorted(map(tuple, centroids.cluster_vectors(frame(spark, rows)).collect()), key=repr) == lloyd(rows, 8, 10, 64)
    assert centroids.cluster_vectors(frame(spark, [])).count() == 0


def test_only_expired_vectors_are_popped(monkeypatch):
    rng = np.random.default_rng(2)
    centres = np.array([[0] * 4, [1000] * 4])
    numbers = np.concatenate((rng.integers(-50, 50, (100, 4)), rng.integers(950, 1050, (100, 4)), [[499] * 4]))
    new, _, gap = centroids.scan(numbers, centres)
    heaps = [sorted((g, p) for p, (c, g) in enumerate(zip(new, gap)) if c == n) for n in (0, 1)]
    cluster = new.astype(np.int16)
    moved = np.array([[-3] * 4, [1000] * 4])
    drift = [6.0, 6.0]
    rows, old, now = centroids.rescan(numbers, heaps, cluster, moved, drift)
    assert rows.tolist() == [200] and old.tolist() == [0] and now.tolist() == [1]
    assert [len(h) for h in heaps] == [100, 101] and cluster.tolist() == centroids.scan(numbers, moved)[0].tolist()


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if lower and fields[-1] is not None:
        fields[-1] = fields[-1].translate({c: c + 32 for c in range(65, 91)})
    return hashed(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes):
    """Root of a list of nodes, and each node's siblings (left, right) level by level."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            first = p // 16 * 16
            steps[k].append(("".join(nodes[first:p]), "".join(nodes[p + 1 : first + 16])))
        nodes, at = [hashed(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)], [p // 16 for p in at]
    return nodes[0], steps


def manifest_of(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    for found in by.values():
        found.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: climb([leaf_of(r) for r in by[s]]) for s in sources}
    root, high = climb([low[s][0] for s in sources])
    out = []
    for s, above in zip(sources, high):
        for r, below in zip(by[s], low[s][1]):
            struck = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            node = leaf_of(r, struck)
            for left, right in below + above:
                node = hashed(left, node, right)
            proof = hashed(*(left + right for left, right in below + above))
            out.append((r["doc_id"], leaf_of(r), low[s][0], root, proof, node, node == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("sources", [1, 2, 40])
def test_manifest_equals_a_plain_tree(spark, rows, sources):
    named = [(i, t, None if k % 7 == 3 else "en", None if k % 5 == 0 else f"é{k % sources}", len(t or "") if k % 3 else None) for k, (i, t, *_) in enumerate(rows)]
    named += [(5000 + k, f"Text {k}", "de", "hot", k) for k in range(300)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in named], "doc_id long, text string, lang string, source string, n_chars long, leaf int, root string, `at` int")
    want = manifest_of([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in named])
    got = merkle.manifest(table).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == want
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_little(spark, empty):
    assert merkle.manifest(empty).count() == 0
    one = spark.createDataFrame([(None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.root == hashed("-----") and row.verified and row.proof_sha256 == hashed("")


def test_a_hot_source_is_split(spark):
    """Windows run within runs of sixteen and ranges of the sort, never over a source."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    placed, _ = merkle.positioned(merkle.leaves(docs), ["source"], ["doc_id", "leaf"])
    rows = placed.select("doc_id", "at", "size").collect()
    assert all(r.doc_id == r.at and r.size == 5000 for r in rows) and len(rows) == 5000
