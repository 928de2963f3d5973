"""The pipeline and the registered queries on the smallest tables."""

import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tradeloom.llm import queries

SF = "/root/testdata/sf0.001"

NAMES = [f"op{n}_" for n in range(1, 14)]


def test_each_operator_has_one_query():
    for n in NAMES:
        assert sum(q.startswith(n) for q in entry.queries()) == 1
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(queries.ORACLE_SQL[name])
    columns = sorted(c[0] for c in cursor.description)
    at = [[c[0] for c in cursor.description].index(c) for c in columns]
    want = sorted(tuple(r[k] for k in at) for r in cursor.fetchall())
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == want


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        after = {r.doc_id for r in docs.collect()}
        assert after and after <= set(before)
    done = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert done and {r.doc_id for r in done} <= after and max(r.copy for r in done) <= 3


def test_no_clean_document_is_lost(spark):
    """Documents of ordinary words without copies pass every filtering stage unchanged."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ba", "lo", "ne", "ti", "ru", "sam", "en"]) for _ in range(rng.randint(1, 3)))
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(k, " ".join(word() for _ in range(60)) + ".", "en", "s", 0) for k in range(40)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert {r.doc_id: r.text for r in docs.collect()} == {r[0]: r[1] for r in rows}


def shared_corpus(spark, rows):
    """The corpus of the operator tests, with columns that carry the operators' own names."""
    clash = [(*r[:2], r[2], r[3], r[4], 777, "own", True, f"gone{k}", 1.5) for k, r in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words int, items string, accepted boolean, gone string, quality_score double"
    return spark.createDataFrame(clash, schema)


def test_stages_keep_every_column_whatever_its_name(spark, rows):
    docs = shared_corpus(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, SF)
        assert done.columns == docs.columns and done.dtypes == docs.dtypes
        assert {(r.n_words, r["items"], r.accepted, r.quality_score) for r in done.collect()} <= {(777, "own", True, 1.5)}
        before = {r.gone: r for r in docs.collect()}
        for r in done.collect():
            known = before[r.gone]
            assert (r.doc_id, r.lang, r.source) == (known.doc_id, known.lang, known.source)
            assert r.text == known.text or stage is corpus_pipeline.lines
        docs = spark.createDataFrame(done.collect(), docs.schema)


def test_near_dedup_stage_equals_brute_force(spark, rows):
    """Nulls, repeats, and an id with two texts of which one is a copy: only copies go."""
    from .test_operators import shingles, union_find

    words = " ".join(f"only{k}" for k in range(30))
    data = [*rows, (0, words, "en", "b", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()), key=repr)
    sets = {(i, t): shingles(t) for i, t, *_ in data if i is not None}
    order = sorted(sets, key=lambda x: (sum(i == x[0] for i, _ in sets) > 1, x[0], x[1] or ""))
    links = [
        (order.index(a), order.index(b))
        for a in sets for b in sets
        if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    root = union_find(range(len(order)), links)
    groups = {}
    for (i, t, *_) in data:
        if i is not None:
            groups.setdefault(root[order.index((i, t))], set()).add((i, t))
    found = {x for x in kept if x[0] is not None}
    # One document of each group, and ids with one text prefer the smallest.
    assert all(len(g & found) == 1 for g in groups.values())
    assert (0, words) in found and (3, rows[2][1]) in found
    assert sum(x[0] is None for x in kept) == sum(r[0] is None for r in data)


def test_pipeline_on_an_empty_table(spark, rows):
    docs = shared_corpus(spark, rows).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
