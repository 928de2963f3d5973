"""Quality, toxicity and likeness against plain Python versions."""

import collections
import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import fingerprints, linear, quality, toxicity

from .test_operators import LOWER


def logistic(rows, target, size, l2, rounds=300, rate=0.3, copies=None):
    """The gradient steps of `linear.fit`, number by number."""
    copies = copies or [1] * len(rows)
    weights, squares, bias, bias_squares = [0.0] * size, [1e-8] * size, 0.0, 1e-8
    for _ in range(rounds):
        gradient, slope = [l2 * w for w in weights], 0.0
        for row, t, n in zip(rows, target, copies):
            margin = sum(weights[k] * v for k, v in row) + bias
            error = (1 / (1 + math.exp(-margin)) - t) * n / sum(copies)
            slope += error
            for k, v in row:
                gradient[k] += v * error
        for k, g in enumerate(gradient):
            squares[k] += g * g
            weights[k] -= rate * g / math.sqrt(squares[k])
        bias_squares += slope * slope
        bias -= rate * slope / math.sqrt(bias_squares)
    return weights, bias


def test_fit_equals_plain_steps_and_copies_count():
    rng = random.Random(1)
    rows = [[(k, rng.uniform(-1, 1)) for k in sorted(rng.sample(range(6), rng.randint(1, 4)))] for _ in range(12)]
    target, copies = [rng.random() for _ in rows], [rng.randint(1, 4) for _ in rows]
    flat = lambda rows: (np.array([k for r in rows for k, _ in r]), np.array([v for r in rows for _, v in r]), np.array([len(r) for r in rows]))
    got = linear.fit(*flat(rows), np.array(target), 6, copies=copies)
    want = logistic(rows, target, 6, 1e-4, copies=copies)
    assert got[0] == pytest.approx(want[0]) and got[1] == pytest.approx(want[1])
    long = [r for r, n in zip(rows, copies) for _ in range(n)]
    again = linear.fit(*flat(long), np.array([t for t, n in zip(target, copies) for _ in range(n)]), 6)
    assert got[0] == pytest.approx(again[0])


def em(votes, rounds=50):
    """Expectation-maximisation over documents, one by one: P(good) of each."""
    good = [0.0 if quality.BAD in v else 1.0 for v in votes]
    for _ in range(rounds):
        score = []
        for share in (good, [1 - g for g in good]):
            mass = sum(share)
            seen = [[0.5 + sum(s for s, v in zip(share, votes) if v[k] == o) for o in range(3)] for k in range(len(votes[0]))]
            prior = (mass + 1) / (len(votes) + 2)
            score.append([math.log(prior) + sum(math.log(seen[k][o] / sum(seen[k])) for k, o in enumerate(v)) for v in votes])
        good = [1 / (1 + math.exp(max(-40, min(40, b - a)))) for a, b in zip(*score)]
    return good


def corpus(n=120):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8)))
    out = []
    for k in range(n):
        text = " ".join(word() for _ in range(rng.randint(20, 60)))
        out.append([text, text.upper(), "!!! ### " + text[:30] + " $$$ %%%", " ".join([word()] * 30), text + "\n" + text][0 if k % 3 else k // 3 % 5])
    return out + ["", None, "x", out[0], out[0], "long " * 20_000]


def test_estimate_equals_em_over_documents():
    batch = pa.RecordBatch.from_arrays([pa.array(corpus(), pa.string())], ["text"])
    votes = []
    for _, data, offsets in quality.tb.slices(iter([batch])):
        votes += quality.votes(quality.signals(data, offsets)[0]).tolist()
    powers = 3 ** np.arange(len(quality.LABELLERS))
    codes = np.array(votes) @ powers
    posterior = quality.estimate(np.bincount(codes, minlength=quality.N_PATTERNS))
    assert posterior[codes] == pytest.approx(em(votes), abs=1e-9)


def test_quality_scores_equal_a_plain_scorer(spark):
    """Labels by EM, a logistic scorer over words and signals, margins summed word by word."""
    texts = corpus(40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("accepted", F.lit("clash")).withColumn("key", F.lit(1))
    got = {r.doc_id: (r.quality_score, r.accepted) for r in quality.score_quality(docs).collect()}
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    rows, votes = [], []
    for part, data, offsets in quality.tb.slices(iter([batch])):
        found, words, counts = quality.signals(data, offsets)
        bins, hashed, share = quality.features(found, words, counts)
        votes += quality.votes(found).tolist()
        ends = np.cumsum(counts)
        for k in range(part.num_rows):
            own = collections.Counter(hashed[ends[k] - counts[k] : ends[k]].tolist())
            rows.append([(b, 1.0) for b in bins[k].tolist()] + [(w, n * share[k]) for w, n in own.items()])
    used = sorted({k for r in rows for k, _ in r})
    small = [[(used.index(k), v) for k, v in r] for r in rows]
    seen = collections.Counter(texts)
    once = [texts.index(t) for t in seen]
    target = em(votes)
    weights, bias = logistic([small[k] for k in once], [target[k] for k in once], len(used), 1e-4, copies=[seen[texts[k]] for k in once])
    for k, row in enumerate(small):
        score = 1 / (1 + math.exp(-(sum(weights[i] * v for i, v in row) + bias)))
        assert got[k][0] == pytest.approx(score, abs=1e-4)
        assert got[k][1] == (got[k][0] >= 0.5 and bool((texts[k] or "").strip()))


def grams(word):
    """Character n-grams of a word with its ends told apart, as text."""
    out = []
    for n in toxicity.LENGTHS:
        out += [("^" if k == 0 else "") + word[k : k + n] + ("$" if k + n == len(word) else "") + f"/{n}" for k in range(len(word) - n + 1)]
    return out


def words(text):
    out, word = set(), ""
    for c in (text or "").translate(LOWER) + " ":
        if c.isalpha() or ord(c) > 127:
            word += c
        elif word:
            out.add(word)
            word = ""
    return out


def test_toxicity_scores_equal_a_plain_classifier(spark):
    rng = random.Random(2)
    nice, rude = ["lovely", "garden", "morning", "reading", "flowers"], ["grumpf", "blarghs", "snorkfool"]
    common = ["the", "house", "walking", "über", "table", "summer"]
    data = [(k, " ".join(rng.sample(common, 3) + rng.sample(rude if k % 3 == 0 else nice, 2)), int(k % 3 == 0)) for k in range(160)]
    data += [(500 + k, data[0][1], 1) for k in range(30)] + [(600, None, 0), (601, "", 1), (602, "lovely grumpf", None)]
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(d[0], d[2]) for d in data], "doc_id long, toxic int")
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in toxicity.score_toxicity(docs, labels).collect()}
    import zlib

    held = {d[0]: zlib.crc32(str(d[0]).encode()) % 4 == 2 for d in data}
    train = [d for d in data if not held[d[0]] and d[2] is not None]
    counts = [collections.Counter(g for _, t, label in train if label == x for w in words(t) for g in grams(w)) for x in (0, 1)]
    sums = [sum(c.values()) for c in counts]
    ratio = {}
    for g in set(counts[0]) | set(counts[1]):
        if max(counts[0][g], counts[1][g]) >= 2:
            a, b = ((counts[x][g] + toxicity.SMOOTHING * sums[x] / sum(sums) * 2) / sums[x] for x in (0, 1))
            if abs(math.log(b / a)) >= toxicity.LEAST_RATIO:
                ratio[g] = math.log(b / a)
    found = lambda t: collections.Counter(g for w in words(t) for g in grams(w) if g in ratio)
    names = sorted(ratio)
    kinds = collections.Counter((t, label) for _, t, label in train)
    rows = [[(names.index(g), n * ratio[g]) for g, n in found(t).items()] for t, _ in kinds]
    weights, bias = logistic(rows, [label for _, label in kinds], len(names), 1e-4, copies=list(kinds.values()))
    for i, t, _ in data:
        margin = sum(weights[names.index(g)] * ratio[g] * n for g, n in found(t).items()) + bias
        score = 1 / (1 + math.exp(-margin))
        assert got[i][0] == held[i] and got[i][1] == pytest.approx(score, abs=2e-3), (i, t)
        assert got[i][2] == int(got[i][1] >= 0.3)


def test_few_labels(spark):
    docs = spark.createDataFrame([(k, f"some words here {k}") for k in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(8)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert {r.score for r in toxicity.score_toxicity(docs, some).collect()} == {0.5}


def test_bounded_labels(spark):
    labels = spark.range(4000).selectExpr("id", "1 as toxic")
    some, n = toxicity.bounded_labels(labels, 1000)
    assert 800 < n < 1200 and some.count() == n
    assert toxicity.bounded_labels(labels, 4000)[1] == 4000


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_likeness_and_common_ends_in_the_query(spark):
    """near_* lie between what both ends have in common, rounded, and the longest common subsequence."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = [text(n) for n in (400, 700, 0, 3, 350)]
    data = []
    for k, t in enumerate(base):
        data += [(10 * k, t), (10 * k + 1, t), (10 * k + 2, t[: len(t) // 3] + "Z" + t[len(t) // 3 :]), (10 * k + 3, "Y" + t[1:] + "X")]
    data += [(900, None), (901, "é日本" * 40), (902, "é日本" * 41)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("block", F.lit(1))
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs, blocks=3).collect()}
    order = sorted(data)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        start = lambda x: len(os.path.commonprefix([t, x]))
        end = lambda x: len(os.path.commonprefix([t[::-1], x[::-1]]))
        r = got[i]
        assert (r.start_edited, r.start_next, r.end_next) == (start(edited), start(following), end(following))
        for near, other, key in ((r.near_edited, edited, "edited"), (r.near_next, following, "next")):
            most = max(len(t), len(other), 1)
            if t == other:
                assert near == 1.0
                continue
            both = min(start(other) + end(other), min(len(t), len(other)))
            step = max(fingerprints.step_of(len(t)), fingerprints.step_of(len(other)))
            assert (both - 2 * step) / most <= near <= lcs(t, other) / most + 1e-9, (i, key)
