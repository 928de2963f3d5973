"""Quality classifier from weak labels.

Overlapping heuristic labellers each vote bad, good or abstain on every document. Expectation-
maximisation (a Dawid-Skene model with one accuracy per labeller and vote) estimates from the
counts of all vote patterns how far each labeller can be trusted, without any gold label. The
posterior of a document's pattern is its label for training a hashed linear scorer, which then
scores every document by its words and its measured shares.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm import textbatch as tb
from tradeloom.llm.linear import fit, sigmoid

U64 = np.uint64
SIGNALS = ["n_words", "upper_share", "symbol_share", "distinct_share", "repeat_share", "line_repeat_share", "word_length", "symbol_word_share"]
LETTERS_UPPER = tb.byte_set((0x41, 0x5A))
LETTERS = tb.byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
SYMBOLS = tb.byte_set((0x21, 0x21), (0x23, 0x26), (0x2A, 0x2B), (0x2F, 0x2F), (0x3C, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def _counted(flags, offsets):
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _share(part, whole):
    return part / np.maximum(whole, 1)


def signals(data, offsets):
    """Measured shares of each text, as a (rows, len(SIGNALS)) array; also the words' hashes and counts."""
    starts, ends, counts = tb.word_spans(data, offsets)
    words = tb.word_hashes(data, starts, ends)
    _, distinct = tb.distinct_per_row(words, counts)
    row = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, starts) + row
    at = np.flatnonzero(np.concatenate((np.ones(min(len(line), 1), bool), line[1:] != line[:-1])))
    lines = tb.span_hashes(words, at, np.append(at[1:], len(words)))
    n_lines = np.bincount(row[at], minlength=len(counts))
    _, distinct_lines = tb.distinct_per_row(lines, n_lines)
    size = np.diff(offsets)
    symbols = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
    with_symbol = (symbols[ends] > symbols[starts]).astype(np.int64)
    found = np.stack(
        [
            counts,
            _share(_counted(LETTERS_UPPER[data], offsets), _counted(LETTERS[data], offsets)),
            _share(_counted(SYMBOLS[data], offsets), size),
            _share(distinct, counts),
            _share(tb.sums_per_row(again.astype(np.int64), counts), counts),
            _share(n_lines - distinct_lines, n_lines),
            _share(tb.sums_per_row(ends - starts, counts), counts),
            _share(tb.sums_per_row(with_symbol, counts), counts),
        ],
        axis=1,
    )
    return found, words, counts


# Per labeller: signal, votes bad below and above, votes good within. Fixed values.
LABELLERS = [
    ("upper_share", None, 0.25, 0.0, 0.06),
    ("symbol_share", None, 0.04, 0.0, 0.01),
    ("distinct_share", 0.25, None, 0.45, 1.0),
    ("repeat_share", None, 0.10, 0.0, 0.05),
    ("line_repeat_share", None, 0.40, 0.0, 0.10),
    ("word_length", 3.0, 7.5, 3.8, 6.6),
    ("symbol_word_share", None, 0.20, 0.0, 0.10),
]
BAD, GOOD, ABSTAIN = 0, 1, 2
N_PATTERNS = 3 ** len(LABELLERS)
BUCKETS = 1 << 16  # hashed words
BINS = 16  # per signal
TRAIN_ROWS = 4000
THRESHOLD = 0.5


def votes(found):
    """(rows, labellers) of BAD, GOOD, ABSTAIN; texts without words get BAD from everyone."""
    out = np.full((len(found), len(LABELLERS)), ABSTAIN, np.int64)
    for k, (name, low, high, least, most) in enumerate(LABELLERS):
        x = found[:, SIGNALS.index(name)]
        out[(x >= least) & (x <= most), k] = GOOD
        if low is not None:
            out[x < low, k] = BAD
        if high is not None:
            out[x > high, k] = BAD
    out[found[:, 0] == 0] = BAD
    return out


def pattern_votes():
    codes = np.arange(N_PATTERNS)
    return np.stack([codes // 3**k % 3 for k in range(len(LABELLERS))], axis=1)


def estimate(counts, rounds=50):
    """Posterior of "good" for every vote pattern, from the numbers of documents that show it.

    Starts from "bad if any labeller says so" and alternates: outcome shares of each labeller
    within both classes (smoothed), then the posterior of each pattern.
    """
    table = pattern_votes()
    good = 1.0 - (table == BAD).any(axis=1)
    total = max(counts.sum(), 1)
    for _ in range(rounds):
        logs = []
        for share in (good, 1 - good):
            mass = counts * share
            logs.append(np.log((mass.sum() + 1) / (total + 2)))
            for k in range(len(LABELLERS)):
                outcome = np.bincount(table[:, k], weights=mass, minlength=3) + 0.5
                logs[-1] = logs[-1] + np.log(outcome / outcome.sum())[table[:, k]]
        good = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -40, 40)))
    return good


def features(found, words, counts):
    """Sparse rows: one bin per signal, and the hashed words with equal parts of 1 per text."""
    scaled = found.copy()
    scaled[:, 0] = np.log2(1 + found[:, 0]) / 20
    scaled[:, SIGNALS.index("word_length")] /= 16
    bins = np.clip((np.sqrt(np.maximum(scaled, 0)) * BINS).astype(np.int64), 0, BINS - 1)
    bins += BUCKETS + np.arange(len(SIGNALS)) * BINS
    hashed = (words >> U64(48)).astype(np.int64)
    return bins, hashed, 1 / np.maximum(counts, 1)


def _patterns(part):
    total = np.zeros(N_PATTERNS, np.int64)
    powers = 3 ** np.arange(len(LABELLERS))
    for _, data, offsets in tb.slices(part):
        total += np.bincount(votes(signals(data, offsets)[0]) @ powers, minlength=N_PATTERNS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["pattern", "n"])


def _examples(posterior):
    powers = 3 ** np.arange(len(LABELLERS))

    def rows_of(part):
        for rows, data, offsets in tb.slices(part):
            found, words, counts = signals(data, offsets)
            bins, hashed, share = features(found, words, counts)
            order = np.repeat(np.arange(len(counts)), counts)
            pair, n = np.unique(order * BUCKETS + hashed, return_counts=True)
            each = np.bincount(pair // BUCKETS, minlength=len(counts))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key"),
                    rows.column("copies"),
                    pa.array(posterior[votes(found) @ powers]),
                    tb.lists(bins.ravel(), np.full(len(counts), len(SIGNALS)), pa.int64()),
                    tb.lists(pair % BUCKETS, each, pa.int64()),
                    tb.lists(n * share[pair // BUCKETS], each, pa.float64()),
                ],
                ["key", "copies", "target", "bins", "words", "shares"],
            )

    return rows_of


def _scores(weights, bias, text):
    def rows_of(part):
        for rows, data, offsets in tb.slices(part, text):
            found, words, counts = signals(data, offsets)
            bins, hashed, share = features(found, words, counts)
            margin = weights[bins].sum(axis=1) + bias + tb.sums_per_row(weights[hashed].astype(float), counts) * share
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(sigmoid(margin))], [*rows.schema.names, "quality_score"]
            )

    return rows_of


def train(docs, text="text", train_rows=TRAIN_ROWS):
    """(weights, bias) of the scorer.

    The vote patterns of all documents are counted (at most 3**7 rows reach the driver). About
    `train_rows` documents at most, chosen by a hash of the text, train the scorer. Copies of a text
    are one row that counts as often, so whatever is copied, the same texts are chosen in any run.
    """
    texts = docs.select(F.col(text).alias("text"))
    counts = np.zeros(N_PATTERNS, np.int64)
    for pattern, n in texts.mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n")).collect():
        counts[pattern] = n
    posterior = estimate(counts)
    share = min(1.0, train_rows / max(int(counts.sum()), 1))
    chosen = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    chosen = chosen.groupBy("text").agg(F.count("*").alias("copies")).withColumn("key", F.xxhash64("text"))
    schema = "key long, copies long, target double, bins array<long>, words array<long>, shares array<double>"
    rows = chosen.mapInArrow(_examples(posterior), schema).toArrow().sort_by("key")
    size = BUCKETS + len(SIGNALS) * BINS
    if not rows.num_rows:
        return np.zeros(size, np.float32), 0.0
    bins, words, shares = (rows.column(c).combine_chunks() for c in ("bins", "words", "shares"))
    per_row = np.diff(words.offsets.to_numpy()) if rows.num_rows else np.zeros(0, int)
    n = rows.num_rows
    index = np.concatenate((bins.flatten().to_numpy(), words.flatten().to_numpy()))
    value = np.concatenate((np.ones(n * len(SIGNALS)), shares.flatten().to_numpy()))
    owner = np.concatenate((np.repeat(np.arange(n), len(SIGNALS)), np.repeat(np.arange(n), per_row)))
    order = np.argsort(owner, kind="stable")
    target = rows.column("target").to_numpy()
    weights, bias = fit(index[order], value[order], per_row + len(SIGNALS), target, size, copies=rows.column("copies").to_numpy())
    return weights.astype(np.float32), float(bias)


def score_quality(docs, text="text", train_rows=TRAIN_ROWS):
    """`docs` with quality_score (0 to 1) and accepted (score >= 0.5).

    Null and empty texts have no words; every labeller calls them bad, and they are rejected.
    Rows that repeat get equal scores. All columns stay; quality_score and accepted replace
    columns of that name. An empty table gives an empty result.
    """
    weights, bias = train(docs, text, train_rows)
    kept = docs.drop("quality_score", "accepted")
    schema = T.StructType([*kept.schema.fields, T.StructField("quality_score", T.DoubleType())])
    scored = kept.mapInArrow(_scores(weights, bias, text), schema)
    empty = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return scored.withColumn("accepted", (F.col("quality_score") >= THRESHOLD) & ~empty)
