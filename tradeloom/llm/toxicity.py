"""Toxicity: character n-grams scaled by naive Bayes log-count ratios under a linear classifier.

A text's features are the hashed character n-grams of its distinct words (word ends marked),
counted once per distinct word. The ratios come from all labelled training texts, counted by
Spark; the linear classifier is fitted on a bounded sample of them, over the n-grams whose ratio
says something. What is left is one number per n-gram, with which every text is scored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm import textbatch as tb
from tradeloom.llm.linear import fit, sigmoid
from tradeloom.session import stored

U64 = np.uint64
LENGTHS = (3, 4, 5)
SIZE_BITS = 20
SMOOTHING = 2.0
LEAST_RATIO = 1.0  # smaller ratios, either way, are left out
TRAIN_ROWS = 12_000
LABELS = 400_000  # labels that train, at most; a broadcast of about 20 MB
THRESHOLD = 0.3
SEPARATORS = tb.byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def _word_grams(data, starts, ends):
    """Hashed n-grams of words given by their byte spans: (features, number per word)."""
    codes = tb.byte_codes(fold=True, seed=11)[data]
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    first, last = np.searchsorted(heads, starts), np.searchsorted(heads, ends)
    heads = np.append(heads, len(data))
    length = last - first
    owners, found = [], []
    for n in LENGTHS:
        number = np.maximum(length - n + 1, 0)
        owner = np.repeat(np.arange(len(starts)), number)
        at = first[owner] + np.arange(len(owner)) - (np.cumsum(number) - number)[owner]
        hashes = tb.span_hashes(codes, heads[at], heads[at + n])
        edge = (at == first[owner]).astype(U64) * U64(0x9FB21C651E98DF25) + (at + n == last[owner]).astype(U64) * U64(0xC2B2AE3D27D4EB4F)
        owners.append(owner)
        found.append(tb.mix(hashes + edge) >> U64(64 - SIZE_BITS))
    owner, feature = np.concatenate(owners), np.concatenate(found).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return feature[order], np.bincount(owner, minlength=len(starts))


def _distinct_words(data, offsets):
    """(starts, ends) of the slice's distinct words, (row, word) pairs without repeats, number of rows."""
    starts, ends, counts = tb.word_spans(data, offsets, SEPARATORS)
    _, sample, word = np.unique(tb.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    row = np.repeat(np.arange(len(counts)), counts)
    pairs = np.unique(row * max(len(sample), 1) + word)
    return starts[sample], ends[sample], pairs // max(len(sample), 1), pairs % max(len(sample), 1), len(counts)


def _label_counts(part):
    total = np.zeros((2, 1 << SIZE_BITS))
    for rows, data, offsets in tb.slices(part):
        starts, ends, row, word, _ = _distinct_words(data, offsets)
        grams, per_word = _word_grams(data, starts, ends)
        owner = np.repeat(np.arange(len(starts)), per_word)
        toxic = rows.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        for label in (0, 1):
            uses = np.bincount(word[toxic[row] == bool(label)], minlength=len(starts))
            total[label] += np.bincount(grams, weights=uses[owner], minlength=1 << SIZE_BITS)
    seen = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int64()), pa.array(total[0, seen]), pa.array(total[1, seen])], ["feature", "clean", "toxic"]
    )


def _rows_of_features(ratios):
    informative = ratios != 0

    def rows_of(part):
        for rows, data, offsets in tb.slices(part):
            starts, ends, row, word, n = _distinct_words(data, offsets)
            grams, per_word = _word_grams(data, starts, ends)
            keep = informative[grams]
            per_word = np.bincount(np.repeat(np.arange(len(starts)), per_word)[keep], minlength=len(starts))
            grams = grams[keep]
            first = np.cumsum(per_word) - per_word
            number = per_word[word]
            at = np.repeat(first[word] - (np.cumsum(number) - number), number) + np.arange(number.sum())
            pair, times = np.unique(np.repeat(row, number) * (1 << SIZE_BITS) + grams[at], return_counts=True)
            each = np.bincount(pair >> SIZE_BITS, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key"),
                    rows.column("copies"),
                    pa.array(rows.column("toxic").cast(pa.float64())),
                    tb.lists(pair & ((1 << SIZE_BITS) - 1), each, pa.int64()),
                    tb.lists(times, each, pa.int64()),
                ],
                ["key", "copies", "target", "features", "times"],
            )

    return rows_of


def _scores(weights, bias, text):
    def rows_of(part):
        for rows, data, offsets in tb.slices(part, text):
            starts, ends, row, word, n = _distinct_words(data, offsets)
            grams, per_word = _word_grams(data, starts, ends)
            of_word = tb.sums_per_row(weights[grams].astype(float), per_word)
            margin = np.bincount(row, weights=of_word[word], minlength=n) + bias
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sigmoid(margin))], [*rows.schema.names, "score"])

    return rows_of


def log_count_ratios(clean, toxic):
    """Log ratio of smoothed shares; n-grams that are rare in both come out near 0."""
    both = max(clean.sum() + toxic.sum(), 1.0)
    parts = [(x + SMOOTHING * max(x.sum(), 1) / both * 2) / max(x.sum(), 1) for x in (clean, toxic)]
    ratios = np.log(parts[1] / parts[0])
    return np.where(np.abs(ratios) >= LEAST_RATIO, ratios, 0.0)


def train(labelled, n_rows, train_rows=TRAIN_ROWS):
    """(weights, bias) from `n_rows` rows (text, toxic). Counts cover all rows; about `train_rows` of them at
    most, chosen by a hash of the text, fit the classifier. Copies of a text with one label are one row that
    counts as often, so the same texts are chosen in any run."""
    rows = labelled.filter("toxic is not null").select("text", F.col("toxic").cast("int").alias("toxic"))
    size = 1 << SIZE_BITS
    counted = rows.mapInArrow(_label_counts, "feature long, clean double, toxic double")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = stored(counted, "gram-counts")
    # At most 2**SIZE_BITS rows, of which only the telling ones are sent on.
    sums = counted.agg(F.sum("clean"), F.sum("toxic")).first()
    if not sums[0] or not sums[1]:
        return np.zeros(size, np.float32), 0.0
    table = counted.filter("toxic >= 2 or clean >= 2").toArrow()
    clean, toxic = np.zeros(size), np.zeros(size)
    clean[table.column("feature").to_numpy()] = table.column("clean").to_numpy()
    toxic[table.column("feature").to_numpy()] = table.column("toxic").to_numpy()
    ratios = log_count_ratios(clean, toxic)
    share = int(min(1.0, train_rows / max(n_rows, 1)) * (1 << 20)) + 1
    chosen = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share)
    chosen = chosen.groupBy("text", "toxic").agg(F.count("*").alias("copies")).withColumn("key", F.xxhash64("text", "toxic"))
    schema = "key long, copies long, target double, features array<long>, times array<long>"
    sample = chosen.mapInArrow(_rows_of_features(ratios), schema).toArrow().sort_by("key")
    features, times = (sample.column(c).combine_chunks() for c in ("features", "times"))
    index, counts = features.flatten().to_numpy(), np.diff(features.offsets.to_numpy())
    used, at = np.unique(index, return_inverse=True)
    value = times.flatten().to_numpy() * ratios[index]
    fitted, bias = fit(at, value, counts, sample.column("target").to_numpy(), len(used), l2=1e-4, copies=sample.column("copies").to_numpy())
    weights = np.zeros(size)
    weights[used] = fitted * ratios[used]
    return weights.astype(np.float32), float(bias)


def held_out(id):
    """Rows that never train: those whose id as text has a CRC-32 of 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def bounded_labels(labels, most=LABELS):
    """(labels, or those of about `most` ids chosen by a hash of the id; their number). Few enough to broadcast."""
    n = labels.count()
    if n <= most:
        return labels, n
    share = int(most / n * (1 << 20))
    labels = labels.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share)
    return labels, labels.count()


def score_toxicity(docs, labels, id="doc_id", text="text", label="toxic", train_rows=TRAIN_ROWS, most_labels=LABELS):
    """`docs` with held_out, score (0 to 1) and predicted (1 if score >= 0.3).

    Labels are joined by id for training only: all of them, or about `most_labels` chosen by a hash
    of the id, so that they are broadcast and no text moves. Null ids and null labels train nothing, a label
    that repeats counts as often. Null and empty texts get the score of a text without features.
    With labels of one class only, or none, every score is 0.5. Rows that repeat get equal
    scores. The new columns replace columns of their name. An empty table gives an empty result.
    """
    c = F.col
    training = docs.select(c(id).alias("id"), c(text).alias("text")).filter(~held_out(c("id")))
    marked = labels.select(c(id).alias("id"), c(label).alias("toxic")).filter(~held_out(c("id")))
    marked = stored(marked.filter("id is not null and toxic is not null").withColumn("toxic", c("toxic").cast("int")), "labels")
    chosen, n = bounded_labels(marked, most_labels)
    # An id of which more labels come than are bounded is shuffled; so many copies of a label are no sample.
    chosen = F.broadcast(chosen) if n <= 2 * most_labels else chosen
    weights, bias = train(training.join(chosen, "id"), n, train_rows)
    kept = docs.drop("score", "held_out", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    scored = kept.mapInArrow(_scores(weights, bias, text), schema)
    return scored.withColumns(
        {"held_out": held_out(c(id)), "predicted": (c("score") >= THRESHOLD).cast("int")}
    )
