"""Document fingerprints from modular prefix hashes.

A text's prefix array holds, for every length, the polynomial hash of the text's beginning
modulo two primes. Two lookups give the hash of any span, so spans of different texts are
compared without reading them and the longest common extension of two positions is found by
binary search. A fingerprint is the hash of the whole text and a grid of prefix and suffix
hashes; the common beginning and end of two texts are located in the grids by binary search.
It also has prefix hashes at cuts that follow from the content, so that equal spans are found
behind an edit and aligned in order. `likeness` works on fingerprints alone and rounds edits up
to whole spans; what neighbours have in common at their beginning and end is also located exactly,
by binary search on both prefix arrays (`common_extension`, `common_ending`).
"""

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm import textbatch as tb

PRIMES = (2147483629, 2147483587)  # primes below 2**31
BASES = (1000003, 1299721)
GRID = 32
WINDOW = 8  # characters before a cut that decide on it


@cache
def _powers(size):
    """Powers of both bases for texts up to `size` characters."""
    out = np.ones((2, size), np.uint64)
    for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
        filled, factor = 1, base
        while filled < size:  # doubling: the second half is the first times base**filled
            n = min(filled, size - filled)
            out[k, filled : filled + n] = out[k, :n] * np.uint64(factor) % np.uint64(prime)
            filled, factor = filled * 2, factor * factor % prime
    return out


class Prefixes:
    """Prefix hashes of one text: entry i is the hash of its first i characters."""

    def __init__(self, text):
        self.codes = codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        size = 1 << max(12, self.n.bit_length())
        self.powers = _powers(size)
        self.sums = np.zeros((2, self.n + 1), np.uint64)
        for k, prime in enumerate(PRIMES):
            # Terms are below 2**31, so 2**32 of them fit into a sum.
            np.cumsum(codes * self.powers[k, : self.n] % np.uint64(prime), out=self.sums[k, 1:])
            self.sums[k] %= np.uint64(prime)

    def span(self, start, end):
        """Hash of characters start to end, as one number that does not depend on the place."""
        found = 0
        for k, prime in enumerate(PRIMES):
            value = (int(self.sums[k, end]) - int(self.sums[k, start])) % prime
            found = found << 31 | value * pow(BASES[k], -start, prime) % prime
        return found


    def agrees(self, start, other, at, size):
        """Whether `size` characters from `start` equal those of `other` from `at`; the earlier place is shifted to the later."""
        for k, prime in enumerate(PRIMES):
            own = int(self.sums[k, start + size]) - int(self.sums[k, start])
            that = int(other.sums[k, at + size]) - int(other.sums[k, at])
            if start < at:
                own *= int(other.powers[k, at - start])
            elif at < start:
                that *= int(self.powers[k, start - at])
            if (own - that) % prime:
                return False
        return True


def _longest(most, agrees):
    """Largest n up to `most` for which `agrees(n)` holds; it holds for all smaller ones too."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        if agrees(middle):
            low = middle
        else:
            high = middle - 1
    return low


def common_extension(a, i, b, j):
    """Length of the longest common run of `a` from i and `b` from j."""
    return _longest(min(a.n - i, b.n - j), lambda n: a.agrees(i, b, j, n))


def common_ending(a, b):
    """Length of the longest common end of two texts."""
    return _longest(min(a.n, b.n), lambda n: a.agrees(a.n - n, b, b.n - n, n))


def step_of(n):
    """Grid distance: the power of two that leaves at most GRID points."""
    step = 1
    while n // step > GRID:
        step *= 2
    return step


def level_of(n):
    """Binary logarithm of the mean span: about 32 to 64 spans, of 8 characters at least."""
    return max(3, step_of(n).bit_length() - 2)


def cuts(p):
    """(place, level) of the cuts of a text; those of a higher level are fewer."""
    if p.n < WINDOW:
        return []
    least = level_of(p.n)
    starts = np.arange(p.n - WINDOW + 1)
    found = tb.span_hashes(tb.mix(p.codes), starts, starts + WINDOW)
    at = np.flatnonzero(found & np.uint64((1 << least) - 1) == 0)
    out, gap = [], 1 << (least - 2)  # a periodic text has no more than four times as many
    for place, value in zip((at + WINDOW).tolist(), found[at].tolist()):
        if place < p.n and (not out or place - out[-1][0] >= gap):
            out.append((place, min(15, (value & -value).bit_length() - 1) if value else 15))
    return out


def fingerprint(text):
    return fingerprint_of(Prefixes(text))


def fingerprint_of(p):
    """'length-hash-prefixes-suffixes-cuts' in hexadecimal; equal texts have equal fingerprints.

    The prefix part has the hashes of the beginnings of step, 2 * step, ... characters, the
    suffix part those of the ends; step follows from the length. A cut is its place, its level
    and the hash of the beginning up to it (8, 1 and 8 digits).
    """
    lengths = np.arange(step_of(p.n), p.n + 1, step_of(p.n))
    first = p.sums[0, lengths] if len(lengths) else lengths
    last = [p.span(p.n - int(x), p.n) % PRIMES[1] for x in lengths]
    inner = [f"{x:08x}{level:x}{int(p.sums[0, x]):08x}" for x, level in cuts(p)]
    return "-".join(
        [f"{p.n:x}", f"{p.span(0, p.n):016x}", "".join(f"{int(x):08x}" for x in first), "".join(f"{x:08x}" for x in last), "".join(inner)]
    )


@cache
def _inverse():
    return pow(BASES[0], -1, PRIMES[0])


def _spans(n, whole, part, level):
    """(length, hash) of the spans between the cuts of `level` or more, in order."""
    edges = [(0, 0)]
    for k in range(0, len(part), 17):
        if int(part[k + 8], 16) >= level:
            edges.append((int(part[k : k + 8], 16), int(part[k + 9 : k + 17], 16)))
    edges.append((n, int(whole, 16) >> 31))
    return [(y - x, (v - u) * pow(_inverse(), x, PRIMES[0]) % PRIMES[0]) for (x, u), (y, v) in zip(edges, edges[1:])]


def _aligned(a, b):
    """Most characters in equal spans that have the same order in both lists."""
    both = set(a) & set(b)
    a, b = [x for x in a if x in both], [x for x in b if x in both]
    best = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, best[k] = best[k], before + x[0] if x == y else max(best[k], best[k - 1])
    return best[-1]


def _grid(part, step):
    return {step * (k + 1): part[8 * k : 8 * k + 8] for k in range(len(part) // 8)}


def _common(a, b, lengths):
    """Largest of `lengths` at which both grids agree; agreement is downward closed."""
    low, high = 0, len(lengths)
    while low < high:
        middle = (low + high) // 2
        if a[lengths[middle]] == b[lengths[middle]]:
            low = middle + 1
        else:
            high = middle
    return lengths[low - 1] if low else 0


def likeness(one, other):
    """Characters two fingerprinted texts have in common, in order, as a share of the longer, 0 to 1.

    1 for equal fingerprints (two empty texts too). Common beginning, end and equal spans between
    them count. The grid rounds beginning and end down to multiples of the wider step, and a
    span with an edit does not count.
    """
    if one == other:
        return 1.0
    (n, a_all, a_first, a_last, a_cuts), (m, b_all, b_first, b_last, b_cuts) = one.split("-"), other.split("-")
    n, m = int(n, 16), int(m, 16)
    if not min(n, m):
        return 0.0
    wide = max(step_of(n), step_of(m))
    lengths = list(range(wide, min(n, m) + 1, wide))
    begin = _common(_grid(a_first, step_of(n)), _grid(b_first, step_of(m)), lengths)
    end = _common(_grid(a_last, step_of(n)), _grid(b_last, step_of(m)), lengths)
    level = max(level_of(n), level_of(m))
    a, b = _spans(n, a_all, a_cuts, level), _spans(m, b_all, b_cuts, level)
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    back = 0
    while back < min(len(a), len(b)) - front and a[-1 - back] == b[-1 - back]:
        back += 1
    middle = _aligned(a[front : len(a) - back], b[front : len(b) - back])
    begin, end = max(begin, sum(x[0] for x in a[:front])), max(end, sum(x[0] for x in a[len(a) - back :]))
    return min(begin + end + middle, min(n, m)) / max(n, m)


def edited(text, following):
    """`text` whose last floor(n / 2) characters are replaced by the first as many of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("start_edited", T.LongType()),
        T.StructField("start_next", T.LongType()),
        T.StructField("end_next", T.LongType()),
    ]
)


def _rows(part):
    """Rows arrive sorted by (block, last, id, text); each is paired with its successor in the block."""
    previous = None
    for batch in part:
        out = []
        for block, guest, id, text in zip(*(batch.column(c).to_pylist() for c in ("block", "guest", "id", "text"))):
            text = text or ""
            prefixes = Prefixes(text)
            own = fingerprint_of(prefixes)
            if previous and previous[0] == block and not previous[1]:
                out.append(_result(previous, own, text, prefixes))
            previous = (block, guest, id, text, own, prefixes)
        yield pa.RecordBatch.from_pylist(out, schema=ARROW)
    yield pa.RecordBatch.from_pylist([], schema=ARROW)


def _result(previous, following, next_text, next_prefixes):
    _, _, id, text, own, prefixes = previous
    changed = edited(text, next_text)
    changed_prefixes = Prefixes(changed)
    other = fingerprint_of(changed_prefixes)
    return {
        "doc_id": id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": own,
        "edited_fingerprint": other,
        "near_edited": likeness(own, other),
        "near_next": likeness(own, following),
        "start_edited": common_extension(prefixes, 0, changed_prefixes, 0),
        "start_next": common_extension(prefixes, 0, next_prefixes, 0),
        "end_next": common_ending(prefixes, next_prefixes),
    }


ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("start_edited", pa.int64()),
        ("start_next", pa.int64()),
        ("end_next", pa.int64()),
    ]
)


def fingerprint_documents(docs, id="doc_id", text="text", blocks=None):
    """One row per document: its fingerprint and that of its edited text (see `edited`), the likeness of both and of the
    next document's, and how many characters it begins with like the edited text (start_edited) and begins
    and ends with like the next one (start_next, end_next). Texts of any length are hashed whole; other
    columns of `docs` are ignored.

    The following document is the next by ascending (id, text), null ids first; the last one is
    followed by the first. Null texts are empty. Rows that repeat are documents of their own.
    An empty table gives an empty result.

    Ids are cut into `blocks` ranges of about equal numbers (by default as many as shuffle
    partitions). The rows that begin a range also go, as guests, to the end of the range before,
    so neighbours meet without a second shuffle. Only the bounds reach the driver.
    """
    c = F.col
    spark = docs.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(c(id).cast("long").alias("id"), F.coalesce(c(text), F.lit("")).alias("text"))
    shares = [k / blocks for k in range(1, blocks)] or [0.5]
    ranks = F.percentile_approx("id", F.array(*[F.lit(x) for x in shares]), F.lit(100 * blocks))
    least, found, total, known = rows.agg(F.min("id"), ranks, F.count("*"), F.count("id")).first()
    if not total:
        return spark.createDataFrame([], RESULT)
    bounds = [None if known < total else least]
    bounds += sorted({x for x in (found or []) if x is not None and x != bounds[0]} | ({least} if known < total and known else set()))
    # Where each bound is the smallest id of its range; a null first bound stands for null ids.
    numbers = [x for x in bounds if x is not None]
    shift = len(bounds) - len(numbers)

    def place(part):
        edges = np.array(numbers, np.int64)
        for batch in part:
            ids = batch.column("id")
            null = np.array(ids.is_null())
            value = np.array(ids.fill_null(0))
            block = np.where(null, 0, np.searchsorted(edges, value, side="right") - 1 + shift)
            first = np.where(null, shift > 0, np.isin(value, edges) & ~null)
            at = np.flatnonzero(first)
            before = np.where(block[at] == 0, len(bounds) - 1, block[at] - 1)
            both = np.concatenate((np.arange(len(block)), at))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((block, before)), pa.int32()),
                    pa.array(np.arange(len(both)) >= len(block)),
                    ids.take(pa.array(both)),
                    batch.column("text").take(pa.array(both)),
                ],
                ["block", "guest", "id", "text"],
            )

    placed = rows.mapInArrow(place, "block int, guest boolean, id long, text string")
    sorted_rows = placed.repartitionById(len(bounds), "block").sortWithinPartitions("block", "guest", "id", "text")
    return sorted_rows.mapInArrow(_rows, RESULT)
