"""Words and hashes of whole text batches, computed on Arrow's own buffers with numpy.

A batch is cut into slices of about `SLICE_BYTES` of text (a longer text is a slice of its
own), so that the working arrays of a task stay small whatever the batch size is.
"""

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
U64 = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C13  # odd, 3 modulo 4


def byte_set(*ranges):
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


def lowered():
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))  # between words [^\x20\x09-\x0D]+
LOWER = lowered()


def mix(x):
    """Bijective 64-bit mixer (xor-shift and multiply)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def constants(n, seed):
    """n fixed 64-bit numbers, odd."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(MULTIPLIER) + U64(seed)) | U64(1)


def buffers(texts):
    """(bytes, offsets) of a string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches, column="text", limit=SLICE_BYTES):
    """Yield (slice of the batch, bytes, offsets) for runs of rows of about `limit` text bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = buffers(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            cut = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[cut[0] : cut[-1]], cut - cut[0]
            first = last


def word_spans(data, offsets, separators=SPACES):
    """Byte spans of all words and the number of words of each row, in order."""
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    edge = offsets[:-1][filled]
    begins[edge] = inside[edge]
    edge = offsets[1:][filled] - 1
    ends[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.diff(np.searchsorted(starts, offsets))


@cache
def _power_table(size, multiplier):
    powers = np.full(size, multiplier, U64)
    powers[0] = 1
    return np.cumprod(powers, dtype=U64)


def powers(n, multiplier=MULTIPLIER):
    """The first n powers modulo 2**64; the table doubles, so a worker builds few of them."""
    return _power_table(max(1 << 16, 1 << int(n).bit_length()), multiplier)[:n]


def inverse(multiplier=MULTIPLIER):
    return pow(multiplier, -1, 1 << 64)


def span_hashes(codes, starts, ends):
    """Hash of each span of 64-bit codes by prefix sums of a polynomial; equal spans hash equally."""
    n = len(codes)
    prefix = np.zeros(n + 1, U64)
    np.cumsum(codes * powers(n), out=prefix[1:])
    found = (prefix[ends] - prefix[starts]) * powers(n + 1, inverse())[starts]
    return mix(found + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


@cache
def byte_codes(fold=True, seed=1):
    """One random code per byte; upper-case ASCII letters share those of the lower case."""
    codes = constants(256, seed)
    return codes[LOWER] if fold else codes


def word_hashes(data, starts, ends, codes=None):
    return span_hashes((byte_codes() if codes is None else codes)[data], starts, ends)


def shingle_hashes(words, counts, width=5):
    """Hashes of all runs of `width` words, per row in order; a shorter row is one run.

    Returns (hashes, number per row).
    """
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    position = np.arange(len(words)) - first[rows]
    keep = position < np.maximum(counts - width + 1, np.minimum(counts, 1))[rows]
    at = np.flatnonzero(keep)
    sizes = np.minimum(counts[rows[at]], width)
    total = sizes.astype(U64) * U64(0xA0761D6478BD642F)
    for k, factor in enumerate(constants(width, 2)):
        some = sizes > k
        total[some] += words[at[some] + k] * factor
    return mix(total), np.bincount(rows[at], minlength=len(counts))


def distinct_per_row(values, counts):
    """Sorted distinct values of each row: (values, number per row)."""
    values = values.copy()
    edges = np.concatenate(([0], np.cumsum(counts)))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[edges[:-1][counts > 0]] = True
    rows = np.repeat(np.arange(len(counts)), counts)
    return values[keep], np.bincount(rows[keep], minlength=len(counts))


def sums_per_row(values, counts):
    """Sum of each row's values; 0 for rows without any."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    edges = np.concatenate(([0], np.cumsum(counts)))
    return total[edges[1:]] - total[edges[:-1]]


def lists(values, counts, kind):
    """An Arrow list array with `counts` values per row."""
    edges = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values, kind))


def signed(values):
    return np.ascontiguousarray(values, U64).view(np.int64)
