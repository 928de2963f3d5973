"""Embedding columns as integer matrices, in blocks that are one row each."""

import numpy as np
import pyarrow as pa


def usable(column, dims=None):
    """Indices of the rows whose list holds only finite numbers (and `dims` of them), and their lengths."""
    lists = column.cast(pa.large_list(pa.float64()))
    offsets = lists.offsets.to_numpy()
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False))  # a null becomes nan
    sums = np.concatenate(([0], np.cumsum(bad)))
    lengths = np.diff(offsets)
    at = offsets - offsets[0]
    good = lists.is_valid().to_numpy(zero_copy_only=False) & (sums[at[1:]] == sums[at[:-1]])
    if dims is not None:
        good &= lengths == dims
    return np.flatnonzero(good), flat, at


def matrix(flat, at, rows, scale, limit):
    """floor(scale * x) of the given rows, held to -limit..limit, shorter rows filled with 0."""
    lengths = at[rows + 1] - at[rows]
    width = int(lengths.max(initial=0))
    out = np.zeros((len(rows), width))
    values = flat.to_numpy(zero_copy_only=False)
    filled = np.arange(width) < lengths[:, None]
    out[filled] = values[(at[rows][:, None] + np.arange(width))[filled]]
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * scale), -limit, limit).astype(np.int64)


def pack(numbers):
    """A matrix as (bytes, width, bytes of a number)."""
    size = 2 if np.abs(numbers).max(initial=0) < 1 << 15 else 4
    return numbers.astype(f"<i{size}").tobytes(), numbers.shape[1], size


def unpack(data, rows, size):
    numbers = np.frombuffer(data, f"<i{size}")
    return numbers.reshape(rows, len(numbers) // rows) if rows else np.zeros((0, 0), np.int16)


def products(a, b, bound):
    """Exact integer inner products of all rows; no partial sum exceeds `bound`."""
    width = max(a.shape[1], b.shape[1])
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    a, b = (np.pad(x.astype(kind), ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    return a @ b.T
