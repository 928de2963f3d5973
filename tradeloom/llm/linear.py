"""Logistic regression on sparse rows, for bounded training samples."""

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(index, value, counts, target, size, l2=1e-4, rounds=300, rate=0.3, copies=None):
    """(weights, bias) for rows with `counts` entries (index, value) each and targets from 0 to 1.

    copies: how often each row counts, by default once. Full-batch gradient steps with a
    per-weight rate (AdaGrad); the result depends on the rows alone, not on their order beyond rounding.
    """
    row = np.repeat(np.arange(len(counts)), counts)
    weights, bias = np.zeros(size), 0.0
    squares, bias_squares = np.full(size, 1e-8), 1e-8
    share = np.ones(len(counts)) if copies is None else np.asarray(copies, float)
    share /= max(share.sum(), 1.0)
    for _ in range(rounds):
        margin = np.bincount(row, weights=value * weights[index], minlength=len(counts)) + bias
        error = (sigmoid(margin) - target) * share
        gradient = np.bincount(index, weights=value * error[row], minlength=size) + l2 * weights
        squares += gradient**2
        weights -= rate * gradient / np.sqrt(squares)
        slope = error.sum()
        bias_squares += slope**2
        bias -= rate * slope / np.sqrt(bias_squares)
    return weights, bias
