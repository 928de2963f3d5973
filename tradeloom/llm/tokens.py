"""Token counts by a linear longest-match automaton.

The vocabulary's byte strings form a trie. Each node has a failure link: where matching goes on
when the next byte does not continue the trie, after the longest pieces at the front were given
out, and how many pieces that is. Following links is folded into one transition table, so the
greedy longest-match pieces of a word are counted in one step per byte, without building any.
"""

import base64
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm import textbatch as tb

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
STATE_BITS = 20


def read_vocabulary(spark, path=VOCABULARY):
    """The pieces of a vocabulary file with one base64 piece and its rank per line."""
    lines = spark.read.text(path).select(F.split("value", " ")[0].alias("piece")).filter("piece <> ''").collect()
    return tuple(sorted(base64.b64decode(r[0]) for r in lines))


class Automaton:
    """step: (states, 256) of next state | pieces given out << STATE_BITS; end: pieces left per state."""

    def __init__(self, pieces):
        pieces = {p for p in pieces if p} | {bytes([b]) for b in range(256)}
        children, complete, depth, parent, byte = [{}], [False], [0], [0], [0]
        for piece in pieces:
            at = 0
            for b in piece:
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                    complete.append(False)
                    depth.append(depth[at] + 1)
                    parent.append(at)
                    byte.append(b)
                at = children[at][b]
            complete[at] = True
        n = len(children)
        if n >= 1 << STATE_BITS:
            raise ValueError(f"a vocabulary of {n} trie nodes exceeds {1 << STATE_BITS}")
        self.step = np.zeros((n, 256), np.int32)
        self.end = np.zeros(n, np.int64)
        fail, given = [0] * n, [0] * n
        for b, child in children[0].items():
            self.step[0, b] = child
        unit = 1 << STATE_BITS
        for node in sorted(range(1, n), key=depth.__getitem__):
            if complete[node]:
                fail[node], given[node] = 0, 1
            else:
                # Every single byte is a piece, so an incomplete node has a parent below the root.
                target = int(self.step[fail[parent[node]], byte[node]])
                fail[node], given[node] = target % unit, given[parent[node]] + target // unit
            self.step[node] = self.step[fail[node]] + given[node] * unit
            for b, child in children[node].items():
                self.step[node, b] = child
            self.end[node] = given[node] + self.end[fail[node]]

    def count(self, data, starts, ends):
        """Pieces of each byte span; all spans advance together, the longest last."""
        order = np.argsort(starts - ends, kind="stable")
        begin, length = starts[order], (ends - starts)[order]
        state, pieces = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        alive = len(order)
        for t in range(int(length[0]) if len(order) else 0):
            while length[alive - 1] <= t:
                alive = int(np.searchsorted(-length, -t, side="left"))
            found = self.step[state[:alive], data[begin[:alive] + t]]
            state[:alive] = found & ((1 << STATE_BITS) - 1)
            pieces[:alive] += found >> STATE_BITS
        out = np.empty(len(order), np.int64)
        out[order] = pieces + self.end[state]
        return out


@cache
def automaton(pieces):
    """One automaton per worker process and vocabulary."""
    return Automaton(pieces)


def _counter(pieces, text):
    def rows_of(part):
        machine = automaton(pieces)
        space = np.array([32], np.uint8)
        for rows, data, offsets in tb.slices(part, text):
            starts, ends, counts = tb.word_spans(data, offsets)
            _, sample, word = np.unique(
                tb.word_hashes(data, starts, ends, tb.byte_codes(fold=False)), return_index=True, return_inverse=True
            )
            # The distinct words once more, each after the space that begins a word's piece.
            first, length = starts[sample], (ends - starts)[sample]
            edges = np.concatenate(([0], np.cumsum(length + 1)))
            own = np.empty(edges[-1], np.uint8)
            own[edges[:-1]] = space
            inner = np.repeat(first - edges[:-1] - 1, length) + np.delete(np.arange(edges[-1]), edges[:-1])
            own[np.delete(np.arange(edges[-1]), edges[:-1])] = data[inner]
            tokens = machine.count(own, edges[:-1], edges[1:])
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(counts, pa.int64()), pa.array(tb.sums_per_row(tokens[word], counts), pa.int64())],
                [*rows.schema.names, "n_words", "n_tokens"],
            )

    return rows_of


def count_tokens(docs, pieces, text="text"):
    """`docs` with n_words (runs of other characters than white space) and n_tokens.

    Each word is matched with a space in front, as word-initial pieces of the vocabulary have it,
    always taking the longest piece; single bytes are pieces too, so every word has tokens. White
    space itself is not counted. Null and empty texts have 0 of both. All columns stay; n_words
    and n_tokens replace columns of that name. Rows that repeat get equal counts.
    """
    kept = docs.drop("n_words", "n_tokens")
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return kept.mapInArrow(_counter(pieces, text), T.StructType([*kept.schema.fields, *added]))
