"""Poly-A tails: the two-state model in closed form.

The model reads the sequence from its 3' end, starts in the tail or in the body, leaves the tail
once at most and never returns, so a path is a tail length k. Against "no tail" a path gains
ln(4 * 0.9 * 0.99) for an A and ln(4 * 0.9 * 0.01 / 3) for another base, and ln(0.1) for leaving the
tail. The best k, the least on ties, is the Viterbi path. Counting A's first keeps the score
independent of the order of summation. Reads are scored base by base in numpy, in linear time and in
pieces of bounded size from the 3' end.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The model's probabilities.
STAY, LEAVE, TAIL_A, TAIL_OTHER, BODY = 0.9, 0.1, 0.99, 0.01 / 3, 0.25
GAIN_A, GAIN_OTHER, COST_LEAVE = math.log(STAY * TAIL_A / BODY), math.log(STAY * TAIL_OTHER / BODY), math.log(LEAVE)


PIECE = 1 << 20


def _ends(seq: str, n: int, piece: int):
    """Of the last ``n`` bases, from the 3' end in pieces: (bases before the piece, score of every tail length that ends in it, leaving aside)."""
    at, seen = 0, 0
    while at < n:
        some = np.frombuffer(seq[len(seq) - min(at + piece, n) : len(seq) - at].encode("ascii", "replace"), np.uint8)[::-1]
        a = seen + np.cumsum((some == 65) | (some == 97))
        k = np.arange(at + 1, at + len(some) + 1)
        yield at, a * GAIN_A + (k - a) * GAIN_OTHER
        at, seen = at + len(some), int(a[-1])


def _tail(seq: str, n: int, piece: int = PIECE) -> int:
    """Tail of the last ``n`` bases."""
    best, length = 1e-9, 0
    for at, score in _ends(seq, n, piece):
        left = score + COST_LEAVE
        if at + len(score) == n:
            left[-1] = score[-1]  # a path that is all tail never leaves it
        k = int(left.argmax())
        if left[k] > best:
            best, length = float(left[k]), at + k + 1
    return length


def _read_tail(seq: str, first: int, step: int, piece: int = 4096) -> int:
    """Tail of the last ``first`` bases, these growing by ``step`` for as long as they are all tail."""
    most, at_best = 1e-9, first
    if first <= 0 or first > len(seq):
        return _tail(seq, min(max(first, 0), len(seq)))
    for at, score in _ends(seq, len(seq), piece):
        before = np.maximum.accumulate(np.append(most, score[:-1] + COST_LEAVE))
        whole = score > before  # the last k bases are all tail
        while at_best <= at + len(score) and whole[at_best - at - 1]:
            at_best += step
        if at_best <= at + len(score):
            break
        most = max(most, float(before[-1]), float(score[-1] + COST_LEAVE))
    return _tail(seq, min(at_best, len(seq)))


def tail_length(seq: Column) -> Column:
    """Length of the A tail at the end of ``seq``."""

    @F.pandas_udf(T.IntegerType())
    def tails(seqs):
        import pandas as pd

        return pd.Series([None if x is None else _tail(x, len(x)) for x in seqs], dtype="Int32")

    return tails(seq)


def read_tail_length(seq: Column, suffix_length: Column, step: int = 50) -> Column:
    """Tail of a read's suffix, the suffix growing by ``step`` for as long as it is all tail."""

    @F.pandas_udf(T.IntegerType())
    def tails(seqs, firsts):
        import pandas as pd

        return pd.Series([None if x is None or pd.isna(n) else _read_tail(x, int(n), step) for x, n in zip(seqs, firsts)], dtype="Int32")

    return tails(seq, suffix_length)
