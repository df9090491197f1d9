"""Edit distance of short patterns within many texts at once: bit-parallel columns over a batch (Myers, 1999)."""

from __future__ import annotations

import numpy as np

LONGEST = 64
_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate("ACGT"):
    _CODE[[ord(_b), ord(_b.lower())]] = _i


def coded(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Base numbers (4: none), texts x ``width``, and the texts' lengths, at most ``width``."""
    size = np.array([min(len(t), width) for t in texts], np.int64)
    flat = np.frombuffer("".join(t[:width].ljust(width, "\n") for t in texts).encode("ascii", "replace"), np.uint8)
    return _CODE[flat].reshape(len(texts), width), size


def infix_distances(text: np.ndarray, size: np.ndarray, patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(least edits between each pattern and any stretch of each text, the first end of such a stretch): texts x patterns.

    A letter other than A, C, G and T matches nothing.
    """
    if any(not 0 < len(p) <= LONGEST for p in patterns):
        raise ValueError(f"patterns have 1 to {LONGEST} bases")
    m = np.array([len(p) for p in patterns], np.uint64)
    same = np.zeros((5, len(patterns)), np.uint64)
    for k, p in enumerate(patterns):
        for j, b in enumerate(p.upper()):
            if b in "ACGT":
                same["ACGT".index(b), k] |= np.uint64(1 << j)
    shape = (len(text), len(patterns))
    up, down = np.full(shape, ~np.uint64(0)), np.zeros(shape, np.uint64)  # vertical differences of +1 and -1
    now = np.broadcast_to(m.astype(np.int64), shape).copy()
    best, end = now.copy(), np.zeros(shape, np.int64)
    one, top = np.uint64(1), m - np.uint64(1)
    for j in range(text.shape[1]):
        equal = same[text[:, j]]
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(across | up), up & across
        now += ((rise >> top) & one).astype(np.int64) - ((fall >> top) & one).astype(np.int64)
        rise, fall = rise << one, fall << one
        diagonal = equal | down
        up, down = fall | ~(diagonal | rise), rise & diagonal
        better = (now < best) & (size > j)[:, None]
        best[better] = now[better]
        end[better] = j + 1
    return best, end
