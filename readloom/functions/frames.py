"""Open reading frames in bytes: codons are looked up once a base, and only stops and starts are handled one by one.

Positions are in reading direction within each row; a strand's six-frame structure is three groups of codons a
row. All rows of a batch go through together: a codon's group and place make one sortable number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# The stop codons and the usual start codon.
STOP_CODONS = ("TAA", "TAG", "TGA")
START_CODONS = ("ATG",)
KINDS = ("complete", "5-prime-partial", "3-prime-partial", "open")

_BASES = "ACGT"
_CODE = np.full(256, 64, np.int16)
for _i, _b in enumerate(_BASES):
    _CODE[[ord(_b), ord(_b.lower())]] = _i


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string or binary column without copying, and the bounds of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = np.int64 if "large" in str(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def codon_numbers(codons) -> np.ndarray:
    return np.array([sum(_BASES.index(b) * 4 ** (2 - k) for k, b in enumerate(c.upper())) for c in codons], np.int16)


def codons(data: np.ndarray, bounds: np.ndarray, reverse: bool) -> np.ndarray:
    """The codon (0 to 63) beginning at each base in genome order, on the other strand if ``reverse``; 64 and more where there is none.

    A letter other than A, C, G and T makes its codons none.
    """
    n = len(data)
    out = np.full(n, 64, np.int16)
    if n >= 3:
        c = _CODE[data]
        if reverse:
            c = np.where(c < 4, 3 - c, c)
            out[:-2] = c[2:] * 16 + c[1:-1] * 4 + c[:-2]
        else:
            out[:-2] = c[:-2] * 16 + c[1:-1] * 4 + c[2:]
        odd = c > 3
        out[:-2][odd[:-2] | odd[1:-1] | odd[2:]] = 64
    for back in (1, 2):  # codons that would leave their row
        at = bounds[1:] - back
        out[at[at >= bounds[:-1]]] = 64
    return out


@dataclass
class Frames:
    """Frames of a batch, in order of row, place and strand; places are 0-based on the given strand, half-open."""

    row: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    minus: np.ndarray
    frame: np.ndarray
    kind: np.ndarray
    n_codons: np.ndarray  # without a stop codon
    inner: list[np.ndarray]  # offsets in codons of the starts within


def _keys(hit: np.ndarray, bounds: np.ndarray, reverse: bool, wide: int) -> np.ndarray:
    """Sorted numbers of codons, given by their places in genome order: group (row and frame) * ``wide`` + place in reading direction."""
    row = np.searchsorted(bounds, hit, side="right") - 1
    place = bounds[row + 1] - 3 - hit if reverse else hit - bounds[row]
    return np.sort((3 * row + place % 3) * wide + place)


def _strand(data, bounds, reverse, starts, stops, min_length, partial5, partial3, include_stop):
    """(row, begin, end, frame, kind, number of codons, sorted start keys, key of the frame's begin) of one strand, in reading direction."""
    size = np.diff(bounds)
    wide = int(size.max(initial=0)) + 8
    value = codons(data, bounds, reverse)
    ends = _keys(np.flatnonzero(np.isin(value, stops)), bounds, reverse, wide)
    begins = _keys(np.flatnonzero(np.isin(value, starts)), bounds, reverse, wide)
    # A group's last segment has no stop: it ends at a place beyond all.
    row, frame = np.divmod(np.arange(3 * len(size)), 3)
    there = np.flatnonzero(size[row] - frame >= 3)
    ends = np.sort(np.concatenate([ends, there * wide + wide - 1]))
    group, end = np.divmod(ends, wide)
    row, frame = np.divmod(group, 3)
    stopped = end < wide - 1
    first = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
    begin = np.where(first, frame, np.append(0, end[:-1]) + 3)
    last = frame + (size[row] - frame) // 3 * 3  # after the last whole codon
    at = np.searchsorted(begins, group * wide + begin)
    found = at < len(begins)
    found[found] = begins[at[found]] < ends[found]
    begin = np.where(found, np.append(begins, 0)[np.minimum(at, len(begins))] - group * wide, begin)
    end = np.where(stopped, end + (3 if include_stop else 0), last)
    counted = (end - begin) // 3 - (stopped if include_stop else 0)
    kind = np.where(found, np.where(stopped, 0, 2), np.where(stopped, 1, 3))
    good = (found | (partial5 & first)) & (stopped | partial3) & (counted > 0) & (end - begin >= min_length)
    return tuple(x[good] for x in (row, begin, end, frame, kind, counted, group * wide)), begins


def find_frames(data: np.ndarray, bounds: np.ndarray, min_length: int = 100, partial5: bool = True, partial3: bool = True, include_stop: bool = True, starts=START_CODONS, stops=STOP_CODONS, least_inner: int = 30, least_share: float = 0.25) -> Frames:
    """Frames of at least ``min_length`` bases of all rows that ``bounds`` cuts ``data`` into.

    Between two stops of a frame the first start counts. Before a row's first stop of a frame a start may be missing
    (``partial5``), after its last one the stop (``partial3``); with both, a stretch without either is open. Inner
    starts leave at least ``least_inner`` codons and ``least_share`` of the frame's codons.
    """
    size = np.diff(bounds)
    found = []
    for reverse in (False, True):
        (row, begin, end, frame, kind, n, base), begins = _strand(data, bounds, reverse, codon_numbers(starts), codon_numbers(stops), min_length, partial5, partial3, include_stop)
        # Starts within a frame, from the second codon on; a sorted range of keys each.
        lo, hi = np.searchsorted(begins, base + begin + 3), np.searchsorted(begins, base + begin + 3 * n)
        count = hi - lo
        owner = np.repeat(np.arange(len(row)), count)
        offset = (begins[np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + lo[owner]] - (base + begin)[owner]) // 3
        left = n[owner] - offset
        fine = (left >= least_inner) & (left >= least_share * n[owner])
        inner = np.split(offset[fine], np.cumsum(np.bincount(owner[fine], minlength=len(row)))[:-1]) if len(row) else []
        place = (size[row] - end, size[row] - begin) if reverse else (begin, end)
        found.append((row, *place, np.full(len(row), reverse), frame, kind, n, inner))
    columns = [np.concatenate([a, b]) for a, b in list(zip(*found))[:-1]]
    inner = [*found[0][-1], *found[1][-1]]
    order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
    return Frames(*(c[order] for c in columns), inner=[inner[i] for i in order.tolist()])


# The standard genetic code, codons in the order of the bases A, C, G, T.
AMINO_ACIDS = "KNKNTTTTRSRSIIMIQHQHPPPPRRRRLLLLEDEDAAAAGGGGVVVV*Y*YSSSS*CWCLFLF"


def translate(data: np.ndarray) -> bytes:
    """The protein of whole codons in reading direction; X where a codon holds another letter, * at a stop."""
    n = len(data) // 3 * 3
    c = _CODE[data[:n]].reshape(-1, 3)
    letters = np.frombuffer((AMINO_ACIDS + "X").encode(), np.uint8)
    return letters[np.where((c < 4).all(axis=1), c @ np.array([16, 4, 1], np.int16), 64)].tobytes()


def spoken(data: np.ndarray, bounds: np.ndarray, frames: Frames) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all frames' proteins in a row, and their bounds; as :func:`translate` gives them, without the stop."""
    letters = np.frombuffer((AMINO_ACIDS + "X").encode(), np.uint8)
    ends = np.cumsum(frames.n_codons)
    owner = np.repeat(np.arange(len(frames.row)), frames.n_codons)
    codon = np.arange(len(owner)) - (ends - frames.n_codons)[owner]
    first = bounds[frames.row] + np.where(frames.minus, frames.stop - 3, frames.start)
    at = first[owner] + np.where(frames.minus, -3, 3)[owner] * codon
    value = np.where(frames.minus[owner], codons(data, bounds, True)[at], codons(data, bounds, False)[at])
    return letters[np.minimum(value, 64)], np.concatenate([[0], ends])
