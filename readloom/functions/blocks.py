"""Block algebra on BED rows: coordinates and trimming, as column expressions.

A row has start, stop, thick_start, thick_stop, block_lens, block_starts (relative to start)
and strand. Block ends are inclusive on both sides: the position just after a block counts as in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(lens: Column) -> Column:
    return F.aggregate(lens, F.lit(0).cast("long"), lambda a, x: a + x)


def _first(flags: Column) -> Column:
    """0-based place of the first true; null without."""
    at = F.array_position(flags, True)
    return F.when(at > 0, at.cast("int") - 1)


def in_block(pos: Column, start: Column, stop: Column, lens: Column | None = None, starts: Column | None = None) -> Column:
    """Is a genomic position in the span, and (with blocks) in a block?"""
    span = (pos >= start) & (pos <= stop)
    if lens is None:
        return span
    return span & F.exists(F.arrays_zip(starts.alias("s"), lens.alias("n")), lambda b: (pos >= start + b["s"]) & (pos <= start + b["s"] + b["n"]))


def base_block(pos: Column, lens: Column) -> Column:
    """struct<block, rest>: the first block reaching base ``pos`` of the exonic sequence; (-1, -1) beyond the end."""
    start = F.struct(F.lit(0).alias("i"), pos.cast("long").alias("left"), F.lit(-1).alias("block"), F.lit(-1).cast("long").alias("rest"))

    def step(acc, n):
        here = (acc["block"] < 0) & (acc["left"] <= n)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            (acc["left"] - n).alias("left"),
            F.when(here, acc["i"]).otherwise(acc["block"]).alias("block"),
            F.when(here, acc["left"]).otherwise(acc["rest"]).alias("rest"),
        )

    return F.aggregate(lens, start, step, lambda acc: F.struct(acc["block"].alias("block"), acc["rest"].alias("rest")))


def genomic_to_block(pos: Column, start: Column, lens: Column, starts: Column) -> Column:
    """struct<block, delta> of a position in a block; null in an intron or outside."""
    ends = F.transform(F.arrays_zip(starts.alias("s"), lens.alias("n")), lambda b: start + b["s"] + b["n"])
    at = _first(F.transform(ends, lambda e: e >= pos))
    delta = pos - start - F.get(starts, at)
    return F.when(delta >= 0, F.struct(at.alias("block"), delta.alias("delta")))


def block_to_genomic(pos: Column, start: Column, lens: Column, starts: Column) -> Column:
    """Genomic position of base ``pos`` of the exonic sequence in genome order; null beyond the end."""
    b = base_block(pos, lens)
    return F.when(b["block"] >= 0, start + F.get(starts, b["block"]) + b["rest"])


def genomic_to_sequence(pos: Column, start: Column, lens: Column, starts: Column, strand: Column) -> Column:
    b = genomic_to_block(pos, start, lens, starts)
    forward = total(F.slice(lens, F.lit(1), b["block"])) + b["delta"]
    return F.when(strand == "-", total(lens) - forward).otherwise(forward)


def sequence_to_genomic(pos: Column, start: Column, lens: Column, starts: Column, strand: Column) -> Column:
    return block_to_genomic(F.when(strand == "-", total(lens) - pos).otherwise(pos), start, lens, starts)


def _kept(left: Column, right: Column) -> Column:
    """Blocks (s, n) between exonic bases ``left`` and ``right`` in genome order, in one pass; where nothing is between, one empty block at the cut.

    At the left end the cut is the end of the block that it falls on.
    """
    zipped = F.arrays_zip(F.col("block_starts").alias("s"), F.col("block_lens").alias("n"))
    none = F.array().cast("array<struct<s:bigint,n:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def step(acc, b):
        end = acc["at"] + b["n"]
        lo, hi = F.greatest(acc["at"], left), F.least(end, right)
        piece = F.struct((b["s"] + lo - acc["at"]).cast("long").alias("s"), F.greatest(hi - lo, F.lit(0)).cast("long").alias("n"))
        empty = (left >= right) & (F.size(acc["out"]) == 0) & (left <= end)
        return F.struct(end.cast("long").alias("at"), F.when((hi > lo) | empty, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def trim_ends(df: DataFrame, from5: Column, from3: Column, by_strand: bool = True) -> DataFrame:
    """Rows without ``from5`` exonic bases at the 5' end and ``from3`` at the 3' end (the left and the right one unless ``by_strand``); none if <= 0.

    ``trim_error`` says why a row could not be trimmed (its blocks are then null).
    """
    changed = ("start", "stop", "thick_start", "thick_stop", "block_lens", "block_starts")
    minus = (F.col("strand") == "-") if by_strand else F.lit(False)
    cut5, cut3 = F.greatest(from5.cast("long"), F.lit(0)), F.greatest(from3.cast("long"), F.lit(0))
    # Under names of their own, each bound once: inside lambdas a column that the same projection replaces may resolve to its new value.
    df = df.withColumns({"_left": F.when(minus, cut3).otherwise(cut5), "_right": F.when(minus, cut5).otherwise(cut3), "_total": total(F.col("block_lens"))})
    df = df.withColumns({"_over": F.col("_left") + F.col("_right") > F.col("_total"), "_cut": (F.col("_left") > 0) | (F.col("_right") > 0)})
    df = df.withColumn("_kept", F.when(F.col("_cut") & ~F.col("_over"), _kept(F.col("_left"), F.col("_total") - F.col("_right"))))
    first, last = F.get("_kept", F.lit(0)), F.element_at("_kept", -1)
    df = df.withColumns({"_shift": first["s"], "_end": F.col("start") + last["s"] + last["n"]})
    new_start = F.col("start") + F.col("_shift")
    new = {
        "start": new_start,
        "stop": F.when(F.col("_right") > 0, F.col("_end")).otherwise(F.col("stop")),
        "thick_start": F.when(F.col("_left") > 0, F.greatest("thick_start", new_start)).otherwise(F.col("thick_start")),
        "thick_stop": F.when(F.col("_right") > 0, F.least("thick_stop", "_end")).otherwise(F.col("thick_stop")),
        "block_lens": F.transform("_kept", lambda b: b["n"]),
        "block_starts": F.transform("_kept", lambda b: b["s"] - F.col("_shift")),
    }
    kinds = {c: df.schema[c].dataType for c in changed}
    df = df.withColumns({f"_new_{c}": F.when(F.col("_over"), F.lit(None)).when(F.col("_cut"), new[c]).otherwise(F.col(c)).cast(kinds[c]) for c in changed} | {"trim_error": F.when(F.col("_over"), "trims more than there is")})
    df = df.withColumns({c: F.col(f"_new_{c}") for c in changed}).withColumn("block_count", F.size("block_lens"))
    return df.drop("_left", "_right", "_total", "_over", "_cut", "_kept", "_shift", "_end", *(f"_new_{c}" for c in changed))


def trim_downstream(df: DataFrame, bp: Column, by_strand: bool = True) -> DataFrame:
    """Cut ``bp`` exonic bases off the 3' end (off the right end unless ``by_strand``); none if bp <= 0."""
    return trim_ends(df, F.lit(0), bp, by_strand)


def trim_upstream(df: DataFrame, bp: Column, by_strand: bool = True) -> DataFrame:
    """Cut ``bp`` exonic bases off the 5' end."""
    return trim_ends(df, bp, F.lit(0), by_strand)


def trim_to_position(df: DataFrame, pos: Column, downstream: bool) -> DataFrame:
    """Trim up to a genomic position: what lies downstream (or upstream) of it goes. A position outside the blocks is an error."""
    place = genomic_to_sequence(pos, F.col("start"), F.col("block_lens"), F.col("block_starts"), F.col("strand"))
    df = df.withColumn("_place", place)
    bp = F.coalesce(total(F.col("block_lens")) - F.col("_place") if downstream else F.col("_place"), F.lit(0))
    out = trim_downstream(df, bp) if downstream else trim_upstream(df, bp)
    return out.withColumn("trim_error", F.when(F.col("_place").isNull(), "position is in no block").otherwise(F.col("trim_error"))).drop("_place")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds) of a list column without nulls."""
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]].astype(np.int64), off - off[0]


def _nth(flags: np.ndarray, bounds: np.ndarray, n: int = 0, last: bool = False) -> np.ndarray:
    """Place of the n-th (or last) true among the values of each row; -1 without."""
    hit = np.append(np.flatnonzero(flags), -1)
    lo, hi = np.searchsorted(hit[:-1], bounds[:-1]), np.searchsorted(hit[:-1], bounds[1:])
    at = hi - 1 if last else lo + n
    return np.where((at >= lo) & (at < hi), hit[np.clip(at, 0, len(hit) - 1)], -1)


def frames_end(minus, start, stop, lens, starts, stops, begin, end, permitted) -> np.ndarray:
    """Whole columns of numpy and (values, bounds) at a time: does the frame from the projection's start end where the projection does?

    ``permitted`` holds the permitted stop's place, -1 for none and -2 for an unknown one.
    """
    (n, bounds), (s, _), (sites, held) = lens, starts, stops
    row, entry = np.repeat(np.arange(len(start)), np.diff(bounds)), np.where(minus, end, begin)
    sums = np.concatenate([[0], np.cumsum(n)])
    before, total = sums[:-1] - sums[bounds[row]], sums[bounds[1:]] - sums[bounds[:-1]]
    left = start[row] + s
    pos = np.where(minus, end, begin + 1)
    inside = (pos >= start) & (pos <= stop) & (_nth((pos[row] >= left) & (pos[row] <= left + n), bounds) >= 0)
    if not len(n):
        return np.zeros(len(start), bool)
    block = _nth(left + n >= entry[row], bounds)
    delta = entry - left[block]
    first = np.where(minus, total - before[block] - delta, before[block] + delta)
    known = (block >= 0) & (delta >= 0) & (first >= 0)
    of = np.repeat(np.arange(len(start)), np.diff(held))
    frame = known[of] & (sites >= first[of]) & ((sites - first[of]) % 3 == 0)
    # The permitted stop aside, the second one ends the frame; on -, the first is passed over before that rule.
    other = frame & (sites != permitted[of]) & (permitted[of] > -2)
    later = other.copy()
    tolerated = _nth(frame, held)
    later[tolerated[tolerated >= 0]] = False
    ended = np.where(minus, _nth(later, held), _nth(other, held, 1))
    ended = np.where(ended >= 0, ended, _nth(frame, held, last=True))
    k = np.append(sites, 0)[ended]
    k = np.where(minus, total - k, k)
    block = _nth(k[row] - before <= n, bounds)
    edge = left[block] + k - before[block]
    return inside & (ended >= 0) & (block >= 0) & np.where(minus, edge - 3 == begin, edge + 3 == end)


def frame_ends_at(start: Column, stop: Column, lens: Column, starts: Column, strand: Column, stops: Column, begin: Column, end: Column, permitted: Column | None = None) -> Column:
    """:func:`frames_end` of columns; false where one is null (an unknown permitted stop leaves the last stop in frame; a negative one is none)."""

    @F.arrow_udf("boolean")
    def ends(minus: pa.Array, start: pa.Array, stop: pa.Array, lens: pa.Array, starts: pa.Array, stops: pa.Array, begin: pa.Array, end: pa.Array, permitted: pa.Array) -> pa.Array:
        rows = pa.table([minus, start, stop, lens, starts, stops, begin, end, permitted], names=list("abcdefghi"))
        whole = np.ones(len(rows), bool)
        for column in rows.columns:
            whole &= column.is_valid().to_numpy()
        out = np.zeros(len(rows), bool)
        if whole.any():
            a, b, c, d, e, f, g, h, i = (x.combine_chunks() for x in rows.filter(pa.array(whole)).columns)
            flat = [x.to_numpy(zero_copy_only=False) for x in (a, b, c, g, h, i)]
            out[whole] = frames_end(*flat[:3], _lists(d), _lists(e), _lists(f), *flat[3:])
        return pa.array(out)

    minus = F.coalesce(strand == "-", F.lit(False))
    long = lambda x: x.cast("long")
    return ends(minus, long(start), long(stop), lens, starts, stops, long(begin), long(end), F.lit(-1).cast("long") if permitted is None else F.when(permitted.isNull(), -2).otherwise(F.greatest(long(permitted), F.lit(-1))).cast("long"))
