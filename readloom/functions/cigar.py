"""CIGAR strings as arrays of (n, op): parsing, sums, statistics and intron-spanning extension."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .frames import bytes_of

OPS = "=XIDNSH"
_BAD = "CIGAR needs = and X instead of M: "


def parse(cigar: Column) -> Column:
    """array<struct<n: int, op: string>>; a CIGAR with M (or any other symbol) is an error, as it hides mismatches."""
    cigar = F.when(cigar.rlike(rf"^([0-9]+[{OPS}])*$"), cigar).when(cigar.isNull(), None).otherwise(F.raise_error(F.concat(F.lit(_BAD), cigar)))
    return F.transform(F.regexp_extract_all(cigar, F.lit(rf"[0-9]+[{OPS}]"), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, "^[0-9]+", 0).cast("int").alias("n"), F.right(x, F.lit(1)).alias("op")))


def render(ops: Column) -> Column:
    return F.array_join(F.transform(ops, lambda o: F.concat(o["n"].cast("string"), o["op"])), "")


def total(ops: Column, symbols: str) -> Column:
    """Summed lengths of the operations in ``symbols``."""
    return F.aggregate(ops, F.lit(0).cast("long"), lambda acc, o: acc + F.when(o["op"].isin(*symbols), o["n"]).otherwise(0))


def reference_span(ops: Column) -> Column:
    return total(ops, "=XDN")


def identity(ops: Column) -> Column:
    """Matches over aligned columns (introns aside); null without aligned columns."""
    return F.try_divide(total(ops, "=").cast("double"), total(ops, "=XID").cast("double"))


def clips(ops: Column) -> Column:
    """struct<left, right, hard_right>: clips before and after the first aligned operation, the last of each side."""
    start = F.struct(F.lit(0).cast("long").alias("aligned"), F.lit(0).cast("long").alias("left"), F.lit(0).cast("long").alias("right"), F.lit(False).alias("hard_right"))

    def step(acc, o):
        clip, inner = o["op"].isin("S", "H"), acc["aligned"] > 0
        return F.struct(
            (acc["aligned"] + F.when(o["op"].isin("=", "X", "I", "D"), o["n"]).otherwise(0)).cast("long").alias("aligned"),
            F.when(clip & ~inner, o["n"]).otherwise(acc["left"]).cast("long").alias("left"),
            F.when(clip & inner, o["n"]).otherwise(acc["right"]).cast("long").alias("right"),
            (acc["hard_right"] | (clip & inner & (o["op"] == "H"))).alias("hard_right"),
        )

    return F.aggregate(ops, start, step)


def end_site(pos: Column, ops: Column, strand: Column) -> Column:
    """The 1-based transcript end: the last reference base on +, the first on -."""
    return F.when(strand == "-", pos).otherwise(pos + reference_span(ops) - 1)


def _op(n: Column, op) -> Column:
    return F.struct(n.cast("int").alias("n"), (op if isinstance(op, Column) else F.lit(op)).alias("op"))


def extend_forward(ops: Column, gap: Column, length: Column, offset: Column) -> Column:
    """Turn ``length`` bases of the last clip into a match beyond an intron of ``gap``; ``offset`` bases move across the splice site."""
    n = F.size(ops)
    before, last = F.element_at(ops, -2), F.element_at(ops, -1)
    return F.concat(F.slice(ops, F.lit(1), F.greatest(n - 2, F.lit(0))), F.array(_op(before["n"] - offset, before["op"]), _op(gap + offset, "N"), _op(length, "="), _op(last["n"] - length + offset, last["op"])))


def extend_reverse(ops: Column, gap: Column, length: Column, offset: Column) -> Column:
    """The same at the first clip, for - strand reads; here the size of ``offset`` alone counts."""
    n, size = F.size(ops), F.abs(offset)
    first, second = F.element_at(ops, 1), F.element_at(ops, 2)
    return F.concat(F.array(_op(first["n"] - length + size, first["op"]), _op(length, "="), _op(gap + size, "N"), _op(second["n"] - size, second["op"])), F.slice(ops, F.lit(3), F.greatest(n - 2, F.lit(0))))


def aligned_blocks(pos: Column, ops: Column) -> Column:
    """array<struct<start, stop>> of 0-based blocks split at introns."""
    start = F.struct((pos - 1).cast("long").alias("at"), (pos - 1).cast("long").alias("begin"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("done"))

    def step(acc, o):
        skip, moves = o["op"] == "N", o["op"].isin("=", "X", "D")
        at = (acc["at"] + F.when(skip | moves, o["n"]).otherwise(0)).cast("long")
        block = F.array(F.struct(acc["begin"].alias("start"), acc["at"].alias("stop")))
        return F.struct(at.alias("at"), F.when(skip, at).otherwise(acc["begin"]).alias("begin"), F.when(skip & (acc["at"] > acc["begin"]), F.concat(acc["done"], block)).otherwise(acc["done"]).alias("done"))

    return F.aggregate(ops, start, step, lambda acc: F.when(acc["at"] > acc["begin"], F.concat(acc["done"], F.array(F.struct(acc["begin"].alias("start"), acc["at"].alias("stop"))))).otherwise(acc["done"]))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _measured(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Sums and clips of CIGARs in bytes; the fields of :func:`measures`."""
    op, digit = np.isin(data, np.frombuffer(OPS.encode(), np.uint8)), (data >= 48) & (data <= 57)
    at = np.flatnonzero(op)
    ends = np.searchsorted(at, bounds)  # operations before each CIGAR's first byte
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(ends))
    begin = np.maximum(np.concatenate([[0], at + 1])[: len(at)], bounds[row])
    width = at - begin
    bad = np.flatnonzero(~(op | digit))
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    open_ended = full[~op[bounds[1:][full] - 1]]
    if len(bad) or len(open_ended) or (width < 1).any():
        first = min([int(np.searchsorted(bounds, bad[0], side="right")) - 1] if len(bad) else [len(bounds)], open_ended[:1].tolist() or [len(bounds)], row[width < 1][:1].tolist() or [len(bounds)])[0]
        raise ValueError(_BAD + data[bounds[first] : bounds[first + 1]].tobytes().decode())
    n = np.zeros(len(at), np.int64)
    for k in range(int(width.max(initial=0))):
        n += np.where(k < width, (data[np.maximum(at - 1 - k, 0)] - 48).astype(np.int64) * 10 ** min(k, 18), 0)
        if k > 9 and (n > (1 << 31) - 1).any():
            break
    if (n > (1 << 31) - 1).any():
        raise ValueError("a CIGAR's operation is longer than an int")
    kind = data[at]
    is_ = lambda ops: np.isin(kind, np.frombuffer(ops.encode(), np.uint8))
    aligned = np.where(is_("=XID"), n, 0)
    before = np.concatenate([[0], np.cumsum(aligned)])
    before = before[:-1] - before[ends[row]]  # aligned columns before the operation
    clip, inner = is_("SH"), before > 0

    def last(flags):
        hit = np.flatnonzero(flags)
        k = np.searchsorted(hit, ends[1:])
        some = k > np.searchsorted(hit, ends[:-1])
        return np.where(some, n[hit[np.maximum(k - 1, 0)]], 0) if len(hit) else np.zeros(len(bounds) - 1, np.int64)

    some = ends[1:] > ends[:-1]
    return {
        "matches": _sums(np.where(is_("="), n, 0), ends),
        "aligned": _sums(aligned, ends),
        "span": _sums(np.where(is_("=XDN"), n, 0), ends),
        "left": last(clip & ~inner),
        "right": last(clip & inner),
        "hard_right": _sums((clip & inner & is_("H")).astype(np.int64), ends) > 0,
        "hard_left": np.where(some, np.append(kind, 0)[ends[:-1]] == ord("H"), False),
    }


def measures(cigar: Column) -> Column:
    """struct of the sums that ``identity`` and ``reference_span`` take (matches, aligned, span) and of ``clips``, in one pass over a column's bytes; null without a CIGAR.

    ``hard_left``: is the first operation a hard clip?
    """

    # Read by several columns and filters: not to be run for each.
    @F.arrow_udf("struct<matches: long, aligned: long, span: long, left: long, right: long, hard_right: boolean, hard_left: boolean>")
    def run(column: pa.Array) -> pa.Array:
        got = _measured(*bytes_of(column))
        return pa.StructArray.from_arrays([pa.array(x) for x in got.values()], names=list(got), mask=column.is_null() if column.null_count else None)

    return run.asNondeterministic()(cigar.cast("binary"))
