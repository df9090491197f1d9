"""Reads told apart by the barcodes at their ends."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import approximate as N

#: Reads and barcodes that are compared at once.
READS, PATTERNS = 4096, 256

_SIDE = "barcode{0} string, distance{0} int, second{0} int, end{0} int, length{0} int"


def _two_best(texts: list[str], width: int, names: list[str], patterns: list[str]):
    """For each text the best pattern's place, edits and end, and the edits of the second best; of ties the first in the list."""
    code, size = N.coded(texts, width)
    best = np.full(len(texts), 1 << 30)
    second, place, end = best.copy(), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for at in range(0, len(patterns), PATTERNS):
        edits, ends = N.infix_distances(code, size, patterns[at : at + PATTERNS])
        k = edits.argmin(axis=1)
        rows = np.arange(len(texts))
        own, own_end = edits[rows, k], ends[rows, k]
        edits[rows, k] = 1 << 30
        other = edits.min(axis=1)
        better = own < best
        second = np.where(better, np.minimum(best, other), np.minimum(second, own))
        best, place, end = np.where(better, own, best), np.where(better, at + k, place), np.where(better, own_end, end)
    return place, best, second, end


def demultiplex_reads(reads: DataFrame, barcodes: list[tuple[str, str]], id: str = "id", seq: str = "seq", slack: int = 12, least_score: int = 80, least_lead: int = 1) -> DataFrame:
    """All columns of ``reads`` (but those of the names given below) with the barcode at either end and the read's own stretch between them.

    ``barcodes`` are (name, bases), a kit's, of at most 64 bases. At the 5' end the barcode is looked for as it is, at the 3' end
    as its reverse complement, among the barcode's length and ``slack`` bases more, by least edits (insertions, deletions, substitutions)
    against any stretch. For each end: ``barcode``, ``distance`` (edits), ``second`` (edits of the next best barcode; null with one barcode), ``end``
    (bases up to the first end of the best stretch, from the read's own end) and ``length`` of the barcode.
    An end is told if its score, 100 * (length - distance) / length, is ``least_score`` at least and the next
    best has ``least_lead`` more edits. ``assigned`` is the barcode of the ends that are told, null if they disagree or none is; ``insert_start`` and
    ``insert_stop`` leave told barcodes out. Null reads are told nothing.
    """
    if not barcodes or len({n for n, _ in barcodes}) < len(barcodes):
        raise ValueError("barcodes need names of their own")
    names, patterns = [n for n, _ in barcodes], [p.upper() for _, p in barcodes]
    width = max(map(len, patterns)) + slack
    turned = str.maketrans("ACGTacgt", "TGCATGCA")

    fields = [tuple(x.split()) for side in "53" for x in _SIDE.format(side).split(", ")]

    @F.arrow_udf(", ".join(" ".join(x) for x in fields))
    def ends(heads: pa.Array, tails: pa.Array) -> pa.Array:
        columns: list[list] = [[] for _ in fields]
        for at in range(0, len(heads), READS):
            sides = heads.slice(at, READS).to_pylist(), [None if t is None else t.translate(turned)[::-1] for t in tails.slice(at, READS).to_pylist()]
            for k, texts in enumerate(sides):
                place, best, second, end = _two_best([t or "" for t in texts], width, names, patterns)
                for i, t in enumerate(texts):
                    alone = second[i] >= 1 << 30
                    got = (None,) * 5 if t is None else (names[place[i]], int(best[i]), None if alone else int(second[i]), int(end[i]), len(patterns[place[i]]))
                    for c, x in zip(columns[5 * k : 5 * k + 5], got):
                        c.append(x)
        kinds = {"string": pa.string(), "int": pa.int32()}
        return pa.StructArray.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields])

    # Only the ends of a read are passed to Python.
    s = F.col(seq)
    tail = F.when(F.length(s) <= width, s).otherwise(F.substring(s, F.lit(-width), F.lit(width)))
    made = {n for n, _ in fields} | {"assigned", "insert_start", "insert_stop"}
    own = [c for c in reads.columns if c not in made]
    got = reads.select(*own, ends(F.substring(s, F.lit(1), F.lit(width)), tail).alias("_found")).select(*own, "_found.*")
    told = {x: F.coalesce(((F.col(f"length{x}") - F.col(f"distance{x}")) * 100 >= F.col(f"length{x}") * least_score) & (F.coalesce(F.col(f"second{x}"), F.lit(1 << 30)) - F.col(f"distance{x}") >= least_lead), F.lit(False)) for x in "53"}
    assigned = F.when(told["5"] & told["3"], F.when(F.col("barcode5") == F.col("barcode3"), F.col("barcode5"))).when(told["5"], F.col("barcode5")).when(told["3"], F.col("barcode3"))
    start = F.when(s.isNotNull(), F.when(told["5"], F.col("end5")).otherwise(0))
    stop = F.greatest(F.length(s) - F.when(told["3"], F.col("end3")).otherwise(0), start)
    return got.withColumns({"assigned": assigned, "insert_start": start, "insert_stop": F.when(s.isNotNull(), stop)}).drop("length5", "length3")
