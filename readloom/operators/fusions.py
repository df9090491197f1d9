"""Reads that join genes: which loci a read's blocks touch, and what kind of join that is.

Loci are the connected parts of the graph of genes that overlap on one strand. Against the genes' blocks a read has, for each
locus it touches, a support (bases shared with the locus' best gene) and may share a block's end with it. A locus is strong if
it has the least share of the read's bases and a block's end is the same. The kinds:

- ``free``: at most one locus touched;
- ``fusions``: two strong loci or more;
- ``fakes``: one strong locus, and others that are touched weakly;
- ``review``: several loci, none of them strong.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

KINDS = ("free", "fusions", "review", "fakes")


def loci(genes: DataFrame) -> DataFrame:
    """Genes (gene, chrom, strand, start, stop) with ``locus``, ``chrom|strand|start`` of the first gene of the genes that overlap in a chain.

    Spans that only touch don't overlap. The window is a chromosome's genes: an annotation, not reads.
    """
    order = W.partitionBy("chrom", "strand").orderBy("start", "stop", "gene")
    before = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    first = F.when(before.isNull() | (F.col("start") >= before), F.col("start"))
    at = F.last(first, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return genes.withColumn("locus", F.concat_ws("|", "chrom", "strand", at.cast("string")))


#: Pairs of blocks that are looked at together, at most (those of one read aside).
PAIRS = 1 << 20


def _blocks(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of a column of lists of (start, stop)."""
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), column.value_lengths().to_numpy()), flat.field(0).to_numpy(), flat.field(1).to_numpy()


def _overlapping(a_start, a_stop, b_start, b_stop) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the pairs lie that overlap: for each a the range of ``b`` (ordered by start) that begins in it, for each b that of ``a`` (ordered) that begins in it later."""
    return np.searchsorted(b_start, a_start, "left"), np.searchsorted(b_start, a_stop, "left"), np.searchsorted(a_start, b_start, "right"), np.searchsorted(a_start, b_stop, "left")


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) for all places of each row's range."""
    n = np.maximum(hi - lo, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]


def _touched(size: int, schema: pa.Schema):
    """Reads (id, bases, blocks) and genes (locus, blocks) of one bin of ``size`` bases to (read, bases, locus, support, shared): what a task does, in numpy.

    Both come whole to every bin that a block of theirs touches; a pair is told in the bin of its first shared base.
    """

    def run(reads: pa.Table, genes: pa.Table) -> pa.Table:
        if not reads.num_rows or not genes.num_rows:
            return schema.empty_table()
        bin_no = reads.column("bin")[0].as_py()
        read, a_start, a_stop = _blocks(reads.column("blocks").combine_chunks())
        gene, b_start, b_stop = _blocks(genes.column("blocks").combine_chunks())
        locus = genes.column("locus").combine_chunks().dictionary_encode()
        names, of_gene = locus.dictionary, locus.indices.to_numpy().astype(np.int64)
        order = np.argsort(b_start, kind="stable")
        gene, b_start, b_stop = gene[order], b_start[order], b_stop[order]
        # Reads in the order of their ids; as many at a time as make a portion of pairs.
        n = np.searchsorted(b_start, a_stop, "left") - np.searchsorted(np.sort(b_stop), a_start, "right")
        ends = np.cumsum(np.bincount(read, n, reads.num_rows))
        out = []
        first = 0
        while first < reads.num_rows:
            last = max(int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")), first + 1)
            i, j = np.searchsorted(read, [first, last])
            mine = i + np.argsort(a_start[i:j], kind="stable")
            r, s, e = read[mine], a_start[mine], a_stop[mine]
            lo, hi, lo2, hi2 = _overlapping(s, e, b_start, b_stop)
            (x, y), (y2, x2) = _spread(lo, hi), _spread(lo2, hi2)
            x, y = np.concatenate([x, x2]), np.concatenate([y, y2])
            if len(x):
                begin = np.maximum(s[x], b_start[y])
                pair = r[x] * genes.num_rows + gene[y]
                by = np.argsort(pair, kind="stable")
                edge = np.flatnonzero(np.concatenate([[True], np.diff(pair[by]) != 0]))
                bases = np.add.reduceat((np.minimum(e[x], b_stop[y]) - begin)[by], edge)
                same = np.logical_or.reduceat(((s[x] == b_start[y]) | (e[x] == b_stop[y]))[by], edge)
                own = np.minimum.reduceat(begin[by], edge) // size == bin_no
                r, g = np.divmod(pair[by][edge][own], genes.num_rows)
                key, bases, same = r * len(names) + of_gene[g], bases[own], same[own]
                by = np.argsort(key, kind="stable")
                if len(by):
                    edge = np.flatnonzero(np.concatenate([[True], np.diff(key[by]) != 0]))
                    r, l = np.divmod(key[by][edge], len(names))
                    out.append((r, l, np.maximum.reduceat(bases[by], edge), np.logical_or.reduceat(same[by], edge)))
            first = last
        if not out:
            return schema.empty_table()
        r, l, support, shared = (np.concatenate(x) for x in zip(*out))
        told = reads.select(["read", "bases"]).take(pa.array(r))
        return pa.table([told.column("read"), told.column("bases"), names.take(pa.array(l)), pa.array(support), pa.array(shared)], schema=schema)

    return run


def _size():
    return F.sum(F.greatest(F.col("stop") - F.col("start"), F.lit(0)))


def touched_loci(reads: DataFrame, genes: DataFrame, bin_size: int = 1 << 14) -> DataFrame:
    """(read, bases, locus, support, shared) of blocks (read, chrom, strand, start, stop) against blocks (gene, chrom, strand, start, stop); a read's size as ``bases``.

    A read and a gene meet whole, in the bins of the genome that their blocks touch, and are summed up there: what
    leaves a task is one row a read and locus (and bin), never one a pair, which would be the square of those at one place.
    """
    block = F.struct(F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"))
    full = lambda blocks: F.filter(blocks, lambda b: b["stop"] > b["start"])
    whole = reads.groupBy("read").agg(_size().alias("bases"), F.collect_list(F.struct("chrom", "strand", block.alias("block"))).alias("_all"))
    spans = genes.groupBy("gene", "chrom", "strand").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.collect_list(block).alias("blocks"))
    placed = loci(spans).where("gene is not null").select("chrom", "strand", "locus", full("blocks").alias("blocks"))
    lines = F.array_distinct(F.transform("_all", lambda b: F.struct(b["chrom"].alias("chrom"), b["strand"].alias("strand"))))
    on_line = F.transform(F.filter("_all", lambda b: (b["chrom"] == F.col("line.chrom")) & (b["strand"] == F.col("line.strand"))), lambda b: b["block"])
    own = whole.where("read is not null").select("read", "bases", "_all", F.explode(lines).alias("line")).select("read", "bases", "line.chrom", "line.strand", full(on_line).alias("blocks"))

    def dealt(df: DataFrame) -> DataFrame:
        touched = F.transform("blocks", lambda b: F.sequence(F.floor(b["start"] / bin_size), F.floor((b["stop"] - 1) / bin_size)))
        return df.where("chrom is not null and strand is not null").withColumn("bin", F.explode(F.array_distinct(F.flatten(touched))))

    a, b = dealt(own), dealt(placed)
    key = ("chrom", "strand", "bin")
    schema = a.select("read", "bases", F.lit("").alias("locus"), F.lit(0).cast("long").alias("support"), F.lit(True).alias("shared")).schema
    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(_touched(bin_size, to_arrow_schema(schema)), schema)


def classify(reads: DataFrame, genes: DataFrame, least_share: float = 0.1, bin_size: int = 1 << 14) -> DataFrame:
    """One row per read: read, kind, n_loci, n_strong and the touched loci in order. Reads that touch no gene are free."""
    met = touched_loci(reads, genes, bin_size)
    every = reads.select("read").distinct().select("read", *[F.lit(None).cast(met.schema[c].dataType).alias(c) for c in met.columns[1:]])
    # Dealt once for both groupings; reads that touch nothing are there by a row without a locus.
    met = met.unionByName(every).repartition("read").groupBy("read", "locus").agg(F.max("bases").alias("bases"), F.max("support").alias("support"), F.bool_or("shared").alias("shared"))
    strong = F.col("shared") & (F.col("support") >= F.lit(least_share) * F.col("bases"))
    out = met.groupBy("read").agg(F.count("locus").alias("n_loci"), F.coalesce(F.sum(strong.cast("long")), F.lit(0)).alias("n_strong"), F.array_sort(F.collect_list("locus")).alias("loci"))
    kind = F.when(F.col("n_loci") < 2, "free").when(F.col("n_strong") > 1, "fusions").when(F.col("n_strong") == 1, "fakes").otherwise("review")
    return out.select("read", kind.alias("kind"), "n_loci", "n_strong", "loci")
