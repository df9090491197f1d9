"""Sequences, read-name metadata and identifiers as column expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .frames import STOP_CODONS, bytes_of, codon_numbers, codons


def reverse_complement(seq: Column, upper: bool = False) -> Column:
    """Keeps case unless ``upper``; letters other than A, C, G and T pass through."""
    return F.reverse(F.translate(F.upper(seq) if upper else seq, "ATGCatgc", "TACGtacg"))


def suffix(seq: Column, n: Column) -> Column:
    """The last n characters; the whole sequence if it is shorter."""
    return F.when(n >= F.length(seq), seq).when(n <= 0, "").otherwise(F.right(seq, n))


def clip_window(seq: Column, minus: Column, clip: Column, poly_a: Column, wiggle: int, literal_empty: bool = False) -> Column:
    """The 3' clip before its A tail with ``wiggle`` aligned bases.

    ``literal_empty`` returns the empty string on + without an A tail, as slicing up to -0 does.
    """
    begin = F.greatest(F.length(seq) - clip - poly_a - wiggle, F.lit(0))
    plus = F.substring(seq, begin + 1, F.greatest(F.length(seq) - poly_a - begin, F.lit(0)))
    if literal_empty:
        plus = F.when(poly_a == 0, "").otherwise(plus)
    return F.when(minus, F.substring(seq, poly_a + 1, clip + wiggle)).otherwise(plus)


def in_reading_direction(clip: Column, minus: Column) -> Column:
    return F.when(minus, reverse_complement(clip, upper=True)).otherwise(clip)


def cut_clip(clip: Column, wiggle: int, offset: Column) -> Column:
    """The clip (in reading direction) as it should begin the next exon when the splice sites differ by ``offset`` in reading direction."""
    return F.substring(clip, F.lit(wiggle + 1) - offset, F.lit(1 << 30))


def begins_with(exon: Column, clip: Column) -> Column:
    """Does the exon begin with the clip, whatever the case?"""
    return F.upper(clip) == F.upper(F.substring(exon, F.lit(1), F.length(clip)))


def bare_read_name(name: Column) -> Column:
    """Without the metadata that an earlier pass appended."""
    return F.regexp_replace(name, r"_PerID(?!.*_PerID).*$", "")


def read_name(name: Column, per_id: Column, clip5: Column, clip3: Column, poly_a: Column, poly_a_read: Column | None = None) -> Column:
    """Name with metadata; the read-level tail only where it was measured."""
    parts = [name, per_id, clip5, clip3, poly_a]
    pattern = "%s_PerID%1.3f_5Clip%d_3Clip%d_PolyA%d"
    return F.format_string(pattern, *parts) if poly_a_read is None else F.format_string(pattern + "_PolyARead%d", *parts, poly_a_read)


def name_field(name: Column, field: str) -> Column:
    """An integer of the metadata, such as 3Clip or PolyA; null without it."""
    got = F.regexp_extract(name, rf"_{field}([0-9]+)(?:_|$)", 1)
    return F.when(got != "", got.cast("int"))


def without_clip3(name: Column) -> Column:
    return F.regexp_replace(name, r"_3Clip[^_]*", "_3Clip0")


def orf_finder_id(name: Column, with_orf: bool = True) -> Column:
    """``tx_ORF.n [details]_ORFm`` to ``tx.pn_ORFm``."""
    head = F.replace(F.substring_index(name, "_[", 1), F.lit("_ORF."), F.lit(".p"))
    last = F.element_at(F.split(name, "_"), -1)
    return F.when(last.startswith("ORF") & name.contains("_["), F.concat(head, F.lit("_"), last)).otherwise(head) if with_orf else head


def canonical_id(name: Column) -> Column:
    """The transcript's id: without ``_ORFn``, then without ``.pN``."""
    return F.regexp_replace(F.regexp_replace(name, r"_ORF[0-9]+$", ""), r"\.p[0-9]+$", "")


def nested_number(name: Column) -> Column:
    got = F.regexp_extract(name, r"ORF([0-9]+)$", 1)
    return F.when(got == "", 0).otherwise(F.nullif(got, F.lit("")).cast("int"))


def coordinates(chrom: Column, start: Column, stop: Column, strand: Column) -> Column:
    return F.concat_ws("|", chrom, start.cast("string"), stop.cast("string"), strand)


def predictor_header(chrom: Column, start: Column, stop: Column, strand: Column, name: Column) -> Column:
    return F.format_string(">%s:%d-%d(%s)(%s)(0,0, )", chrom, start, stop, strand, name)


def stop_sites(seq: Column) -> Column:
    """Places (0-based) of all stop codons of a sequence in any frame, ascending, in one pass over its bytes; null without a sequence."""

    @F.arrow_udf("array<int>")
    def sites(column: pa.Array) -> pa.Array:
        buf, off = bytes_of(column)
        hit = np.flatnonzero(np.isin(codons(buf, off, False), codon_numbers(STOP_CODONS)))
        ends = np.searchsorted(hit, off)
        places = (hit - np.repeat(off[:-1], np.diff(ends))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(places), mask=column.is_null() if column.null_count else None)

    return sites(seq.cast("binary"))


def in_frame(sites: Column, start: Column) -> Column:
    """Of codon places those in frame with ``start`` (0-based), from there on."""
    return F.filter(sites, lambda i: (i >= start) & ((i - start) % 3 == 0))


def stop_positions(seq: Column, start: Column) -> Column:
    """In-frame stop codons from ``start`` (0-based) on."""
    return in_frame(stop_sites(seq), start)
