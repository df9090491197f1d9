"""Exon-end correction: a clip that spells the next exon becomes an alignment across the intron."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import cigar as C
from ..functions import sequence as S
from ..functions.frames import bytes_of
from .intervals import band_join, end_position, internal_exons, neighbours
from .reads import strand_of


def _ends(reads: DataFrame, wiggle: int, cutoff: int, literal_empty: bool, *more: str) -> DataFrame:
    """Reads with a clip to place: their end, the clip in reading direction (the end's ``wiggle`` bases first), and the columns ``more``."""
    reads = reads.withColumns({"strand": strand_of(F.col("flag")), "_ops": C.parse(F.col("cigar")), "clip3": S.name_field(F.col("name"), "3Clip"), "poly_a": F.coalesce(S.name_field(F.col("name"), "PolyA"), F.lit(0))})
    reads = reads.where(F.col("clip3") >= cutoff)
    minus = F.col("strand") == "-"
    start = F.col("pos") - 1
    reads = reads.withColumns({"read_start": start, "read_stop": start + C.reference_span(F.col("_ops")), "_clip": S.clip_window(F.col("seq"), minus, F.col("clip3"), F.col("poly_a"), wiggle, literal_empty)})
    ends = reads.where("_clip <> ''").withColumns({"_end": F.when(minus, F.col("read_start")).otherwise(F.col("read_stop")), "_clip": S.in_reading_direction(F.col("_clip"), minus)})
    return ends.select("read_id", "strand", "chrom", F.col("_end").alias("pos"), "read_start", "read_stop", F.col("_clip").alias("clip"), *[F.col(c).alias(f"_{c}") for c in more])


def _targets(exons: DataFrame, exon_seqs: DataFrame | None) -> DataFrame:
    """Internal exons with the place and the sequence of the next one; without ``exon_seqs`` the exons hold their ``seq``."""
    columns = ("tx", "exon_no", "chrom", "strand", end_position().alias("pos"), "next_exon_no", "next_s", "next_e")
    if exon_seqs is None:
        inner = internal_exons(neighbours(exons, columns=("s", "e", "seq"))).where("next_exon_no is not null")
        return inner.select(*columns, F.col("next_seq").alias("exon_seq")).drop("next_exon_no")
    inner = internal_exons(neighbours(exons)).select(*columns)
    seqs = exon_seqs.select(F.col("tx").alias("_tx"), F.col("exon_no").alias("_no"), F.col("seq").alias("exon_seq"))
    return inner.join(seqs, (F.col("tx") == F.col("_tx")) & (F.col("next_exon_no") == F.col("_no"))).drop("_tx", "_no", "next_exon_no")


def _signed():
    """The offset in reading direction."""
    return F.when(F.col("strand") == "-", -F.col("offset")).otherwise(F.col("offset"))


def _begins(cutoff: int):
    return F.coalesce((F.length("clip") > cutoff) & S.begins_with(F.col("x_exon_seq"), F.col("clip")), F.lit(False))


def _told(hits: DataFrame, matched, *more: str) -> DataFrame:
    return hits.select("read_id", "strand", "chrom", "read_start", "read_stop", "clip", "offset", F.col("x_tx").alias("tx"), F.col("x_exon_no").alias("exon_no"), F.col("x_next_s").alias("next_s"), F.col("x_next_e").alias("next_e"), matched.alias("matched"), *more)


def clip_matches(reads: DataFrame, exons: DataFrame, exon_seqs: DataFrame | None, wiggle: int = 3, cutoff: int = 4, literal_empty: bool = False) -> DataFrame:
    """Reads ending at internal exons, with the clip, the next exon and whether the clip begins it (``matched``).

    reads: read_id (unique), name with metadata, flag, chrom, pos, cigar, seq. exons: tx, exon_no,
    chrom, strand, s, e. exon_seqs: tx, exon_no, seq (reading direction); None if the exons hold their seq. All hits are rows, so there are as many as
    reads times exons at one place; where only matched ones count, ``matched_clips`` makes no others.
    """
    hits = band_join(_ends(reads, wiggle, cutoff, literal_empty), _targets(exons, exon_seqs), wiggle).withColumn("offset", _signed())
    hits = hits.withColumn("clip", S.cut_clip(F.col("clip"), wiggle, F.col("offset")))
    return _told(hits, _begins(cutoff))


#: Positions of a stretch of the genome, whose ends and exons are dealt together.
STRETCH = 1 << 10
#: Pairs that are looked at together, at most (those of one end aside).
PAIRS = 1 << 18


def _met(wiggle: int, size: int, schema: pa.Schema):
    """Ends and exons, in the order of ``at``, to those whose place and whose first ``size`` letters are the same: what a task does, batch by batch.

    An exon comes before the ends that it accepts (``at`` is an end's last place that an exon may have) and is held until
    they have passed.
    """

    def heads(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        out = np.zeros(len(begin), np.uint64)
        for k in range(size):
            out = out * np.uint64(1_000_003) + data[np.minimum(begin + k, max(len(data) - 1, 0))]
        return out

    def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, bounds = bytes_of(column.cast(pa.binary()))
        return np.where((data >= 97) & (data <= 122), data - 32, data).astype(np.uint64) if len(data) else np.zeros(1, np.uint64), bounds

    mixed = lambda line, place, head: (head * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F) + line.astype(np.uint64)

    def run(batches):
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            rows = (new if held is None else pa.concat_tables([held, new])).combine_chunks()
            line = rows.column("line").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            line = line + (rows.column("stretch").to_numpy() << 16)  # a task may hold two stretches, and an exon in both
            at, is_end = rows.column("at").to_numpy(), rows.column("is_end").to_numpy()
            data, bounds = letters(rows.column("head").combine_chunks())
            exon, end = np.flatnonzero(~is_end), np.flatnonzero(is_end)
            exon = exon[bounds[exon + 1] - bounds[exon] >= size]
            key = mixed(line[exon], at[exon], heads(data, bounds[exon]))
            order = np.argsort(key, kind="stable")
            exon, key = exon[order], key[order]
            minus = rows.column("minus").to_numpy()[end]
            for off in range(-wiggle, wiggle + 1) if len(exon) and len(end) else ():
                signed = np.where(minus, -off, off)
                begin = bounds[end] + wiggle - signed
                some = np.flatnonzero(bounds[end + 1] - begin >= size)
                place = at[end[some]] - wiggle - off
                own = mixed(line[end[some]], place, heads(data, begin[some]))
                lo, hi = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
                full = np.flatnonzero(hi > lo)
                some, lo, n, place = some[full], lo[full], (hi - lo)[full], place[full]
                cuts = np.cumsum(n)
                a = 0
                while a < len(n):
                    b = max(int(np.searchsorted(cuts, (cuts[a - 1] if a else 0) + PAIRS, "right")), a + 1)
                    which = np.repeat(np.arange(a, b), n[a:b])
                    i = end[some[which]]
                    j = exon[np.arange(len(which)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b]) + lo[which]]
                    true = (line[i] == line[j]) & (at[j] == place[which])  # keys are digests
                    i, j, which = i[true], j[true], which[true]
                    if len(i):
                        told = [rows.column("line").take(pa.array(i)), rows.column("end").take(pa.array(i)), rows.column("exon").take(pa.array(j)), pa.chunked_array([pa.array(signed[some[which]], pa.int32())])]
                        yield from pa.table(told, schema=schema).to_batches()
                    a = b
            # Later ends accept exons from the last row's place, less both sides of the band, on.
            held = rows.filter(pa.array(~is_end & (line == line[-1]) & (at >= at[-1] - 2 * wiggle))) if len(at) else held

    return run


def matched_clips(reads: DataFrame, exons: DataFrame, exon_seqs: DataFrame | None, wiggle: int = 3, cutoff: int = 4, literal_empty: bool = False, more: tuple[str, ...] = ()) -> DataFrame:
    """The matched rows of ``clip_matches``, found by place and by the clip's first bases together, with the reads' columns ``more`` as ``_*``.

    A clip that counts is longer than ``cutoff``, so its first ``cutoff`` + 1 bases are those of the exon: hits that spell
    something else are never made, however many exons end at one place. Ends and exons are dealt once, by stretches of the genome, and
    sorted by place; the offsets, which would make several rows of each, are told apart within tasks.
    """
    size = max(cutoff + 1, 0)
    plain = lambda c: F.regexp_replace(c, "[^\\x00-\\x7f]", "?")
    line = F.concat_ws("\t", "strand", "chrom").alias("line")
    ends, targets = _ends(reads, wiggle, cutoff, literal_empty, *more), _targets(exons, exon_seqs)
    end = F.struct("read_id", "read_start", "read_stop", "clip", *[f"_{c}" for c in more])
    exon = F.struct("tx", "exon_no", "next_s", "next_e", "exon_seq")
    ends = ends.select(line, (F.col("pos") + wiggle).cast("long").alias("at"), F.lit(True).alias("is_end"), F.coalesce(F.col("strand") == "-", F.lit(False)).alias("minus"), plain("clip").alias("head"), end.alias("end"), "chrom", "strand")
    targets = targets.select(line, F.col("pos").cast("long").alias("at"), F.lit(False).alias("is_end"), F.lit(False).alias("minus"), plain(F.substring("exon_seq", 1, size)).alias("head"), exon.alias("exon"), "chrom", "strand")
    placed = ["line", "at", "is_end", "minus", "head"]
    known = lambda df: df.where("chrom is not null and strand is not null and at is not null and head is not null")
    stretch = lambda c: F.floor(c / STRETCH)
    ends = known(ends).select(*placed, "end", F.lit(None).cast(targets.schema["exon"].dataType).alias("exon"), stretch(F.col("at")).alias("stretch"))
    near = F.sequence(stretch(F.col("at")), stretch(F.col("at") + 2 * wiggle))
    targets = known(targets).select(*placed, F.lit(None).cast(ends.schema["end"].dataType).alias("end"), "exon", F.explode(near).alias("stretch"))
    rows = ends.unionByName(targets).repartition("line", "stretch").sortWithinPartitions("line", "stretch", "at", "is_end")
    told = rows.select("line", "end", "exon", F.lit(0).alias("offset"))
    met = rows.mapInArrow(_met(wiggle, size, to_arrow_schema(told.schema)), told.schema)
    where = F.split("line", "\t", 2)
    own = [F.col(f"end.{c}").alias(c) for c in ends.schema["end"].dataType.names]
    met = met.select(where[0].alias("strand"), where[1].alias("chrom"), *own, *[F.col(f"exon.{c}").alias(f"x_{c}") for c in targets.schema["exon"].dataType.names], "offset")
    met = met.withColumn("clip", S.cut_clip(F.col("clip"), wiggle, F.col("offset"))).where(_begins(cutoff))
    return _told(met, F.lit(True), *[f"_{c}" for c in more])


def counters(reads: DataFrame, exons: DataFrame, exon_seqs: DataFrame | None, wiggle: int = 3, cutoff: int = 4) -> DataFrame:
    """One row: n_hits, n_matched, n_off_end (hits beside the exon's end) and clip_bases of the matched, as ``observed`` counts them.

    Hits are counted place by place, ends times exons, without making them.
    """
    place = ("chrom", "strand", "pos")
    ends = _ends(reads, wiggle, cutoff, False).groupBy(*place).agg(F.count("*").alias("n"))
    met = band_join(ends, _targets(exons, exon_seqs).groupBy(*place).agg(F.count("*").alias("n")), wiggle)
    pairs = F.col("n") * F.col("x_n")
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    hits = met.agg(total(pairs).alias("n_hits"), total(F.when(F.col("offset") != 0, pairs)).alias("n_off_end"))
    matched = matched_clips(reads, exons, exon_seqs, wiggle, cutoff).agg(F.count("*").alias("n_matched"), total(F.length("clip")).alias("clip_bases"))
    return hits.crossJoin(matched).select("n_hits", "n_matched", "n_off_end", "clip_bases")


def _gaps():
    """The intron that a hit reaches over, on + and on -."""
    return F.col("next_s") - F.col("read_stop"), F.col("read_start") - F.col("next_e")


def _corrected(ops, size, strand: str = "strand"):
    """The corrected CIGAR of a hit whose clip has ``size`` bases."""
    forward, reverse = _gaps()
    return C.render(F.when(F.col(strand) == "-", C.extend_reverse(ops, reverse, size, F.col("offset"))).otherwise(C.extend_forward(ops, forward, size, F.col("offset"))))


def extend(reads: DataFrame, matches: DataFrame, how: str = "inner") -> DataFrame:
    """Corrected alignments: every read with each of its distinct corrected CIGARs, the first primary, later ones flagged secondary (256).

    With ``how`` "left" the reads without a matched hit are there too, as they were.
    """
    hits = matches.where("matched").select("read_id", F.col("strand").alias("_strand"), "read_start", "read_stop", F.length("clip").alias("_len"), "offset", "tx", "exon_no", "next_s", "next_e")
    rows = reads.join(hits, "read_id", how).withColumn("_ops", C.parse(F.col("cigar")))
    hit, minus = F.col("_strand").isNotNull(), F.col("_strand") == "-"
    shift = _gaps()[1] + F.when(F.col("offset") < 0, 1).otherwise(0) + F.col("_len")
    rows = rows.withColumns({"cigar": F.when(hit, _corrected(F.col("_ops"), F.col("_len"), "_strand")).otherwise(F.col("cigar")), "pos": F.when(minus, F.col("pos") - shift).otherwise(F.col("pos")), "name": F.when(hit, S.without_clip3(F.col("name"))).otherwise(F.col("name"))})
    first = W.partitionBy("read_id", "cigar").orderBy("tx", "exon_no")
    rows = rows.withColumn("_k", F.row_number().over(first)).where((F.col("_k") == 1) | ~hit)
    order = W.partitionBy("read_id").orderBy("tx", "exon_no", "cigar")
    rows = rows.withColumn("_rank", F.row_number().over(order))
    flag = F.when(hit & (F.col("_rank") > 1), F.when(minus, 272).otherwise(256)).otherwise(F.col("flag"))
    return rows.withColumn("flag", flag.cast("int")).select(*reads.columns)


def correct(reads: DataFrame, exons: DataFrame, exon_seqs: DataFrame | None, wiggle: int = 3, cutoff: int = 4) -> DataFrame:
    """Corrected alignments and, as they were, all others."""
    return extend(reads, matched_clips(reads, exons, exon_seqs, wiggle, cutoff), "left")


def exons_of_reads(matches: DataFrame) -> DataFrame:
    """(read_id, exons): the exons, ``tx#exon_no`` in order, that each read's clip reaches over to."""
    exon = F.struct("tx", "exon_no")
    return matches.where("matched").groupBy("read_id").agg(F.transform(F.array_sort(F.collect_set(exon)), lambda x: F.concat_ws("#", x["tx"].cast("string"), x["exon_no"].cast("string"))).alias("exons"))


#: What a report tells of the hits: those off the exon's end, all matched and unmatched ones, reads with an unmatched hit, reads renamed by their matched
#: clip, corrected alignments, and corrections that repeat another one of the read.
KINDS = ("wiggle", "hit_true", "hit_false", "discarded", "matched_clip", "corrected", "collapsed")


def report(reads: DataFrame, exons: DataFrame, exon_seqs: DataFrame | None, wiggle: int = 3, cutoff: int = 4) -> DataFrame:
    """Everything there is to say about the hits: kind, read_id, tx, exon_no, clip, offset, name, flag, pos, cigar.

    What orders the hits of a read is told of the matched ones, which are few. All others are told as ends and exons meet, without
    being shuffled, sorted or kept: exons are ranked at the places they accept, and a read's first unmatched hit is the one
    that only matched hits of the read precede there.
    """
    exon = lambda p: F.struct(F.col(f"{p}tx").alias("tx"), F.col(f"{p}exon_no").alias("exon_no"))
    matched = matched_clips(reads, exons, exon_seqs, wiggle, cutoff, more=("name", "flag", "pos", "cigar")).where("read_id is not null")
    known = matched.groupBy("read_id").agg(F.sort_array(F.collect_set(exon(""))).alias("_known"))
    ends = _ends(reads, wiggle, cutoff, False, "name", "flag", "pos", "cigar").join(known, "read_id", "left")
    # The clip and the exon as the hits compare them, told once: no text is made for a hit that differs at once.
    upper = F.upper("clip")
    ends = ends.withColumns({"_text": F.when(F.length(upper) == F.length("clip"), upper), "_size": F.length("clip")})
    targets = _targets(exons, exon_seqs).withColumn("text", F.upper("exon_seq"))
    wide = targets.select(*[F.col(c).alias(f"x_{c}") for c in targets.columns]).withColumn("offset", F.explode(F.sequence(F.lit(-wiggle), F.lit(wiggle)))).withColumn("x_at", F.col("x_pos") + F.col("offset")).drop("x_pos", "x_next_s", "x_next_e")
    wide = wide.withColumn("x_rank", F.row_number().over(W.partitionBy("x_chrom", "x_strand", "x_at").orderBy("x_tx", "x_exon_no")))
    hits = ends.join(wide, (ends.chrom == wide.x_chrom) & (ends.strand == wide.x_strand) & (ends["pos"] == wide["x_at"])).withColumn("offset", _signed())
    own = S.cut_clip(F.col("_text"), wiggle, F.col("offset"))
    likely = (F.greatest(F.col("_size") - wiggle + F.col("offset"), F.lit(0)) > cutoff) & F.coalesce(F.startswith("x_text", own), F.lit(True))
    hits = hits.withColumn("clip", S.cut_clip(F.col("clip"), wiggle, F.col("offset"))).where(~(likely & _begins(cutoff)))
    place = F.array_position(F.sort_array(F.array_append("_known", exon("x_"))), exon("x_"))
    first = F.when(F.col("_known").isNull(), F.col("x_rank") == 1).when(F.col("x_rank") <= F.size("_known") + 1, place == F.col("x_rank")).otherwise(F.lit(False))
    told = lambda *kinds: F.array(*map(F.lit, kinds))
    kinds = F.when(F.col("offset") == 0, F.when(first, told("hit_false", "discarded")).otherwise(told("hit_false"))).when(first, told("wiggle", "hit_false", "discarded")).otherwise(told("wiggle", "hit_false"))
    others = hits.select(F.explode(kinds).alias("kind"), "read_id", F.col("x_tx").alias("tx"), F.col("x_exon_no").alias("exon_no"), "clip", "offset", F.col("_name").alias("name"), F.col("_flag").cast("int").alias("flag"), F.col("_pos").cast("long").alias("pos"), F.col("_cigar").alias("cigar"))
    return _matched_lines(matched).unionByName(others)


def _matched_lines(matched: DataFrame) -> DataFrame:
    """What a report tells of matched hits, which hold their read's columns; one shuffle by read serves all the orders within it."""
    own = [F.col(f"_{c}").alias(c) for c in ("name", "flag", "pos", "cigar")]
    rows = matched.select("read_id", *own, F.col("strand").alias("_strand"), "read_start", "read_stop", "clip", "offset", "tx", "exon_no", "next_s", "next_e").repartition("read_id").withColumn("_ops", C.parse(F.col("cigar")))
    minus, size = F.col("_strand") == "-", F.length("clip")
    shift = _gaps()[1] + F.when(F.col("offset") < 0, 1).otherwise(0) + size
    rows = rows.withColumns({"_cigar": _corrected(F.col("_ops"), size, "_strand"), "_pos": F.when(minus, F.col("pos") - shift).otherwise(F.col("pos"))})
    at = ("tx", "exon_no")
    rows = rows.withColumns({"_same": F.row_number().over(W.partitionBy("read_id", "_cigar").orderBy(*at)), "_last": F.row_number().over(W.partitionBy("read_id").orderBy(*[F.desc(c) for c in at]))})
    rows = rows.withColumn("_rank", F.row_number().over(W.partitionBy("read_id").orderBy((F.col("_same") > 1).asc(), *at, "_cigar")))
    flag = F.when(F.col("_rank") > 1, F.when(minus, 272).otherwise(256)).otherwise(F.col("flag")).cast("int")

    def line(kind, when, name=None, flag=None, changed=False):
        values = (F.lit(kind).alias("kind"), (F.col("name") if name is None else name).alias("name"), (F.col("flag") if flag is None else flag).cast("int").alias("flag"), F.col("_pos" if changed else "pos").cast("long").alias("pos"), F.col("_cigar" if changed else "cigar").alias("cigar"))
        return F.when(when, F.struct(*values))

    bare = S.without_clip3(F.col("name"))
    lines = F.array(
        line("wiggle", F.col("offset") != 0),
        line("hit_true", F.lit(True)),
        line("matched_clip", F.col("_last") == 1, F.concat_ws("_", "name", "clip")),
        line("corrected", F.col("_same") == 1, bare, flag, True),
        line("collapsed", F.col("_same") > 1, bare, F.col("flag"), True),
    )
    return rows.select("read_id", "tx", "exon_no", "clip", "offset", F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("x")).select("x.kind", "read_id", "tx", "exon_no", "clip", "offset", "x.name", "x.flag", "x.pos", "x.cigar")


def observed(matches: DataFrame, name: str = "correction") -> tuple[DataFrame, Observation]:
    """``matches``, counted as they pass: n_hits, n_matched, n_off_end (hits beside the exon's end) and clip_bases of the matched.

    With Spark 4.1 a session that has observed anything can no longer run tasks that hold the session itself, as Spark ML's
    models do (seen: ObservationManager is not serializable); a session that also scores should observe in ``newSession()``.
    """
    seen = Observation(name)
    matched = F.col("matched").cast("long")
    counted = matches.observe(seen, F.count("*").alias("n_hits"), F.coalesce(F.sum(matched), F.lit(0)).alias("n_matched"), F.coalesce(F.sum((F.col("offset") != 0).cast("long")), F.lit(0)).alias("n_off_end"), F.coalesce(F.sum(F.when(F.col("matched"), F.length("clip"))), F.lit(0)).cast("long").alias("clip_bases"))
    return counted, seen


def several_corrections(matches: DataFrame) -> DataFrame:
    """What ``several_variants`` tells of the corrected alignments, from matches with the reads' ``_cigar``: the reads are not asked again."""
    rows = matches.where("matched and read_id is not null").select("read_id", _corrected(C.parse(F.col("_cigar")), F.length("clip")).alias("cigar"))
    return rows.groupBy("read_id").agg(F.min("cigar").alias("a"), F.max("cigar").alias("b")).where("a <> b").agg(F.count("*").alias("n_reads"))


def several_variants(corrected: DataFrame) -> DataFrame:
    """How many reads have more than one corrected alignment."""
    return corrected.groupBy("read_id").count().where("count > 1").agg(F.count("*").alias("n_reads"))
