"""Matched clips are told within tasks: what is dealt are the ends and the exons themselves, once, whatever the band."""

import contextlib
import io
import random

import pytest

from readloom.operators import correction
from readloom.plans import file_queries as FQ
from readloom.plans import queries as Q


def _plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as said:
        df.explain("formatted")
    return said.getvalue()


@pytest.fixture(scope="module")
def scattered(spark):
    """Exons that end on both sides of the stretches' bounds, on two chromosomes, some with odd letters, and reads near these ends that spell them in either case."""
    rng = random.Random(3)
    exons, seqs, reads = [], [], []
    for i in range(240):
        strand, chrom, end = rng.choice("+-"), rng.choice(["c1", "c2"]), 1024 * rng.randrange(1, 3) + rng.randrange(-3, 4)
        spans = [(end - 200, end - 150), (end - 100, end), (end + 50 + i % 3, end + 90)] if strand == "+" else [(end - 90, end - 50 - i % 3), (end, end + 100), (end + 150, end + 200)]
        text = rng.choice(["ACGTACGTACGT", "ACGTTTTTTTTT", "acgtaNNéTACG", "CCCACGTACGTA"])
        exons += [(f"t{i}", k, chrom, strand, a, b) for k, (a, b) in enumerate(spans)]
        seqs += [(f"t{i}", k, text) for k in range(3)]
        off = rng.randrange(-3, 1)
        at = end + off if strand == "+" else end - off
        clip, body = "TGT"[: -off] + text[: rng.randrange(6, 13)], "G" * 60
        turned = clip[::-1].translate(str.maketrans("ACGT", "TGCA"))
        seq, cigar, pos = (turned + body, f"{len(clip)}S60=", at + 1) if strand == "-" else (body + clip, f"60={len(clip)}S", at - 59)
        reads.append((f"r{i}", f"r{i}_PerID1.000_5Clip0_3Clip{len(clip)}_PolyA0", 16 if strand == "-" else 0, chrom, pos, cigar, seq))
    return (
        spark.createDataFrame(reads, "read_id string, name string, flag int, chrom string, pos long, cigar string, seq string"),
        spark.createDataFrame(exons, "tx string, exon_no long, chrom string, strand string, s long, e long"),
        spark.createDataFrame(seqs, "tx string, exon_no long, seq string"),
    )


@pytest.mark.parametrize("batch", [10_000, 7])
def test_bounds_of_stretches_and_batches(scattered, spark, batch, monkeypatch):
    monkeypatch.setattr(correction, "PAIRS", 50)
    every = correction.clip_matches(*scattered).where("matched")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = sorted(map(tuple, correction.matched_clips(*scattered).select(*every.columns).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = sorted(map(tuple, every.collect()), key=repr)
    assert got == want and len(want) > 300 and len({r[6] for r in want}) > 3


def test_ends_and_exons_are_not_spread_over_the_band(scattered, spark, sf_dir):
    """neither side has a row for every place of the band, and exons, ends and reads come from one shuffle of the line items."""
    assert "sequence(-3, 3" not in _plan(correction.matched_clips(*scattered))
    plan = _plan(Q.cigar_extend(spark, sf_dir))
    assert "sequence(-3, 3" not in plan and plan.split("\n\n")[0].count("Join") == 1


def test_variants_ask_the_matches_alone(scattered, spark, sf_dir):
    """no read is joined again for its CIGAR."""
    assert "Join" not in _plan(FQ.reads_with_variants(spark, sf_dir)).split("\n\n")[0]
    reads, *rest = scattered
    n = correction.several_variants(correction.extend(reads, correction.matched_clips(*scattered))).first().n_reads
    assert correction.several_corrections(correction.matched_clips(*scattered, more=("cigar",))).first().n_reads == n > 5


def test_exons_with_their_sequences(scattered):
    reads, exons, seqs = scattered
    own = exons.join(seqs, ["tx", "exon_no"])
    told = lambda *inputs: sorted(map(tuple, correction.report(*inputs).collect()), key=repr)
    assert told(reads, own, None) == told(*scattered)


def test_report_joins_two_times(spark, sf_dir):
    """reads that match with the rest, and ends with exons; all else comes with the rows."""
    assert _plan(FQ.correction_report(spark, sf_dir)).split("\n\n")[0].count("Join") == 2
