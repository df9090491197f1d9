"""Joins where many rows lie at one place of the genome."""

import contextlib
import io
import itertools
import random

import pytest
from pyspark.sql import functions as F

from readloom.operators import correction, intervals
from readloom.sources import sinks


@pytest.fixture(scope="module")
def crowd(spark):
    """200 transcripts of three exons whose second ones end within six bases of each other, each with a read that spells the third one (some from two bases before the end on) or nothing."""
    spelled = ["".join(x) for x in itertools.islice(itertools.product("ACGT", repeat=6), 0, 4000, 20)]
    exons, seqs, reads = [], [], []
    for i, own in enumerate(spelled):
        end, strand = 300 + i % 4, "+" if i % 3 else "-"
        spans = [(100, 150), (200, end), (400, 460)] if strand == "+" else [(100, 150), (600 - end, 600), (700, 760)]
        exons += [(f"t{i}", k, "chr1", strand, a, b) for k, (a, b) in enumerate(spans)]
        seqs += [(f"t{i}", k, (own + "GATTAC") if k != 1 else "TTTT") for k in range(3)]
        early = 2 * (i % 4 == 1)
        clip = "CC"[:early] + own + "GATTAC" if i % 5 else "CCCCCCCCCCCC"
        body, turned = "G" * (60 - early), clip[::-1].translate(str.maketrans("ACGT", "TGCA"))
        start = 601 - end + early if strand == "-" else end - 59
        seq, cigar = (turned + body, f"{len(clip)}S{len(body)}=") if strand == "-" else (body + clip, f"{len(body)}={len(clip)}S")
        reads.append((f"r{i}", f"r{i}_PerID1.000_5Clip0_3Clip{len(clip)}_PolyA0", 16 if strand == "-" else 0, "chr1", start, cigar, seq))
    return (
        spark.createDataFrame(reads, "read_id string, name string, flag int, chrom string, pos long, cigar string, seq string"),
        spark.createDataFrame(exons, "tx string, exon_no long, chrom string, strand string, s long, e long"),
        spark.createDataFrame(seqs, "tx string, exon_no long, seq string"),
    )


def _plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as said:
        df.explain("formatted")
    return said.getvalue()


def test_matched_hits_are_all_there(crowd):
    every = correction.clip_matches(*crowd).cache()
    theirs = sorted(map(tuple, every.where("matched").select(*every.columns).collect()), key=repr)
    ours = correction.matched_clips(*crowd)
    assert sorted(map(tuple, ours.select(*every.columns).collect()), key=repr) == theirs
    assert 100 < len(theirs) < every.count() / 20 and len({r[6] for r in theirs}) > 1


def test_corrections_join_by_the_clips_first_bases(crowd):
    """No join by place alone, which makes the square of the reads at a place, stands behind the corrected alignments."""
    plan = _plan(correction.correct(*crowd))
    assert "head" in plan and not [x for x in plan.split("Left keys") if "strand" in x.split("\n")[0] and "head" not in x.split("\n")[0]]


def test_counters_are_those_of_the_hits(crowd, spark):
    own = spark.newSession()  # see ``observed``
    reads, exons, seqs = (own.createDataFrame(df.collect(), df.schema) for df in crowd)
    hits, seen = correction.observed(correction.clip_matches(reads, exons, seqs), "crowd")
    assert hits.count() > 5000
    assert correction.counters(*crowd).first().asDict() == seen.get
    none = correction.counters(crowd[0].limit(0), *crowd[1:]).first()
    assert tuple(none) == (0, 0, 0, 0)


def test_report_of_a_crowd(crowd, spark, tmp_path):
    """Kinds against all hits, ordered read by read; and the report as files, read back."""
    rows = correction.report(*crowd).collect()
    by_kind = lambda k: sorted((r.read_id, r.tx, r.exon_no) for r in rows if r.kind == k)
    hits = correction.clip_matches(*crowd).collect()
    key = lambda r: (r.read_id, r.tx, r.exon_no)
    good, bad = sorted(key(r) for r in hits if r.matched), sorted(key(r) for r in hits if not r.matched)
    assert by_kind("hit_true") == good and by_kind("hit_false") == bad
    assert by_kind("wiggle") == sorted(key(r) for r in hits if r.offset)
    assert by_kind("discarded") == [next(g) for _, g in itertools.groupby(bad, lambda x: x[0])]
    assert by_kind("matched_clip") == [list(g)[-1] for _, g in itertools.groupby(good, lambda x: x[0])]
    assert sorted(by_kind("corrected") + by_kind("collapsed")) == good
    # Some reads' first hit is matched, so that their first unmatched one is not the first at its place.
    firsts = {k: next(g) for k, g in itertools.groupby(sorted(good + bad), lambda x: x[0])}
    assert any(firsts[x[0]] in set(good) for x in by_kind("discarded"))
    sinks.write_kinds(correction.report(*crowd), str(tmp_path / "report"))
    f = F.split("value", "\t")
    back = spark.read.text(str(tmp_path / "report")).select("kind", f[0], f[1], f[2].cast("long"), f[7].cast("long"), f[8])
    assert sorted(map(tuple, back.collect())) == sorted((r.kind, r.read_id, r.tx, r.exon_no, r.pos, r.cigar) for r in rows)


def test_overlaps_of_a_crowd(spark):
    """Many spans of all lengths in one bin: the pairs are those of a plain join, and few others are looked at."""
    rng = random.Random(7)
    rows = [("c", "+", s := rng.randint(-50, 2500), s + max(1, int(1.01 ** rng.randint(0, 800))), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "chrom string, strand string, start long, stop long, id long")
    for least in (0.5, 0.8, 1.0):
        got = [tuple(r) for r in intervals.reciprocal_overlaps(df, df, least, 1 << 11).select("a_id", "b_id", "overlap_bp").collect()]
        want = {(a[4], b[4], ov) for a in rows for b in rows if (ov := min(a[3], b[3]) - max(a[2], b[2])) > 0 and ov >= least * (a[3] - a[2]) and ov >= least * (b[3] - b[2])}
        assert len(got) == len(set(got)) and set(got) == want
        if least == 0.8:
            a, b = intervals._alike(*[df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns]) for p in "ab"], least)
            met = a.join(b, (F.col("a_size") == F.col("b_size")) & (F.col("a_cell") == F.col("b_cell"))).count()
            assert met < 8 * len(want) < len(rows) ** 2 / 5
