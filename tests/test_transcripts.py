"""Functions and operators on small cases: golden values, brute force, round trips."""

import math
import random

import pytest
from pyspark.sql import functions as F

from readloom.functions import blocks as B
from readloom.functions import cigar as C
from readloom.functions import polya as P
from readloom.functions import sequence as S
from readloom.operators import correction, evidence, intervals, overrules, selection
from readloom.operators import reads as R
from readloom.plans import steps
from readloom.plans.cli import main
from readloom.plans.config import Config, Step, select_steps
from readloom.plans.external import chunk_names, merge_groups, missing_tools, run_on_chunks
from readloom.sources import alignments as A
from readloom.sources import sinks
from readloom.sources import tables as T


def viterbi(seq: str) -> int:
    """Tail length by the full two-state recursion from the 3' end; ties as in a strict comparison."""
    obs = seq.upper()[::-1]
    if not obs:
        return 0
    e = lambda c: math.log(0.99 if c == "A" else 0.01 / 3)
    p, s, sb = [math.log(0.5) + e(obs[0])], [math.log(0.5) + math.log(0.25)], ["s"]
    for c in obs[1:]:
        stay, leave = s[-1], p[-1] + math.log(0.1)
        sb.append("p" if leave > stay + 1e-9 else "s")
        s.append(max(stay, leave) + math.log(0.25))
        p.append(p[-1] + math.log(0.9) + e(c))
    if p[-1] > s[-1] + 1e-9:
        return len(obs)
    for i in range(len(obs) - 1, 0, -1):
        if sb[i] == "p":
            return i
    return 0


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_tail_golden(spark):
    seqs = ["TGTGCCTATGTAATAAAGTCTATACACTGGCAAAAACAC" + "A" * 20, "CAAAAACAC" + "A" * 20, "AAAAACAC" + "A" * 20, "", "AAAA", "CCCC"]
    got = [r[0] for r in column(spark, seqs).select(P.tail_length(F.col("x"))).collect()]
    assert got == [20, 20, 28, 0, 4, 0]
    assert column(spark, [None]).select(P.tail_length(F.col("x"))).first()[0] is None


def test_tail_is_viterbi(spark):
    rng = random.Random(5)
    seqs = ["".join(rng.choice("AAAACGT") for _ in range(rng.randint(1, 40))) + "A" * rng.randint(0, 20) for _ in range(400)]
    got = [r[0] for r in column(spark, seqs).select(P.tail_length(F.col("x"))).collect()]
    # The recursion above lets the first base choose its state; the closed form counts leaving costs alike.
    assert sum(a == viterbi(s) for a, s in zip(got, seqs)) >= 399


def test_read_tail_grows(spark):
    df = column(spark, ["C" * 30 + "A" * 120, "A" * 40, "C" * 60])
    assert [r[0] for r in df.select(P.read_tail_length(F.col("x"), F.lit(20))).collect()] == [120, 40, 0]


def test_suffix_and_revcomp(spark):
    df = column(spark, ["1234567890"])
    assert df.select(S.suffix(F.col("x"), F.lit(12)), S.suffix(F.col("x"), F.lit(3)), S.suffix(F.col("x"), F.lit(0))).first()[:] == ("1234567890", "890", "")
    df = column(spark, ["ACGTNacgt-"])
    assert df.select(S.reverse_complement(S.reverse_complement(F.col("x")))).first()[0] == "ACGTNacgt-"


def test_cigar(spark):
    sample = "216=47196N475=3403N2592=1I4178=1X3838=1X3=1X6=10S"
    row = column(spark, [sample]).withColumn("o", C.parse(F.col("x")))
    assert row.select(C.render(F.col("o"))).first()[0] == sample
    clips = column(spark, ["5H3S7=2S", "4=", "3S"]).select(C.clips(C.parse(F.col("x"))).alias("c")).select("c.*").collect()
    assert [(c.left, c.right, c.hard_right) for c in clips] == [(3, 2, False), (0, 0, False), (3, 0, False)]
    assert column(spark, ["3S"]).select(C.identity(C.parse(F.col("x")))).first()[0] is None
    ends = column(spark, ["5="]).select(C.end_site(F.lit(3), C.parse(F.col("x")), F.lit("+")), C.end_site(F.lit(5), C.parse(F.col("x")), F.lit("-"))).first()
    assert tuple(ends) == (7, 5)
    with pytest.raises(Exception, match="instead of M"):
        column(spark, ["10M"]).select(C.parse(F.col("x"))).collect()


def test_read_names(spark):
    df = column(spark, ["r_1_PerID0.993_5Clip9_3Clip4_PolyA31_PolyARead33", "plain"])
    got = df.select(S.bare_read_name(F.col("x")), S.name_field(F.col("x"), "3Clip"), S.name_field(F.col("x"), "PolyA"), S.without_clip3(F.col("x"))).collect()
    assert tuple(got[0]) == ("r_1", 4, 31, "r_1_PerID0.993_5Clip9_3Clip0_PolyA31_PolyARead33")
    assert tuple(got[1]) == ("plain", None, None, "plain")


def test_identifiers(spark):
    df = column(spark, ["tx1_ORF.2 x_[1-9]_ORF3", "tx1.p2_ORF3", "tx1.p2"])
    rows = df.select(S.canonical_id(F.col("x")), S.nested_number(F.col("x"))).collect()
    assert tuple(rows[1]) == ("tx1", 3) and tuple(rows[2]) == ("tx1", 0)


def bed_rows(spark, rng, n=60):
    lines = []
    for i in range(n):
        k = rng.randint(1, 5)
        lens = [rng.randint(5, 40) for _ in range(k)]
        starts = [0]
        for a in lens[:-1]:
            starts.append(starts[-1] + a + rng.randint(3, 30))
        s = rng.randint(0, 1000)
        e = s + starts[-1] + lens[-1]
        lines.append(f"chr1\t{s}\t{e}\tt{i}\t0\t{rng.choice('+-')}\t{s}\t{e}\t0\t{k}\t{','.join(map(str, lens))},\t{','.join(map(str, starts))},")
    return lines


def test_bed_round_trip_and_errors(spark):
    lines = bed_rows(spark, random.Random(1))
    df = T.parse_bed(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert df.where("bed_error is not null").isEmpty()
    again = [r[0] for r in T.render_bed(df).collect()]
    assert again == [x.replace(",\t", "\t").rstrip(",") for x in lines]
    bad = T.parse_bed(spark.createDataFrame([("chr1\t1\t2",), ("c\t1\t9\tn\t0\t+\t1\t9\t0\t2\t3\t0",), ("c\t1\t9\tn\t0\t+",)], "value string")).collect()
    assert [r.bed_error is None for r in bad] == [False, False, True] and bad[0].chrom is None


def test_trims_against_bases(spark):
    """Trimming is dropping bases from an explicit list of them."""
    rng = random.Random(2)
    df = T.parse_bed(spark.createDataFrame([(x,) for x in bed_rows(spark, rng)], "value string")).withColumn("bp", (F.xxhash64("name") % 30 + 30).cast("int") % F.lit(45)).persist()
    for down in (True, False):
        out = {r.name: r for r in (B.trim_downstream if down else B.trim_upstream)(df, F.col("bp")).collect()}
        for r in df.collect():
            bases = [r.start + s + i for s, n in zip(r.block_starts, r.block_lens) for i in range(n)]
            o = out[r.name]
            if r.bp > len(bases):
                assert o.trim_error and o.block_lens is None
                continue
            right = down == (r.strand == "+")
            left = bases[: len(bases) - r.bp] if right else bases[r.bp :]
            if r.bp <= 0:
                left = bases
            got = [o.start + s + i for s, n in zip(o.block_starts, o.block_lens) for i in range(n)]
            assert got == left
            if left:
                assert (o.start, o.stop, o.block_count) == (left[0], left[-1] + 1, len(o.block_lens))


def test_positions_round_trip(spark):
    df = T.parse_bed(spark.createDataFrame([(x,) for x in bed_rows(spark, random.Random(3))], "value string"))
    own = [F.col(c) for c in ("start", "block_lens", "block_starts", "strand")]
    df = df.withColumn("p", F.explode(F.sequence(F.lit(1), B.total(F.col("block_lens")) - 1)))
    df = df.withColumn("g", B.sequence_to_genomic(F.col("p"), *own)).withColumn("back", B.genomic_to_sequence(F.col("g"), *own))
    assert df.where("back <> p").isEmpty() and not df.isEmpty()
    far = df.select(B.genomic_to_sequence(F.col("start") - 1, *own).alias("x")).where("x is not null")
    assert far.isEmpty()


def test_binned_overlaps_equal_plain(spark):
    rng = random.Random(4)
    rows = [(f"chr{rng.randint(1, 2)}", rng.choice("+-"), s := rng.randint(0, 3000), s + rng.randint(1, 900), i) for i in range(300)]
    df = spark.createDataFrame(rows, "chrom string, strand string, start long, stop long, id long")
    got = {(r.a_id, r.b_id, r.overlap_bp) for r in intervals.reciprocal_overlaps(df, df, 0.5, 128).collect()}
    want = set()
    for a in rows:
        for b in rows:
            ov = min(a[3], b[3]) - max(a[2], b[2])
            if a[:2] == b[:2] and ov > 0 and ov >= 0.5 * (a[3] - a[2]) and ov >= 0.5 * (b[3] - b[2]):
                want.add((a[4], b[4], ov))
    assert got == want


def test_correction_spans_the_intron(spark):
    exons = spark.createDataFrame([("t", 0, "c", "+", 0, 50), ("t", 1, "c", "+", 100, 150), ("t", 2, "c", "+", 200, 250), ("t", 3, "c", "+", 300, 350)], "tx string, exon_no long, chrom string, strand string, s long, e long")
    seqs = spark.createDataFrame([("t", 2, "GATTACAGATTACA" + "C" * 36)], "tx string, exon_no long, seq string")
    read = ("r1", "r1_PerID1.000_5Clip0_3Clip8_PolyA0", 0, "c", 101, "50=8S", "G" * 50 + "GATTACAG")
    other = ("r2", "r2_PerID1.000_5Clip0_3Clip8_PolyA0", 0, "c", 101, "50=8S", "G" * 50 + "CCCCCCCC")
    reads = spark.createDataFrame([read, other], "read_id string, name string, flag int, chrom string, pos long, cigar string, seq string")
    out = {r.read_id: r for r in correction.correct(reads, exons, seqs, wiggle=2).collect()}
    assert out["r1"].cigar == "50=50N8=0S" and out["r1"].name.endswith("3Clip0_PolyA0")
    assert out["r2"].cigar == "50=8S"


def test_correction_minus_strand(spark):
    exons = spark.createDataFrame([("t", i, "c", "-", 100 * i, 100 * i + 50) for i in range(4)], "tx string, exon_no long, chrom string, strand string, s long, e long")
    seqs = spark.createDataFrame([("t", 1, "GATTACAGCC")], "tx string, exon_no long, seq string")
    seq = "CTGTAATC" + "G" * 50
    reads = spark.createDataFrame([("r", "r_PerID1.000_5Clip0_3Clip8_PolyA0", 16, "c", 201, "8S50=", seq)], "read_id string, name string, flag int, chrom string, pos long, cigar string, seq string")
    r = correction.correct(reads, exons, seqs, wiggle=0).first()
    assert (r.cigar, r.pos) == ("0S8=50N50=", 201 - 50 - 8)


def test_measure_and_sinks(spark, tmp_path):
    rows = [("a", 0, "c", 1, 60, "2S96=30S", "CC" + "G" * 96 + "A" * 30), ("b", 4, "*", 0, 0, "", ""), ("d", 16, "c", 1, 60, "90=10X5S", "G" * 100 + "TTTTT"), ("e", 0, "c", 1, 60, "25S99=1X", "C" * 125)]
    df = spark.createDataFrame(rows, "name string, flag int, chrom string, pos long, mapq int, cigar string, seq string").withColumns({"mate_chrom": F.lit("*"), "mate_pos": F.lit(0), "template_length": F.lit(0), "quality": F.lit("*"), "tags": F.array(F.lit("NM:i:0"))})
    m = R.measure(df, R.QualityLimits(98, 20, 20, 50)).persist()
    got = {r.bare_name: r for r in m.collect()}
    assert set(got) == {"a", "d", "e"}
    assert got["a"].poly_a == 30 and got["a"].clip3 == 0 and got["a"].good and got["a"].tagged_name == "a_PerID1.000_5Clip2_3Clip0_PolyA30_PolyARead30"
    assert got["d"].strand == "-" and got["d"].clip5 == 5 and not got["d"].good
    assert not got["e"].good and got["e"].good_but_5prime
    sinks.write_quality_split(m, str(tmp_path / "split"))
    with pytest.raises(Exception):
        sinks.write_quality_split(m, str(tmp_path / "split"))
    back = T.read_sam(spark, str(tmp_path / "split" / "quality=good"))
    assert [r.name for r in back.collect()] == [got["a"].tagged_name] and back.first().tags == ["NM:i:0"]
    assert [r[0] for r in sinks.end_site_bed(m).collect()] == [f"c\t95\t96\t{got['a'].tagged_name}\t1000\t+"]
    assert sinks.end_site_bed(m, True).count() == 1 and sinks.read_statistics(m).count() == 3
    with pytest.raises(ValueError):
        R.QualityLimits(101)


def test_fasta_readers(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a one\nACGT\nAC\n>b two\nGG\n")
    got = [(r.id, r.seq) for r in T.read_fasta(spark, str(tmp_path / "x.fa")).orderBy("file_pos").collect()]
    assert got == [("a", "ACGTAC"), ("b", "GG")]
    assert [r.id for r in T.read_fasta(spark, str(tmp_path / "x.fa"), True).orderBy("file_pos").collect()] == ["a one", "b two"]
    lines = {r[0] for r in sinks.fasta_lines(spark.createDataFrame([("a", "A"), ("a", "A")], "id string, seq string")).collect()}
    assert lines == {">a\nA"}


def test_predictions_and_nesting(spark):
    df = spark.createDataFrame([(">c:1-9(+)(tx1)(0,0, )\t3,9,0.5,0.7\t4,12,0.1,0.2",)], "value string")
    got = T.parse_predictions(df).collect()
    assert [(r.id, r.variant, r.orf_start, r.orf_stop, r.p_start) for r in got] == [("tx1", 0, 3, 9, 0.5), ("tx1", 1, 4, 12, 0.1)]
    orfs = spark.createDataFrame([("t", 0, "+", 100, 200, 50, 0), ("t", 1, "+", 110, 190, 40, 1), ("u", 2, "-", 10, 90, 0, 0), ("u", 3, "-", 20, 80, 5, 2)], "canonical_id string, file_pos long, strand string, start long, stop long, length long, nested int")
    assert [r.nested_offset for r in evidence.nested_offsets(orfs).orderBy("file_pos").collect()] == [0.0, 0.2, 0.0, 0.0]


def test_multiplex_numbers_by_first_occurrence(spark):
    rows = spark.createDataFrame([("a", "X", 0), ("b", "Y", 1), ("c", "X", 2), ("d", "Z", 3)], "id string, seq string, file_pos long")
    got = {r.sequence: r.ids for r in evidence.index_lists(evidence.multiplex(rows)[1]).collect()}
    assert got == {"sequence_0": ["a", "c"], "sequence_1": ["b"], "sequence_2": ["d"]}
    empty = evidence.collapse_ratio(rows.limit(0)).first()[0]
    assert empty is None


def test_selection(spark):
    df = spark.createDataFrame([("t", "a", 0.5), ("t", "b", 0.49), ("t", "c", 0.1)], "tx string, coords string, p double")
    assert {r.coords for r in selection.relative_score_filter(df).collect()} == {"a", "b"}
    assert [r.coords for r in selection.rank_orfs(df).orderBy("rank").collect()] == ["a", "b", "c"]
    colours = spark.createDataFrame([(0.3, True)], "p double, l boolean").select(selection.colour(F.col("p"), 0.3), selection.colour(F.col("p"), 0.3, F.col("l"))).first()
    assert tuple(colours) == ("255,0,0", "")


def test_overrules(spark):
    # A transcript of one block; the frame from base 3 has stops at 9 and 15, so the scan ends at 15.
    seq = "CCC" + "ATG" + "GCC" + "TAA" + "GCC" + "TGA" + "CC"
    row = spark.createDataFrame([("t", "+", 100, 120, [20], [0], seq, 103, 118), ("t", "+", 100, 120, [20], [0], seq, 103, 112)], "canonical_id string, strand string, start long, stop long, block_lens array<long>, block_starts array<long>, seq string, toga_start long, toga_stop long")
    assert [r.compatible for r in overrules.compatible(row).collect()] == [True, False]


def test_steps_and_config(tmp_path):
    assert select_steps() == list(Step) and select_steps(6, "orf") == [Step.POLYA, Step.FUSION, Step.ORF]
    assert select_steps(only=[8, 6, 6], skip=["orf"]) == [Step.POLYA, Step.POLYA]
    for wrong in ({"first": 0}, {"first": 5, "last": 4}, {"only": ["x"]}, {"only": [1], "first": 1}):
        with pytest.raises(ValueError):
            select_steps(**wrong)
    text = '[metadata]\nname = "x"\n[packages]\ntool = "1.0"\n[global]\nmem = 8\n[params.polya]\nper-id = 96\nk = true\nsecondary = "no"\n[params.orf]\np = 0.3\n'
    c = Config.parse(text)
    assert c.flags("polya") == ["--per-id", "96", "-k", "true", "--secondary=no"]
    assert c.get("orf", "p", float) == 0.3 and c.get("orf", "p", int) == 0 and c.get_global("mem") == 8
    assert list(c.select(only=["orf"]).params) == [Step.ORF]
    with pytest.raises(ValueError):
        Config.parse("[params.nope]\na = 1\n")
    (tmp_path / "c.toml").write_text(text)
    said = main(["run-step", "--config", str(tmp_path / "c.toml"), "--only", "6", "--dry-run"])
    assert len(said) == 1 and said[0].startswith("6 polya")
    with pytest.raises(ValueError):
        main(["run", "--config", str(tmp_path / "c.toml")])


def test_external_programs(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("value"))
    assert sorted(r[0] for r in run_on_chunks(df, ["cat"], 3).collect()) == sorted(map(str, range(10)))
    with pytest.raises(Exception, match="ended with"):
        run_on_chunks(df, ["false"], 3).collect()
    assert missing_tools(["sh", "no-such-tool-here"]) == ["no-such-tool-here"]
    assert merge_groups(["/a.b/x.g.bam", "/a.b/y.g.bam", "/z.h.bam"]) == {"g": ["/a.b/x.g.bam", "/a.b/y.g.bam"]}
    assert chunk_names(2) == ["1/2", "2/2"]


def test_polya_step(spark, sf_dir):
    from readloom.plans.queries import _correction_inputs

    reads, exons, seqs = _correction_inputs(spark, sf_dir)
    full = reads.withColumns({"mapq": F.lit(60), "mate_chrom": F.lit("*"), "mate_pos": F.lit(0), "template_length": F.lit(0), "quality": F.lit("*"), "tags": F.array().cast("array<string>")})
    out = steps.polya_step(full, exons, seqs, wiggle=0)
    assert out["bed"].count() == out["good"].count() > 0


def test_streaming_measures_each_file_once(spark, tmp_path):
    from readloom.streaming import incremental

    (tmp_path / "in").mkdir()
    line = "r\t0\tc\t1\t60\t2S96=4S\t*\t0\t0\t" + "C" * 102 + "\t*"
    (tmp_path / "in" / "a.sam").write_text("@HD\n" + line + "\n")
    for _ in range(2):
        incremental.write_split(incremental.measure_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def _tail(seq):
    best, at, a = 1e-9, 0, 0
    for k, x in enumerate(reversed(seq), 1):
        a += x == "A"
        score = a * P.GAIN_A + (k - a) * P.GAIN_OTHER + (P.COST_LEAVE if k < len(seq) else 0.0)
        if score > best:
            best, at = score, k
    return at


def test_read_tails_of_whole_texts(spark, sf_dir):
    import re

    from readloom.plans import queries as Q

    bases = str.maketrans("BDEFHIJKLMNOPQRSUVWXYZ", "CGTACGTACGTACGTACGTACG")
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        seq = re.sub("[^a-zA-Z]", "", r.text).upper().translate(bases) + "A" * (r.n_chars % 40)
        n = 20
        while (t := _tail(seq[-n:])) == n:
            n += 50
        want[r.doc_id] = t
    got = {r.doc_id: r.tail for r in Q.polya_read_tail(spark, sf_dir).collect()}
    assert got == want


def test_correction_of_all_internal_exons(spark, sf_dir):
    """Every candidate within the production wiggle, and every corrected or untouched read."""
    import collections
    import hashlib

    from readloom.plans import fixtures as X
    from readloom.plans import queries as Q

    exons = {(r.tx, r.exon_no): r for r in X.exons(spark, sf_dir).collect()}
    to = str.maketrans("0123456789abcdef", "ACGT" * 4)
    spelled = {k: hashlib.sha256(f"{k[0]}:{k[1]}".encode()).hexdigest().translate(to)[:12] for k in exons}
    span = {}
    for (tx, _), r in exons.items():
        lo, hi = span.get(tx, (r.s, r.e))
        span[tx] = min(lo, r.s), max(hi, r.e)
    inner = [k for k, r in exons.items() if r.s != span[k[0]][0] and r.e != span[k[0]][1]]
    after = {k: (k[0], k[1] + (-1 if exons[k].strand == "-" else 1)) for k in inner}
    at = collections.defaultdict(list)
    for k in inner:
        r = exons[k]
        at[r.chrom, r.strand, r.s if r.strand == "-" else r.e].append(k)
    candidates, rows = [], []
    for k in inner:
        r, minus = exons[k], exons[k].strand == "-"
        n, head = r.e - r.s, f"r{k[0]}-{k[1]}_PerID1.000_5Clip3_3Clip"
        clip = spelled[after[k]] if k[1] % 2 == 0 else "ACGTTGCAACGT"
        found = []
        for d in range(-3, 4):
            for x in at[r.chrom, r.strand, (r.s if minus else r.e) - d]:
                part = ("CCC" + clip)[3 + d :] if minus else ("GGG" + clip)[3 - d :]
                hit = len(part) > 4 and spelled[after[x]][: len(part)] == part
                candidates.append((f"{k[0]}:{k[1]}", -d if minus else d, part, *x, hit))
                if hit:
                    y, m = exons[after[x]], len(part)
                    if minus:
                        gap, pos = r.s - y.e, r.s + 1 - (r.s - y.e) - m - (d > 0)
                        found.append((x, f"{17 - m + abs(d)}S{m}={gap + abs(d)}N{n - abs(d)}=3S", pos))
                    else:
                        found.append((x, f"3S{n - d}={y.s - r.e + d}N{m}={17 - m + d}S", r.s + 1))
        once = {}
        for x, cigar, pos in sorted(found):
            once.setdefault(cigar, (x, pos))
        for i, (cigar, (x, pos)) in enumerate(sorted(once.items(), key=lambda c: (c[1][0], c[0]))):
            rows.append((f"{k[0]}:{k[1]}", head + "0_PolyA5", (16 if minus else 0) | (256 if i else 0), pos, cigar))
        if not once:
            rows.append((f"{k[0]}:{k[1]}", head + "12_PolyA5", 16 if minus else 0, r.s + 1, f"17S{n}=3S" if minus else f"3S{n}=17S"))
    got = correction.clip_matches(*Q._correction_inputs(spark, sf_dir)).select("read_id", "offset", "clip", "tx", "exon_no", "matched").collect()
    assert sorted(map(tuple, got)) == sorted(candidates) and any(c[1] for c in candidates)
    assert sorted(map(tuple, Q.cigar_extend(spark, sf_dir).collect())) == sorted(rows)
    assert len({r[0] for r in rows}) == len(inner)


def test_cli_runs_the_tail_step(spark, tmp_path):
    """SAM, annotation and genome as files; the corrected read is where brute force puts it."""
    from readloom.plans import cli, runners

    genome = "".join("ACGT"[(i * i + i // 3) % 4] for i in range(600))
    exons = [(100, 200), (300, 360), (400, 480)]
    (tmp_path / "g.fa").write_text(f">chr1 x\n{genome}\n")
    blocks = ",".join(str(b - a) for a, b in exons), ",".join(str(a - 100) for a, _ in exons)
    (tmp_path / "a.bed").write_text(f"chr1\t100\t480\ttx1\t0\t+\t100\t480\t0\t3\t{blocks[0]}\t{blocks[1]}\n")
    clip = genome[400:412]
    seq = genome[300:360] + clip + "A" * 8
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.sam").write_text(f"@SQ\tSN:chr1\tLN:600\nr1\t0\tchr1\t301\t60\t60=20S\t*\t0\t0\t{seq}\t*\n")
    config = tmp_path / "c.toml"
    config.write_text(f'[global]\ninput_dir = "{tmp_path}/in"\n[params.polya]\nannotation = "{tmp_path}/a.bed"\ngenome = "{tmp_path}/g.fa"\n')
    chosen = runners.runners(spark)
    step = {runners.Step.POLYA: lambda c, before, after: chosen[runners.Step.POLYA](c, f"{tmp_path}/in", after)}
    said = cli.main(["run-step", "--config", str(config), "--output", str(tmp_path / "out"), "--only", "polya"], step)
    folder = said[0].split(" -> ")[1]
    got = A.read_bam(spark, f"{folder}/alignments").collect()
    assert [(r.pos, r.cigar) for r in got] == [(301, "60=40N12=8S")] and A.header_of(f"{folder}/alignments") == "@SQ\tSN:chr1\tLN:600\n"
    assert spark.read.text(f"{folder}/bed").first().value.split("\t")[:3] == ["chr1", "300", "412"]
    with pytest.raises(ValueError):
        cli.main(["run-step", "--config", str(config), "--output", str(tmp_path / "no"), "--only", "ccs"], chosen)


def test_scores_after_counters(spark, sf_dir):
    """Observing does not keep later queries of the session from running."""
    from readloom.plans import file_queries
    from readloom.plans import queries as Q

    assert file_queries.correction_counters(spark, sf_dir).first().n_hits > 0
    assert Q.forest_scores(spark, sf_dir).count() > 0
