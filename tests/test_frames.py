"""Reading frames, stop codons and two-sided trims against brute force; time grows with the length."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from readloom.functions import blocks as B
from readloom.functions import frames as N
from readloom.functions import sequence as S
from readloom.operators import frames, overrules

STOPS = ("TAA", "TAG", "TGA")


def brute(seq, least=100, starts=("ATG",), partial5=True, partial3=True, include_stop=True):
    """All frames of a sequence, codon by codon: (start, stop, strand, frame, kind, codons, inner starts)."""
    out = []
    for strand in "+-":
        s = seq.upper()
        s = s if strand == "+" else s[::-1].translate(str.maketrans("ACGT", "TGCA"))
        for f in range(3):
            begin, opened, inner = (f if partial5 else None), True, []
            at = f
            while True:
                codon = s[at : at + 3]
                last = len(codon) < 3
                if last or codon in STOPS:
                    if begin is not None and (partial3 or not last):
                        end = at if last or not include_stop else at + 3
                        n = (at - begin) // 3
                        kind = (2 if last else 0) if not opened else (3 if last else 1)
                        if n > 0 and end - begin >= least:
                            keep = [k for k in inner if k > 0 and n - k >= 30 and 4 * (n - k) >= n]
                            place = (begin, end) if strand == "+" else (len(s) - end, len(s) - begin)
                            out.append((*place, strand, f, N.KINDS[kind], n, keep))
                    if last:
                        break
                    begin, opened, inner = None, False, []
                elif codon in starts:
                    if begin is None or opened:
                        begin, opened, inner = at, False, []
                    inner.append((at - begin) // 3)
                at += 3
    return sorted(out, key=lambda r: (r[0], r[1], r[2]))


def sequences(seed=1, n=60):
    rng = random.Random(seed)
    out = ["", "A", "AT", "ATG", "ATGTAA", "N" * 200, "ATG" * 80, "GCC" * 60 + "TAA", "ATG" + "GCC" * 60]
    for _ in range(n):
        out.append("".join(rng.choice("ACGTacgtACGTN") if rng.random() < 0.98 else rng.choice(["TAA", "ATG", "cat"]) for _ in range(rng.randrange(1, 900))))
    out += ["".join(rng.choice(["ATG", "GCC", "TTC", "GAA", "AAC"]) for _ in range(200)) + "TGA" for _ in range(5)]
    return out


def test_frames_against_brute_force(spark):
    seqs = sequences()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)] + [(1000, None), (3, seqs[12])], "id long, seq string")
    for least, options in ((100, {}), (30, {"partial5": False}), (1, {"partial3": False, "include_stop": False}), (60, {"starts": ("ATG", "CTG")})):
        got = {}
        for r in frames.find_orfs(df, min_length=least, **options).collect():
            got.setdefault(r.id, []).append((r.orf_no, r.start, r.stop, r.strand, r.frame, r.kind, r.n_codons, r.inner))
        for i, s in enumerate(seqs):
            want = [(k, *x) for k, x in enumerate(brute(s, least, **options), 1)]
            if i != 3:
                assert sorted(got.get(i, [])) == want
        assert 1000 not in got


def test_long_sequence_alone_and_in_a_batch(spark, monkeypatch):
    monkeypatch.setattr(frames, "SCAN", 1000)
    rng = random.Random(4)
    seqs = ["".join(rng.choice("ACGT") for _ in range(k)) for k in (10, 5000, 3, 700, 0, 2500)]
    df = spark.createDataFrame(list(enumerate(seqs)), "id long, seq string").coalesce(1)
    got = sorted((r.id, r.start, r.stop, r.strand) for r in frames.find_orfs(df).collect())
    assert got == sorted((i, *x[:3]) for i, s in enumerate(seqs) for x in brute(s))


def test_time_is_linear():
    rng = np.random.default_rng(2)

    def took(n):
        data = rng.choice(np.frombuffer(b"ACGT", np.uint8), n)
        began = time.process_time()
        N.find_frames(data, np.array([0, n]))
        return time.process_time() - began

    took(100_000)
    small, large = min(took(300_000) for _ in range(3)), min(took(3_000_000) for _ in range(2))
    assert large < 25 * small


def test_nested_frames_and_proteins(spark):
    body = "ATG" + "GCC" * 40 + "ATG" + "TTC" * 35 + "ATG" + "AAC" * 20 + "TAA"
    df = spark.createDataFrame([("t1", "C" + body), ("t2", S_rc("C" + body))], "id string, seq string")
    orfs = frames.find_orfs(df, partial5=False, partial3=False).persist()
    nested = sorted((r.id, r.nested, r.offset) for r in frames.nested_frames(orfs).collect())
    assert [x for x in nested if "ORF" not in x[0]] == [("t1.p1", 0, 0), ("t2.p1", 0, 0)]
    assert [x[1:] for x in nested if x[0].startswith("t1.p1_")] == [(1, 41)]  # the last start leaves 21 codons
    spoken = {r.id: r.protein for r in frames.proteins(frames.orf_bases(orfs, df)).collect()}
    assert spoken["t1"] == spoken["t2"] == "M" + "A" * 40 + "M" + "F" * 35 + "M" + "N" * 20
    orfs.unpersist()


def S_rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_translation_covers_the_code():
    code = {a + b + c: N.AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate("ACGT") for j, b in enumerate("ACGT") for k, c in enumerate("ACGT")}
    assert {c for c, a in code.items() if a == "*"} == set(STOPS) and code["ATG"] == "M" and code["TGG"] == "W"
    assert N.translate(np.frombuffer(b"ATGnnnTAAGC", np.uint8)) == b"MX*"


def test_stop_sites_against_a_scan(spark):
    seqs = [*sequences(7, 25), None]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string").select("i", S.stop_sites(F.col("s")).alias("all"), S.stop_positions(F.col("s"), F.lit(4)).alias("four")).collect()
    for r in rows:
        s = seqs[r.i]
        every = None if s is None else [k for k in range(len(s) - 2) if s[k : k + 3].upper() in STOPS]
        assert r["all"] == every and r.four == (None if s is None else [k for k in every if k >= 4 and k % 3 == 1])


def test_two_sided_trim_is_two_trims(spark):
    rng = random.Random(8)
    rows = []
    for i in range(80):
        lens = [rng.randint(1, 30) for _ in range(rng.randint(1, 5))]
        starts = [0]
        for a in lens[:-1]:
            starts.append(starts[-1] + a + rng.randint(1, 20))
        s = rng.randint(0, 500)
        e = s + starts[-1] + lens[-1]
        rows.append((f"t{i}", rng.choice("+-"), s, e, s + 2, e - 1, lens, starts, len(lens), rng.randint(-3, 50), rng.randint(-3, 50)))
    df = spark.createDataFrame(rows, "name string, strand string, start long, stop long, thick_start long, thick_stop long, block_lens array<long>, block_starts array<long>, block_count int, a int, b int").persist()
    for r in B.trim_ends(df, F.col("a"), F.col("b")).collect():
        src = next(x for x in rows if x[0] == r.name)
        bases = [src[2] + s + i for s, n in zip(src[7], src[6]) for i in range(n)]
        a, b = max(src[9], 0), max(src[10], 0)
        left, right = (b, a) if src[1] == "-" else (a, b)
        if a + b > len(bases):
            assert r.trim_error and r.block_lens is None
            continue
        got = [r.start + s + i for s, n in zip(r.block_starts, r.block_lens) for i in range(n)]
        assert got == bases[left : len(bases) - right] and r.block_count == len(r.block_lens) and r.trim_error is None
        if got:
            assert r.stop == got[-1] + 1 and all(n > 0 for n in r.block_lens)
    df.unpersist()


def literal_scan(seq, start, plus, allowed):
    """The place of the last stop that an in-frame scan meets: one is tolerated, a permitted one passed over, before that rule on + and after it on -."""
    found, tolerated = -1, False
    for k in range(start, len(seq) - 2, 3):
        if seq[k : k + 3] not in STOPS:
            continue
        found = k
        if plus and k == allowed:
            continue
        if not tolerated:
            tolerated = True
            continue
        if not plus and k == allowed:
            continue
        break
    return found


def test_permitted_stops(spark):
    """Compatibility with a permitted stop is that of a literal scan, on both strands."""
    rng = random.Random(3)
    rows = []
    for i in range(120):
        seq = "".join(rng.choice(["TAA", "GCC", "GCC", "CCC", "TGA"]) for _ in range(12))
        stops = [k for k in range(0, 36, 3) if seq[k : k + 3] in STOPS]
        allowed = rng.choice(stops) if stops and rng.random() < 0.8 else -7
        strand = rng.choice("+-")
        end = literal_scan(seq, 0, strand == "+", allowed)
        beside = rng.choice([0, 0, 1])
        # One block from 100 to 136; a frame from its 5' end to the stop.
        a, b = (100, 100 + end + 3 + beside) if strand == "+" else (136 - end - 3 - beside, 136)
        rows.append((i, strand, 100, 136, [36], [0], seq, a, b, allowed, end >= 0 and beside == 0))
    df = spark.createDataFrame(rows, "i int, strand string, start long, stop long, block_lens array<long>, block_starts array<long>, seq string, toga_start long, toga_stop long, allowed int, want boolean")
    got = overrules.compatible(df, "allowed").collect()
    assert [r.compatible for r in got] == [r.want for r in got] and 20 < sum(r.want for r in got) < 110
