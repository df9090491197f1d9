"""Barcodes at the ends of reads against plain edit distance."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.functions import approximate as N
from readloom.operators import barcodes as B


def infix(pattern, text):
    """(least edits against any stretch, first end of one): the whole table, row by row."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row), row.index(min(row))


def test_distances_against_the_whole_table():
    rng = random.Random(1)
    patterns = ["".join(rng.choice("ACGT") for _ in range(k)) for k in (1, 2, 7, 12, 16, 33, 63, 64)]
    texts = ["", "A", "N" * 30] + ["".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    texts += [p[:3] + p[4:] + "ACGT" for p in patterns] + ["GG" + p for p in patterns]
    code, size = N.coded(texts, 90)
    best, end = N.infix_distances(code, size, patterns)
    for i, t in enumerate(texts):
        for k, p in enumerate(patterns):
            assert (best[i, k], end[i, k]) == infix(p, t[:90].upper().replace("N", "#"))
    with pytest.raises(ValueError):
        N.infix_distances(code, size, ["A" * 65])


def revcomp(s):
    return s[::-1].translate(str.maketrans("ACGTacgt", "TGCATGCA"))


def test_reads_against_plain_choice(spark, monkeypatch):
    monkeypatch.setattr(B, "READS", 50)
    monkeypatch.setattr(B, "PATTERNS", 3)
    rng = random.Random(2)
    kit = [(f"bc{i}", "".join(rng.choice("ACGT") for _ in range(rng.choice([14, 16])))) for i in range(8)]

    def damaged(s):
        k = rng.randrange(len(s))
        return rng.choice([s, s, s[:k] + s[k + 1 :], s[:k] + "T" + s[k:], s[:k] + "A" + s[k + 1 :], s[: len(s) // 2]])

    reads = [(0, None), (1, ""), (2, "ACG"), (3, kit[0][1])]
    for i in range(4, 260):
        a, b = rng.choice(kit), rng.choice(kit)
        b = a if rng.random() < 0.7 else b
        reads.append((i, "T" * rng.randrange(5) + damaged(a[1]) + "".join(rng.choice("ACGT") for _ in range(rng.randrange(60))) + damaged(revcomp(b[1])) + "".join(rng.choice("acgt") for _ in range(rng.randrange(5)))))
    df = spark.createDataFrame(reads, "id long, seq string").withColumns({"barcode5": F.lit("clash"), "kept": F.col("id")})
    got = {r.id: r for r in B.demultiplex_reads(df, kit).collect()}
    assert len(got) == len(reads)
    width, told = 16 + 12, 0
    for i, s in reads:
        r = got[i]
        assert r.kept == i and r.seq == s
        if s is None:
            assert (r.barcode5, r.barcode3, r.assigned, r.insert_start, r.insert_stop) == (None,) * 5
            continue
        names, cut = [], []
        for x, text in ((5, s[:width]), (3, revcomp(s)[:width])):
            all_ = [infix(p, text.upper()) for _, p in kit]
            k = min(range(len(kit)), key=lambda j: all_[j][0])
            second = min(d for j, (d, _) in enumerate(all_) if j != k)
            assert (r[f"barcode{x}"], r[f"distance{x}"], r[f"second{x}"], r[f"end{x}"]) == (kit[k][0], all_[k][0], second, all_[k][1])
            fine = (len(kit[k][1]) - all_[k][0]) * 100 >= 80 * len(kit[k][1]) and second > all_[k][0]
            names.append(kit[k][0] if fine else None)
            cut.append(all_[k][1] if fine else 0)
        want = names[0] if names[0] == names[1] or names[1] is None else (names[1] if names[0] is None else None)
        assert r.assigned == want and r.insert_start == cut[0] and r.insert_stop == max(len(s) - cut[1], cut[0])
        told += want is not None
    assert told > 150


def test_one_barcode_and_an_empty_table(spark):
    one = B.demultiplex_reads(spark.createDataFrame([("ACGTACGTAC" + "G" * 40,)], "seq string"), [("only", "ACGTACGTAC")]).first()
    assert (one.assigned, one.distance5, one.second5, one.insert_start, one.insert_stop) == ("only", 0, None, 10, 50)
    assert B.demultiplex_reads(spark.createDataFrame([], "id int, seq string"), [("only", "ACGT")]).count() == 0
    with pytest.raises(ValueError):
        B.demultiplex_reads(spark.createDataFrame([], "id int, seq string"), [("x", "A"), ("x", "C")])


def test_many_reads_go_through_together():
    rng = np.random.default_rng(3)
    code = rng.integers(0, 4, (2000, 30)).astype(np.uint8)
    patterns = ["".join(rng.choice(list("ACGT"), 16)) for _ in range(96)]
    best, _ = N.infix_distances(code, np.full(2000, 30), patterns)
    i, k = int(best.min(axis=1).argmin()), 5
    text = "".join("ACGT"[c] for c in code[i])
    assert best[i, k] == infix(patterns[k], text)[0]
