"""Kinds of joined genes on hand-made loci, and against brute force."""

import random

from readloom.operators import fusions

GENE = "gene string, chrom string, strand string, start long, stop long"
READ = "read string, chrom string, strand string, start long, stop long"


def test_kinds(spark):
    genes = [("a", "c", "+", 100, 200), ("a", "c", "+", 300, 400), ("a2", "c", "+", 350, 450), ("b", "c", "+", 1000, 1100), ("b", "c", "+", 1200, 1300), ("m", "c", "-", 1000, 1100), ("t", "c", "+", 1300, 1400)]
    reads = {
        "one": [(100, 200), (300, 400)],
        "same locus": [(100, 200), (350, 450)],
        "both": [(100, 200), (1000, 1100)],
        "touching loci": [(1200, 1300), (1300, 1400)],
        "weak second": [(100, 200), (300, 400), (1020, 1050)],
        "small second": [(100, 200), (300, 400), (1000, 1010)],
        "none strong": [(120, 180), (1020, 1050)],
        "elsewhere": [(5000, 5100)],
    }
    rows = [(k, "c", "+", a, b) for k, v in reads.items() for a, b in v]
    got = {r.read: r for r in fusions.classify(spark.createDataFrame(rows, READ), spark.createDataFrame(genes, GENE), bin_size=64).collect()}
    assert {k: r.kind for k, r in got.items()} == {"one": "free", "same locus": "free", "both": "fusions", "touching loci": "fusions", "weak second": "fakes", "small second": "fakes", "none strong": "review", "elsewhere": "free"}
    assert got["both"].loci == ["c|+|100", "c|+|1000"] and (got["elsewhere"].n_loci, got["elsewhere"].loci) == (0, [])
    assert fusions.classify(spark.createDataFrame([], READ), spark.createDataFrame(genes, GENE)).count() == 0
    assert {r.kind for r in fusions.classify(spark.createDataFrame(rows, READ), spark.createDataFrame([], GENE)).collect()} == {"free"}


def test_loci_are_components(spark):
    rng = random.Random(6)
    spans = [(f"g{i}", "c", rng.choice("+-"), s := rng.randrange(5000), s + rng.randrange(1, 90)) for i in range(150)]
    got = {r.gene: r.locus for r in fusions.loci(spark.createDataFrame(spans, GENE)).collect()}
    root = {g: g for g, *_ in spans}

    def find(g):
        while root[g] != g:
            g = root[g]
        return g

    for g, _, x, a, b in spans:
        for h, _, y, c, d in spans:
            if x == y and a < d and c < b:
                root[find(g)] = find(h)
    assert all((got[g] == got[h]) == (find(g) == find(h)) for g, *_ in spans for h, *_ in spans)
