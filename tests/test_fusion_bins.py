"""reads and genes are summed up where they meet: no pair of them, or of their blocks, leaves its task."""

import collections
import random

from readloom.operators import fusions
GENE = "gene string, chrom string, strand string, start long, stop long"
READ = "read string, chrom string, strand string, start long, stop long"


def _brute(reads, genes, locus):
    size, bases, same = collections.Counter(), collections.Counter(), collections.defaultdict(bool)
    for r, c, x, a, b in reads:
        size[r] += max(b - a, 0)
        for g, d, y, s, e in genes:
            if (c, x) == (d, y) and a < b and s < e and min(b, e) > max(a, s):
                bases[r, g, d, y] += min(b, e) - max(a, s)
                same[r, g, d, y] |= a == s or b == e
    told = {r: {} for r in size}
    for (r, *g), n in bases.items():
        most, shared = told[r].get(locus[tuple(g)], (0, False))
        told[r][locus[tuple(g)]] = (max(most, n), shared or same[(r, *g)])
    out = []
    for r, found in told.items():
        strong = sum(s and n >= 0.1 * size[r] for n, s in found.values())
        out.append((r, "free" if len(found) < 2 else "fusions" if strong > 1 else "fakes" if strong else "review", len(found), strong, sorted(found)))
    return sorted(out)


def test_kinds_against_all_pairs(spark, monkeypatch):
    """Blocks in many bins, repeated, empty and on several strands; some without a gene near; portions of few pairs."""
    rng = random.Random(9)

    def spans(name, n, most):
        for i in range(n):
            at = rng.randrange(16000)
            for _ in range(rng.randrange(1, 5)):
                yield (f"{name}{i}", "c" if rng.random() < 0.95 else "d", "+" if i % 3 else "-", at, at + rng.choice([0, 10, 10, rng.randrange(1, most)]))
                at += rng.randrange(0, 150)

    genes, reads = [*spans("g", 60, 60)], [*spans("r", 200, 90)]
    reads += [(r, c, x, a, b) for r, c, x, a, b in reads[::9]] + [(f"copy{i}", *g[1:]) for i, g in enumerate(genes)] + [("far", "c", "+", 90000, 90100), ("void", "c", "+", 50, 50), ("wide", "c", "+", 0, 17000)]
    reads += [(f"join{i}", c, x, a + d, b + d) for i in range(60) for (_, c, x, a, b), d in ((rng.choice(genes), 0), (rng.choice(genes), i % 3))]
    g, r = spark.createDataFrame(genes, GENE), spark.createDataFrame(reads, READ)
    whole = {}
    for name, c, x, a, b in genes:
        s, e = whole.get((name, c, x), (a, b))
        whole[name, c, x] = min(s, a), max(e, b)
    placed = fusions.loci(spark.createDataFrame([(*k, *v) for k, v in whole.items()], GENE)).collect()
    want = _brute(reads, genes, {(p.gene, p.chrom, p.strand): p.locus for p in placed})
    assert len({w[1] for w in want}) == 4
    for pairs, size in ((1 << 20, 1 << 14), (5, 64)):
        monkeypatch.setattr(fusions, "PAIRS", pairs)
        got = sorted((*x[:4], list(x.loci)) for x in fusions.classify(r, g, bin_size=size).collect())
        assert got == want


def test_no_pair_is_joined_or_shuffled(spark):
    rows = [(f"x{i}", "c", "+", 10 * k, 10 * k + 5 + i % 3) for i in range(80) for k in range(4)]
    r, g = spark.createDataFrame(rows, READ), spark.createDataFrame(rows, GENE)
    met = fusions.touched_loci(r, g)
    assert "Join" not in met._jdf.queryExecution().executedPlan().toString()
    assert sorted((x.read, x.bases, x.support, x.shared) for x in met.collect()) == sorted((f"x{i}", 4 * (5 + i % 3), 4 * (5 + i % 3), True) for i in range(80))
