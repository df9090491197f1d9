"""Operator 11 against plain counting over all orders, and its defined results."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from readloom.llm import filter_audit as A

DOC = "doc_id long, text string, source string, kept string"
LABEL = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    """{(part, order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)} by applying every order to every row."""
    fails = []
    for d, text, source, _ in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = d is not None and any(o is not None and o < d and (t or "") == text for o, t, _, _ in docs)
        own = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": copy}
        own |= {name: any(i == d and d is not None and x[k] == 1 for i, *x in labels) for k, name in enumerate(("good", "toxic"))}
        fails.append((source or "", own))
    out = {}
    for part in {p for p, _ in fails}:
        rows = [f for p, f in fails if p == part]
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, x in enumerate(order, 1):
                gone = [f for f in left if f[x]]
                left = [f for f in left if not f[x]]
                alone = sum(f[x] and not any(f[y] for y in "ABCDE" if y != x) for f in rows)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f[x] for f in rows) - len(gone), alone, sum(f["good"] for f in gone), sum(f["toxic"] for f in gone)]
        for x in "ABCDE":
            at = [key for key in out if key[0] == part and key[1][key[2] - 1] == x]
            total = sum(out[key][1] for key in at)
            for key in at:
                out[key].append(total)
    return {k: tuple(v) for k, v in out.items()}


def run(spark, docs, labels):
    masks = A.failure_masks(spark.createDataFrame(docs, DOC))
    return A.audit(A.mask_counts(masks, spark.createDataFrame(labels, LABEL)))


def test_against_plain_counting(spark):
    rng = random.Random(3)
    texts = ["", "a b c", "word " * 250, " ".join(f"w{i}" for i in range(220)), "UP LOW " * 20, "x # y", " ".join(f"w{i}" for i in range(200)), "É" * 9 + " A", "tab\tnew\nline\x0bv\x1cnot-space " * 60, "$" + " ".join(f"v{i}" for i in range(300))]
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""]), "clash") for i in range(150)]
    docs += [(None, texts[3], "a", ""), (None, texts[3], "a", ""), (7, docs[7][1], "a", ""), (7, docs[7][1], "a", ""), (900, None, "only null", ""), (-5, texts[1], "b", "")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (5555, 1, 1)]
    got = run(spark, docs, labels).collect()
    want = plain(docs, labels)
    assert len(got) == len(want) == 600 * 4
    for r in got:
        assert tuple(r)[3:] == want[r.part, r.filter_order, r.step]


def test_shapley_shares_out_all_removals(spark):
    got = run(spark, [(i, "x " * i + "#" * (i % 2), "s", "") for i in range(300)], []).where("filter_order = 'ABCDE'").collect()
    assert sum(r.shapley for r in got) == 120 * sum(r.removed for r in got) and sum(r.removed for r in got) + min(r.kept for r in got) == 300


def test_empty_table_and_fewer_filters(spark):
    assert run(spark, [], [(1, 1, 1)]).count() == 0
    masks = A.failure_masks(spark.createDataFrame([(1, "#", "s", ""), (2, "A", "s", "")], DOC), filters="CD")
    got = {(r.filter_order, r.step): (r.removed, r.shapley) for r in A.audit(A.mask_counts(masks, spark.createDataFrame([], LABEL), "doc_id"), "CD").collect()}
    assert got == {("CD", 1): (1, 2), ("CD", 2): (1, 2), ("DC", 1): (1, 2), ("DC", 2): (1, 2)}


def test_long_text_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(400_000))
    docs = spark.createDataFrame([(1, long, "s", ""), (2, long, "s", "")], DOC).withColumns({"mask": F.lit(99), "part": F.lit("p"), "digest": F.lit("d"), "n": F.lit(1)})
    counts = A.mask_counts(A.failure_masks(docs), spark.createDataFrame([], LABEL)).collect()
    assert sorted((r.part, r["mask"], r.n) for r in counts) == [("s", 0, 1), ("s", 16, 1)]


@pytest.mark.parametrize("k", [1, 3, 5])
def test_polynomial_of_one_mask(spark, k):
    """A single document failing k filters shares its removal among them equally."""
    counts = spark.createDataFrame([("p", (1 << k) - 1, 1, 0, 0)], "part string, mask int, n long, good long, toxic long")
    got = A.shapley_values(A.removal_polynomials(counts)).first().shapley
    assert got == [120 // k] * k + [0] * (5 - k)
