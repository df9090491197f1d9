"""The selection step's joint tables against their parts."""

import random

from pyspark.sql import functions as F

from readloom.operators import overrules, selection
from readloom.plans import queries as Q


def test_overrules_together_are_both_types(spark):
    rng = random.Random(4)
    frames = [(f"t{i}", f"chr1|{j}|9|+", rng.choice([0.01, 0.02, 0.03, 0.4])) for i in range(60) for j in range(rng.randrange(1, 4))]
    rows = [(f"t{i}", f"p{i}_{j}", rng.choice(["FI", "I", "UL", None]), float(rng.randrange(3)), rng.random() < 0.7, rng.choice([f"chr1|{j % 3}|9|+", "0", None]), rng.random() < 0.7) for i in range(70) for j in range(6)]
    predictions = spark.createDataFrame(frames, "canonical_id string, genomic_coords string, class1_probability double")
    found = spark.createDataFrame(rows, "canonical_id string, toga_id string, toga_label string, toga_pid double, toga_masked boolean, toga_coords string, compatible boolean")
    best = selection.with_best(predictions).groupBy("canonical_id").agg(F.first("_best").alias("_best"), F.first("_coords").alias("_coords"))
    for any_masked in (False, True):
        want = overrules.overrule_low_scores(predictions, found).unionAll(overrules.overrule_masked(predictions, found, any_masked)).collect()
        got = overrules.overrule(best, found, any_masked=any_masked)
        assert len(want) > 20 and sorted(map(str, got.select(*want[0].asDict()).collect())) == sorted(map(str, want))


def test_kinds_are_coding_and_noncoding(spark, sf_dir):
    out = Q._selected(spark, sf_dir)
    columns = ["name", "chrom", "thick_start", "thick_stop", "score", "block_count"]
    want = out["coding"].select(F.lit(True), *columns).union(out["noncoding"].select(F.lit(False), *columns)).collect()
    got = out["kinds"].select("coding", *columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want)) and {r[0] for r in want} == {True, False}


def test_final_coding_shuffles_line_items_once_a_table(spark, sf_dir):
    """Blocks, projections and their sequences, and the transcripts to be told: the frames are written, and nothing else is derived twice."""
    plan = Q.final_coding(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and sum(line.strip(" :+-").startswith("Relation [") for line in plan.split("\n")) <= 5
