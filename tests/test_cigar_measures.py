"""CIGARs measured a column at a time."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from readloom.functions import cigar as C
from readloom.operators import reads as R


def test_measures_are_those_of_the_operations(spark):
    rng = random.Random(2)
    rows = [(i, "".join(f"{rng.choice([0, 1, 2, 7, 30, 12, 2147483647])}{rng.choice(C.OPS)}" for _ in range(rng.randint(0, 7)))) for i in range(2000)] + [(2000, None)]
    df = spark.createDataFrame(rows, "id long, cigar string").repartition(3)
    df = df.withColumns({"o": C.parse(F.col("cigar")), "m": C.measures(F.col("cigar"))}).withColumn("c", C.clips(F.col("o")))
    head = F.coalesce(F.get("o", F.lit(0))["op"] == "H", F.when(F.col("cigar").isNotNull(), False))
    theirs = [C.total(F.col("o"), "="), C.total(F.col("o"), "=XID"), C.reference_span(F.col("o")), "c.left", "c.right", "c.hard_right", head]
    got = [tuple(r) for r in df.select("m.*", *theirs).collect()]
    assert len(got) == 2001 and all(r[:7] == r[7:] for r in got)
    for wrong in ("5M", "=", "5", "3=4", "x3=", "99999999999="):
        with pytest.raises(Exception, match="instead of M|longer than an int"):
            spark.createDataFrame([(1, "3="), (2, wrong)], "id long, cigar string").select(C.measures(F.col("cigar"))).collect()


def test_a_filter_does_not_measure_again(spark, sf_dir):
    from readloom.plans import fixtures as X

    with contextlib.redirect_stdout(io.StringIO()) as said:
        R.measure(X.alignments(spark, sf_dir)).where("good").select("name", "tes", "poly_a").explain("simple")
    plan = said.getvalue()
    assert "regexp_extract_all" not in plan and plan.count("ArrowEvalPython [run(") == 1
