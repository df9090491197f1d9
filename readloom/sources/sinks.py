"""Sinks: splits, BED and FASTA text, statistics and per-category aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import render_bed, sam_line


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select("value").write.mode(mode).text(path)


def write_quality_split(measured: DataFrame, path: str) -> None:
    """Alignments to ``path/quality=good`` and ``quality=bad``; an existing output is refused."""
    good = F.when(F.col("good"), "good").otherwise("bad").alias("quality")
    named = measured.withColumn("name", F.col("tagged_name"))
    named.select(sam_line().alias("value"), good).write.mode("errorifexists").partitionBy("quality").text(path)


def end_site_bed(measured: DataFrame, only_bad_5prime: bool = False) -> DataFrame:
    """End sites of good reads as BED6 lines, or of reads that fail by their 5' clip alone."""
    rows = measured.where(~F.col("good") & F.col("good_but_5prime")) if only_bad_5prime else measured.where("good")
    return rows.select(F.concat_ws("\t", "chrom", (F.col("tes") - 1).cast("string"), F.col("tes").cast("string"), "tagged_name", F.lit("1000"), "strand").alias("value"))


def read_statistics(measured: DataFrame) -> DataFrame:
    """One line a read: name, identity, clips, tails."""
    hard = F.when(F.col("hard_clip3"), "Hardclip").otherwise("")
    tails = ["poly_a", "poly_a_read"] if "poly_a_read" in measured.columns else ["poly_a"]
    return measured.select(F.concat_ws("\t", "bare_name", F.col("per_id").cast("string"), F.col("clip5").cast("string"), F.concat(F.col("clip3").cast("string"), hard), *[F.col(c).cast("string") for c in tails]).alias("value"))


def fasta_lines(df: DataFrame, distinct: bool = True) -> DataFrame:
    """(id, seq) as FASTA text, equal records once."""
    out = df.select("id", "seq")
    return (out.distinct() if distinct else out).select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq").alias("value"))


def write_kinds(report: DataFrame, path: str, kind: str = "kind") -> None:
    """All kinds of a report in one pass: tab-separated rows in ``path/kind=...``; an existing output is refused."""
    rest = [c for c in report.columns if c != kind]
    report.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest]).alias("value"), kind).write.mode("errorifexists").partitionBy(kind).text(path)


def write_chunks(df: DataFrame, path: str, rows: int) -> None:
    """Text files of at most ``rows`` records; none is lost."""
    df.select("value").write.option("maxRecordsPerFile", rows).text(path)


def aggregate_categories(spark: SparkSession, folder: str, kinds=("free", "fusions", "review", "fakes")) -> dict[str, DataFrame]:
    """For each kind the union of the categories' files named ``*.<kind>.bed``."""
    return {kind: spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{kind}.bed").text(folder) for kind in kinds}


def bed_lines(df: DataFrame, width: int = 12) -> DataFrame:
    return render_bed(df, width)
