"""Queries through genome and alignment files: packed sequences, slices by offsets, binary alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import reads as R
from ..sources import alignments as A
from ..sources import genomes as G
from . import fixtures as X
from .file_queries import _file, shared_path
from .queries import query

#: Texts as a genome, with unknown and masked stretches.
_GENOME = """, genome AS (
  SELECT CAST(doc_id AS VARCHAR) AS chrom, replace(replace(seq, 'ACGT', 'acgt'), 'TTAA', 'NNNN') AS seq FROM fx_reads WHERE seq IS NOT NULL
), spans AS (
  SELECT chrom, seq, v, (length(seq) * v) // 4 AS start, (length(seq) * v) // 4 + 70 + v * 40 AS stop, CASE WHEN v % 2 = 0 THEN '+' ELSE '-' END AS strand FROM genome, (SELECT unnest(range(4)) AS v)
)
"""


def _genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.replace(F.replace(F.col("seq"), F.lit("ACGT"), F.lit("acgt")), F.lit("TTAA"), F.lit("NNNN"))
    return X.reads(spark, sf_dir).where("seq is not null").select(F.col("doc_id").cast("string").alias("chrom"), seq.alias("seq"))


def _spans(genome: DataFrame) -> DataFrame:
    start = F.floor(F.length("seq") * F.col("v") / 4)
    rows = genome.select("chrom", "seq", F.explode(F.array(*map(F.lit, range(4)))).alias("v"))
    return rows.select("chrom", "v", start.alias("start"), (start + 70 + F.col("v") * 40).alias("stop"), F.when(F.col("v") % 2 == 0, "+").otherwise("-").alias("strand"))


@query(_GENOME + "SELECT chrom, seq FROM genome")
def twobit_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written packed, read back in stretches and put together."""
    path = shared_path(spark, "genome")
    G.write_twobit(_genome(spark, sf_dir), path)
    return G.whole_sequences(G.read_twobit(spark, path, stretch=1000, partition=1 << 20))


_SLICES = "SELECT chrom, CAST(v AS INT) AS v, CASE WHEN strand = '-' THEN reverse(translate(substr(seq, start + 1, stop - start), 'ATGCatgc', 'TACGtacg')) ELSE substr(seq, start + 1, stop - start) END AS seq FROM spans"


@query(_GENOME + _SLICES)
def genome_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of packed sequences, by their places in the files."""
    path = shared_path(spark, "genome")
    genome = _genome(spark, sf_dir)
    G.write_twobit(genome, path)
    return G.slices(G.genome_index(spark, path), _spans(genome)).select("chrom", "v", "seq")


@query(_GENOME + _SLICES)
def fasta_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of FASTA records in lines of 60 bases, by an index of offsets."""
    genome = _genome(spark, sf_dir)
    lines = F.regexp_replace(F.regexp_replace("seq", "(.{60})", "$1\n"), "\n$", "")
    path = _file(genome.select(F.concat(F.lit(">"), "chrom", F.lit(" a record\n"), lines).alias("value")), "genome-fasta")
    return G.slices(G.genome_index(spark, path), _spans(genome)).select("chrom", "v", "seq")


_HEADER = "@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:chr{i}\tLN:1000000\n" for i in range(7))


def _alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived reads as a data source writes them."""
    return X.alignments(spark, sf_dir).withColumns({"mate_chrom": F.lit("*"), "mate_pos": F.lit(0), "template_length": F.lit(0), "quality": F.lit("*"), "tags": F.array(F.concat(F.lit("tp:i:"), "tx"))})


@query("""SELECT CAST(tx AS VARCHAR) AS name, CAST(flag AS INT) AS flag, chrom, pos, CAST(60 AS INT) AS mapq, cigar, repeat('T', CAST(tx % 30 AS INT)) || 'GATTACAGATTACA' || repeat('C', CAST(tx % 5 AS INT)) || repeat('A', CAST(tx % 45 AS INT)) AS seq, 'tp:i:' || tx AS tag FROM fx_sam""")
def bam_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as sorted binary files with their header, read back in ranges of 64 KB."""
    path = shared_path(spark, "alignments")
    A.write_alignments(_alignments(spark, sf_dir), path, _HEADER)
    return A.read_bam(spark, path, span=1 << 16).select("name", "flag", "chrom", "pos", "mapq", "cigar", "seq", F.get("tags", F.lit(0)).alias("tag"))


@query("""SELECT tx, strand, CAST(CASE WHEN strand = '-' THEN tx % 45 ELSE tx % 30 END AS BIGINT) AS clip5, CASE WHEN strand = '-' THEN pos ELSE pos + span - 1 END AS tes, CAST(matches AS DOUBLE) / aligned AS per_id FROM fx_sam""")
def bam_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads measured from files of either kind, told apart by their first bytes."""
    path = shared_path(spark, "alignments")
    A.write_alignments(_alignments(spark, sf_dir), path, _HEADER)
    return R.measure(A.read_alignments(spark, path), R.QualityLimits()).select(F.col("name").cast("long").alias("tx"), "strand", "clip5", "tes", "per_id")


@query("SELECT chrom, place, pos FROM (SELECT chrom, pos, row_number() OVER (ORDER BY chrom, pos, flag, CAST(tx AS VARCHAR)) - 1 AS place FROM fx_sam)")
def coordinate_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the records in sorted text files, counted file by file."""
    path = shared_path(spark, "sorted")
    A.write_alignments(_alignments(spark, sf_dir), path, _HEADER, "sam")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at")).where(~F.col("value").startswith("@"))
    within = lines.withColumn("k", F.row_number().over(W.partitionBy("file").orderBy("at")) - 1)
    sizes = within.groupBy("file").agg(F.count("*").alias("n"))
    before = sizes.select(F.col("file").alias("_file"), F.coalesce(F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # one row a file
    f = F.split("value", "\t")
    return within.join(before, F.col("file") == F.col("_file")).select(f[2].alias("chrom"), (F.col("k") + F.col("before")).cast("long").alias("place"), f[3].cast("long").alias("pos"))
