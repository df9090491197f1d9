"""The steps whose record work is in this library, from a step's input folder to its output folder.

The other steps are external programs (see ``external.run_on_chunks``) and have no runner.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import reads as R
from ..operators import overrules, scoring
from ..sources import alignments as A
from ..sources import genomes as G
from ..sources import sinks
from ..sources import tables as T
from .config import Config, Step
from .steps import orf_step, polya_step


def runners(spark: SparkSession) -> dict[Step, Callable[[Config, str, str], None]]:
    def polya(config: Config, before: str, after: str) -> None:
        """SAM or BAM files in ``before``; parameters ``annotation`` (BED12) and ``genome`` (.2bit or FASTA). Writes good reads as sorted BAM (SAM if ``text`` is set) with the header of the input, as BED12, and statistics."""
        aligned = A.read_alignments(spark, before).withColumn("read_id", F.concat_ws("/", "name", "file_pos")).drop("file_pos")
        exons = T.bed12_to_exons(T.parse_bed(T.lines(spark, config.get(Step.POLYA, "annotation"))).where("bed_error is null").drop("value", "file_pos"))
        exons = exons.select(F.col("name").alias("tx"), "exon_no", "chrom", "strand", "start", "stop")
        seqs = G.slices(G.genome_index(spark, config.get(Step.POLYA, "genome")), exons).select("tx", "exon_no", "seq")
        limits = [R.QualityLimits(config.get(Step.POLYA, "identity", default=x.per_id), config.get(Step.POLYA, "clip5", default=x.clip5), x.clip3, x.poly_a_read_suffix) for x in (R.FIRST_PASS, R.SECOND_PASS)]
        out = polya_step(aligned, exons.withColumnsRenamed({"start": "s", "stop": "e"}), seqs, *limits)
        good = out["good"].withColumn("name", F.col("tagged_name"))
        A.write_alignments(good, f"{after}/alignments", A.header_of(before), "sam" if config.get(Step.POLYA, "text", default=False) else "bam")
        sinks.write_lines(T.render_bed(out["bed"]), f"{after}/bed")
        sinks.write_lines(sinks.read_statistics(out["measured"]), f"{after}/statistics")

    def orf(config: Config, before: str, after: str) -> None:
        """BED12 files in ``before/bed``; parameters ``blast``, ``predicted``, ``projections`` (Parquet evidence tables) and ``model``.

        With ``overrule_sequences`` (FASTA of the transcripts) projections may overrule the model. Writes coding and other
        transcripts as BED12 and the final predictions.
        """
        bed = T.parse_bed(T.lines(spark, f"{before}/bed")).where("bed_error is null").drop("value", "file_pos", "bed_error")
        tables = [spark.read.parquet(config.get(Step.ORF, x)) for x in ("blast", "predicted", "projections")]
        fasta = config.get(Step.ORF, "overrule_sequences", default=None)
        candidates = overrules.projection_candidates(bed, tables[2], T.read_fasta(spark, fasta)) if fasta else None
        out = orf_step(bed, *tables, scoring.load(config.get(Step.ORF, "model")), config.get(Step.ORF, "threshold", default=0.3), candidates)
        for kind in ("coding", "noncoding"):
            sinks.write_lines(T.render_bed(out[kind]), f"{after}/{kind}")
        out["final"].write.parquet(f"{after}/predictions")

    return {Step.POLYA: polya, Step.ORF: orf}
