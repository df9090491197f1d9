"""Projections overruling the model: compatible frames of transcripts that scored low, or whose projections are masked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import blocks as B
from ..functions import sequence as S

#: The order in which labels are tried: fully intact, intact, partially intact.
LABELS = ("FI", "I", "PI")


def compatible(rows: DataFrame, allowed_stop: str | None = None) -> DataFrame:
    """Does a transcript's frame from a projection's start end where the projection ends? Adds ``compatible``.

    Rows hold the transcript's BED columns, ``stops`` (the places of its stop codons in reading direction) or seq, from which
    they are found, and the projection's toga_start and toga_stop. The first in-frame stop codon is tolerated and the scan ends at the
    next; on + a permitted stop is passed over before that rule, on - after it.
    """
    if "stops" not in rows.columns:
        return compatible(rows.withColumn("stops", S.stop_sites(F.col("seq"))), allowed_stop).drop("stops")
    own = [F.col(c) for c in ("start", "stop", "block_lens", "block_starts", "strand", "stops", "toga_start", "toga_stop")]
    return rows.withColumn("compatible", B.frame_ends_at(*own, permitted=F.col(allowed_stop) if allowed_stop is not None else None))


def candidates(transcripts: DataFrame, projections: DataFrame, sequences: DataFrame, allowed_stop: str | None = None) -> DataFrame:
    """Projections with their transcript's blocks and stop codons, and whether they fit (``compatible``).

    A sequence is scanned once, however many projections its transcript has; they meet its stop codons, not its bases.

    transcripts: BED12 columns, the name being canonical_id. projections: canonical_id, toga_id, toga_label,
    toga_pid, toga_start, toga_stop, toga_coords (and more). sequences: id (canonical_id), seq. Projections
    without transcript or sequence are left out.
    """
    blocks = transcripts.select(F.col("name").alias("_name"), "start", "stop", "strand", "block_lens", "block_starts")
    rows = projections.join(blocks, F.col("canonical_id") == F.col("_name")).join(sequences.select(F.col("id").alias("_id"), S.stop_sites(F.col("seq")).alias("stops")), F.col("canonical_id") == F.col("_id"))
    return compatible(rows, allowed_stop).drop("_name", "_id", "start", "stop", "strand", "block_lens", "block_starts", "stops")


def projection_candidates(transcripts: DataFrame, projections: DataFrame, sequences: DataFrame, allowed_stop: str | None = None) -> DataFrame:
    """:func:`candidates` of evidence rows, whose projections have ``toga_coords`` (``chrom|start|stop|strand``) alone; rows without are left out."""
    c = F.split("toga_coords", r"\|")
    rows = projections.where("toga_coords is not null and toga_coords <> '0'").dropDuplicates(["canonical_id", "toga_id"])
    rows = rows.select("canonical_id", "toga_id", "toga_label", "toga_pid", "toga_masked", "toga_coords", F.get(c, F.lit(1)).cast("long").alias("toga_start"), F.get(c, F.lit(2)).cast("long").alias("toga_stop"))
    return candidates(transcripts, rows, sequences, allowed_stop)


def overrule_low_scores(predictions: DataFrame, candidates: DataFrame, threshold: float = 0.03) -> DataFrame:
    """Type A: where a transcript's best score is at most ``threshold``, per label the compatible projection of highest identity.

    candidates: canonical_id, toga_id, toga_label, toga_pid, toga_coords, compatible.
    """
    low = predictions.groupBy("canonical_id").agg(F.max("class1_probability").alias("_best")).where(F.col("_best") <= F.lit(threshold))
    fit = candidates.where(F.col("compatible") & F.col("toga_label").isin(*LABELS)).join(low.select("canonical_id"), "canonical_id", "left_semi")
    w = W.partitionBy("canonical_id", "toga_label").orderBy(F.desc("toga_pid"), "toga_id")
    return overruled(fit.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k"))


def overrule_masked(predictions: DataFrame, candidates: DataFrame, any_masked: bool = False) -> DataFrame:
    """Type B: where all (or any) projections of a label are masked and the best frame is compatible, the projection's coordinates."""
    group = W.partitionBy("canonical_id", "toga_label")
    masked = (F.bool_or if any_masked else F.bool_and)("toga_masked")
    best = predictions.groupBy("canonical_id").agg(F.max_by("genomic_coords", F.struct("class1_probability", "genomic_coords")).alias("_coords"))
    fit = candidates.withColumn("_m", masked.over(group)).where("_m and compatible").join(best, "canonical_id").where(F.col("toga_coords") != F.col("_coords")).drop("_m", "_coords")
    return overruled(fit.withColumn("_k", F.row_number().over(group.orderBy(F.desc("toga_pid"), "toga_id"))).where("_k = 1").drop("_k"))


def overrule(best: DataFrame, candidates: DataFrame, threshold: float = 0.03, any_masked: bool = False) -> DataFrame:
    """Both types at once, :func:`overrule_low_scores` and :func:`overrule_masked`, from one join and one order of the candidates.

    best: one row a transcript, canonical_id with its best score ``_best`` and the coordinates that have it, ``_coords``.
    """
    group = W.partitionBy("canonical_id", "toga_label")
    rows = candidates.join(best, "canonical_id").withColumn("_m", (F.bool_or if any_masked else F.bool_and)("toga_masked").over(group))
    low = F.when(F.col("toga_label").isin(*LABELS) & (F.col("_best") <= F.lit(threshold)), "A")
    hidden = F.when(F.col("_m") & (F.col("toga_coords") != F.col("_coords")), "B")
    rows = rows.where("compatible").withColumn("_type", F.explode(F.array_compact(F.array(low, hidden)))).drop("_m", "_best", "_coords")
    w = W.partitionBy("canonical_id", "toga_label", "_type").orderBy(F.desc("toga_pid"), "toga_id")
    return overruled(rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k", "_type"))


def overruled(rows: DataFrame) -> DataFrame:
    """As predictions: the projection's coordinates, its identity as the score, flagged; rows without coordinates go."""
    rows = rows.where(F.col("toga_coords").isNotNull() & (F.col("toga_coords") != "0"))
    return rows.select("canonical_id", F.col("toga_coords").alias("genomic_coords"), "toga_id", "toga_label", (F.col("toga_pid") / 100).alias("class1_probability"), F.lit(True).alias("toga_overrule"))


def with_overrules(predictions: DataFrame, *more: DataFrame) -> DataFrame:
    out = predictions.withColumn("toga_overrule", F.lit(False))
    for x in more:
        out = out.unionByName(x, allowMissingColumns=True)
    return out
