"""The record-level steps as DataFrame pipelines, and the loop over selected steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import correction, evidence, intervals, overrules, reads, scoring, selection
from ..session import written
from ..sources import tables as T
from .config import Config, Step


def polya_step(alignments: DataFrame, exons: DataFrame, exon_seqs: DataFrame, first: reads.QualityLimits = reads.FIRST_PASS, second: reads.QualityLimits = reads.SECOND_PASS, wiggle: int = 3, cutoff: int = 4) -> dict[str, DataFrame]:
    """Filter, correct, filter again, as blocks: tables ``measured``, ``corrected``, ``good`` and ``bed``."""
    measured = written(reads.measure(alignments, first))
    kept = measured.where("good").withColumn("name", F.col("tagged_name")).select("read_id", *[c for c in alignments.columns if c != "read_id"])
    corrected = written(correction.correct(kept, exons, exon_seqs, wiggle, cutoff))
    again = written(reads.measure(corrected, second))
    good = again.where("good")
    return {"measured": measured, "corrected": corrected, "good": good, "bed": T.sam_to_bed12(good.withColumn("name", F.col("tagged_name")))}


def projections_step(frames: DataFrame, annotation: DataFrame, meta: DataFrame, mask: DataFrame, least: float = 0.8) -> DataFrame:
    """Projections overlapping each frame: canonical_id, genomic_coords and the projection's columns."""
    spans = frames.select("chrom", "strand", "start", "stop", "canonical_id", "genomic_coords")
    targets = annotation.select("chrom", "strand", "start", "stop", F.col("name").alias("toga_id"))
    pairs = intervals.reciprocal_overlaps(spans, targets, least)
    over = pairs.select(F.col("a_canonical_id").alias("canonical_id"), F.col("a_genomic_coords").alias("genomic_coords"), F.col("b_toga_id").alias("toga_id"), F.col("overlap_bp").alias("toga_overlap_bp"))
    return evidence.projection_evidence(over, meta, T.annotation_coordinates(annotation), mask)


def orf_step(transcripts: DataFrame, blast: DataFrame, predicted: DataFrame, projections: DataFrame, model, threshold: float = 0.3, candidates: DataFrame | None = None) -> dict[str, DataFrame]:
    """Evidence to coding and non-coding transcripts; ``candidates`` switches the overrules on.

    Tables ``uncollapsed`` (every scored row) and those of :func:`selection_step`.
    """
    frame = evidence.merge_evidence(blast, predicted)
    frame = evidence.fill_sentinels(evidence.attach_projections(frame, projections))
    scored = scoring.score(selection.distinct_rows(frame), model)
    return {"uncollapsed": scored, **selection_step(transcripts, scored, threshold, candidates)}


def selection_step(transcripts: DataFrame, scored: DataFrame, threshold: float = 0.3, candidates: DataFrame | None = None) -> dict[str, DataFrame]:
    """Scored frames to coding and non-coding transcripts: tables ``raw``, ``final``, ``coding``, ``noncoding`` and ``kinds``.

    ``raw`` holds what the nested cutoff leaves. The overrules look at it, and their rows join the final set after the
    threshold and the relative filter: an overruling projection neither raises its transcript's best score nor has
    to come near it. ``kinds`` is ``coding`` and ``noncoding`` in one table, from one join.

    Where the frames and the transcripts come dealt by id, so do the best scores and the candidates, without another shuffle.
    """
    raw = selection.with_best(selection.nested_cutoff(scored))
    if candidates is not None:  # read twice below
        raw = written(raw)
    # A best score below the threshold has no frame above it.
    chosen = selection.above_threshold(raw, threshold).where(F.col("class1_probability") >= F.col("_best") - F.lit(0.025)).drop("_best", "_coords")
    if candidates is not None:
        best = raw.groupBy("canonical_id").agg(F.first("_best").alias("_best"), F.first("_coords").alias("_coords"))
        chosen = overrules.with_overrules(chosen, overrules.overrule(best, candidates))
    # Dealt once for the best row of a key, the rank and the transcripts.
    best_rows = selection.best_per_key(chosen.repartition("canonical_id"), ("canonical_id", "genomic_coords"), "class1_probability")
    final = selection.rank_orfs(best_rows, "class1_probability", "canonical_id", "genomic_coords")
    orfs = final.select(F.col("canonical_id").alias("name"), F.col("genomic_coords").alias("coords"), F.col("class1_probability").alias("p"), *([F.coalesce("toga_overrule", F.lit(False)).alias("overruled")] if "toga_overrule" in final.columns else []))
    coding, noncoding = selection.coding_split(transcripts, orfs, "name")
    return {"raw": raw.drop("_best", "_coords"), "final": final, "coding": coding, "noncoding": noncoding, "kinds": selection.coding_kinds(transcripts, orfs, "name")}


def run_steps(config: Config, runners: dict[Step, Callable], run_folder: str, dry_run: bool = False) -> list[str]:
    """Run the selected steps in order, each with (config, input folder, output folder); a failure ends the run.

    A dry run only says what would run.
    """
    said = []
    for step in config.steps:
        before, after = config.step_folders(step, run_folder)
        said.append(f"{step.value} {step.label}: {before} -> {after}")
        if dry_run:
            continue
        if step not in runners:
            raise ValueError(f"step {step.label} is an external program: give it a runner, or leave it out")
        runners[step](config, before, after)
    return said
