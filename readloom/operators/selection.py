"""From scored frames to the final coding and non-coding sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequence as S


def nested_cutoff(df: DataFrame, least: float = 0.7, few: int = 4) -> DataFrame:
    """Nested frames stay if close to their top frame, low in number, or backed by other evidence."""
    keep = (1 - F.col("blast_nested_offset") >= F.lit(least)) | (F.col("blast_nested") <= few) | (F.col("translationAI_id") != "X") | (F.col("toga_coords") == F.col("genomic_coords")) | (F.col("blast_nested") == -1)
    return df.where(F.coalesce(keep, F.lit(False)))


def with_best(df: DataFrame, p: str = "class1_probability", tx: str = "canonical_id", coords: str = "genomic_coords") -> DataFrame:
    """Frames with their transcript's best score and the coordinates that have it: ``_best``, ``_coords``."""
    w = W.partitionBy(tx)
    return df.withColumns({"_best": F.max(p).over(w), "_coords": F.max_by(coords, F.struct(p, coords)).over(w)})


def relative_score_filter(df: DataFrame, p: str = "p", tx: str = "tx", within: float = 0.025) -> DataFrame:
    """Frames scored within ``within`` of their transcript's best."""
    return df.withColumn("_best", F.max(p).over(W.partitionBy(tx))).where(F.col(p) >= F.col("_best") - F.lit(within)).drop("_best")


def rank_orfs(df: DataFrame, p: str = "p", tx: str = "tx", tie: str = "coords") -> DataFrame:
    """rank 0, 1, ... within a transcript by falling score."""
    return df.withColumn("rank", (F.row_number().over(W.partitionBy(tx).orderBy(F.desc(p), F.asc(tie))) - 1).cast("long"))


def best_per_key(df: DataFrame, keys: tuple[str, ...] = ("tx", "coords"), p: str = "p") -> DataFrame:
    """One row a key, the best scored; combines before its shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(p, *[c for c in rest if c != p])).alias("r")).select(*keys, "r.*").select(*df.columns)


def distinct_rows(df: DataFrame, keys: tuple[str, ...] = ("genomic_coords", "canonical_id"), ignore_keys: bool = False) -> DataFrame:
    """Repeated rows once; ``ignore_keys`` compares the evidence alone."""
    return df.dropDuplicates([c for c in df.columns if not (ignore_keys and c in keys)])


def above_threshold(df: DataFrame, threshold: float = 0.3, p: str = "class1_probability", overruled: str = "toga_overrule") -> DataFrame:
    keep = F.col(p) >= F.lit(threshold)
    return df.where(keep | F.coalesce(F.col(overruled), F.lit(False)) if overruled in df.columns else keep)


def colour(p, threshold: float, label=None):
    """Green above the threshold and red below; with a ground label, four colours (none at the threshold itself)."""
    if label is None:
        return F.when(p > threshold, "0,255,0").otherwise("255,0,0")
    return F.when(label & (p > threshold), "0,255,0").when(label & (p < threshold), "255,165,0").when(~label & (p > threshold), "255,0,0").when(~label & (p < threshold), "128,128,128").otherwise("")


def result_bed9(df: DataFrame, threshold: float, label: str | None = None) -> DataFrame:
    """Ranked frames as BED9 lines; the rank is part of the name."""
    ranked = rank_orfs(df, "class1_probability", "canonical_id", "genomic_coords")
    c = F.split("genomic_coords", r"\|")
    name = F.concat_ws("_", "canonical_id", F.col("rank").cast("string"), F.format_string("%.4f", "class1_probability"))
    rgb = colour(F.col("class1_probability"), threshold, F.col(label) if label else None)
    return ranked.select(F.concat_ws("\t", c[0], c[1], c[2], name, F.format_string("%.2f", F.col("class1_probability") * 1000), c[3], c[1], c[2], rgb).alias("value"))


def coding_split(transcripts: DataFrame, orfs: DataFrame, tx: str = "tx") -> tuple[DataFrame, DataFrame]:
    """(coding: one row a frame, thick ends from it; non-coding: transcripts without frame).

    ``_OVERRULED`` marks each overruled row alone.
    """
    picked = orfs.select(F.col(tx).alias("_tx"), "coords", "p", *(["overruled"] if "overruled" in orfs.columns else []))
    c = F.split("coords", r"\|")
    coding = transcripts.join(picked, F.col(tx) == F.col("_tx")).withColumns({"thick_start": c[1].cast("long"), "thick_stop": c[2].cast("long"), "score": F.format_string("%.2f", F.col("p") * 1000)})
    if "overruled" in picked.columns:
        coding = coding.withColumn(tx, F.concat(F.col(tx).cast("string"), F.when(F.col("overruled"), "_OVERRULED").otherwise("")))
    noncoding = transcripts.join(picked.select("_tx"), F.col(tx) == F.col("_tx"), "left_anti")
    return coding.drop("_tx", "coords", "p", "overruled"), noncoding


def coding_kinds(transcripts: DataFrame, orfs: DataFrame, tx: str = "tx") -> DataFrame:
    """Both tables of :func:`coding_split` from one join: rows of the coding ones are ``coding``; ``tx`` is a string."""
    picked = orfs.select(F.col(tx).alias("_tx"), "coords", "p", F.col("overruled") if "overruled" in orfs.columns else F.lit(False).alias("overruled"))
    c, known = F.split("coords", r"\|"), F.col("_tx").isNotNull()
    rows = transcripts.join(picked, F.col(tx) == F.col("_tx"), "left").withColumns(
        {
            "thick_start": F.when(known, c[1].cast("long")).otherwise(F.col("thick_start")),
            "thick_stop": F.when(known, c[2].cast("long")).otherwise(F.col("thick_stop")),
            "score": F.when(known, F.format_string("%.2f", F.col("p") * 1000)).otherwise(F.col("score")),
            "coding": known,
        }
    )
    return rows.withColumn(tx, F.concat(F.col(tx).cast("string"), F.when(F.col("overruled"), "_OVERRULED").otherwise(""))).drop("_tx", "coords", "p", "overruled")


def coding_coordinates(bed: DataFrame) -> DataFrame:
    return bed.withColumn("genomic_coords", S.coordinates(F.col("chrom"), F.col("thick_start"), F.col("thick_stop"), F.col("strand")))
