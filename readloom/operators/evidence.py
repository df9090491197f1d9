"""Evidence about reading frames: deduplicated searches, hit metrics, nesting, predictions, projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import blocks as B
from ..functions import sequence as S
from ..session import written


def multiplex(records: DataFrame, order: str = "file_pos") -> tuple[DataFrame, DataFrame]:
    """Distinct sequences for an external search, (sequence, seq), and their index, (sequence, id, place).

    ``sequence_i`` counts by first occurrence. Sequences meet by a 256-bit digest; each travels once to be told, and an
    index row holds one id, however many share a sequence. Numbers come from range-partitioned positions and partition
    offsets, so no task holds all rows.
    """
    keyed = records.withColumn("_digest", F.unhex(F.sha2(F.col("seq").cast("binary"), 256)))
    first = number_rows(keyed.groupBy("_digest").agg(F.min(order).alias("_first")), "_first")
    named = written(first.select("_digest", "_first", F.concat(F.lit("sequence_"), F.col("row_no").cast("string")).alias("sequence")))
    # The digest of a null sequence is null; it is a sequence of its own.
    index = keyed.drop("seq").join(named.select(F.col("_digest").alias("_d"), "sequence"), F.col("_digest").eqNullSafe(F.col("_d"))).select("sequence", "id", F.col(order).alias("place"))
    told = records.select("seq", F.col(order).alias("_first")).join(named.select("_first", "sequence"), "_first").select("sequence", "seq").dropDuplicates(["sequence"])
    return told, index


def index_lists(index: DataFrame) -> DataFrame:
    """(sequence, ids), the ids of a sequence in order: the form of an index file, whose lines hold all ids."""
    return index.groupBy("sequence").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("_m")).select("sequence", F.transform("_m", lambda x: x["id"]).alias("ids"))


def number_rows(df: DataFrame, order: str) -> DataFrame:
    """Global row numbers from 0 in the order of a column, without a single-partition window."""
    spark = df.sparkSession
    sorted_ = df.repartitionByRange(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), order).withColumn("_part", F.spark_partition_id())
    local = written(sorted_.withColumn("_in", F.row_number().over(W.partitionBy("_part").orderBy(order)) - 1))  # partition numbers must be the same in both uses
    counts = local.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("_offset", before).drop("count")  # one row a partition
    return local.join(F.broadcast(offsets), "_part").withColumn("row_no", (F.col("_in") + F.col("_offset")).cast("long")).drop("_part", "_in", "_offset")


def collapse_ratio(records: DataFrame) -> DataFrame:
    """Distinct over all sequences; null without records."""
    return records.agg(F.try_divide(F.count_distinct("seq").cast("double"), F.count("*").cast("double")).alias("ratio"))


def demultiplex(hits: DataFrame, index: DataFrame, qid: str = "qid") -> DataFrame:
    """Hits of each distinct sequence repeated for its ids, by index rows (sequence, id); hits of unknown sequences get a null id."""
    return hits.join(index.select(F.col("sequence").alias("_s"), F.col("id").alias("_id")), F.col(qid) == F.col("_s"), "left").select(*[c for c in hits.columns if c != qid], F.col("_id").alias(qid))


def first_hit(hits: DataFrame, line: str, key: str = "qid") -> DataFrame:
    """The hit of each query whose whole line sorts first (binary order), not the best scoring."""
    rest = F.struct(*[F.col(c) for c in hits.columns if c != key])
    return hits.groupBy(key).agg(F.min_by(rest, F.col(line)).alias("h")).select(key, "h.*")


def hit_metrics(hits: DataFrame, lengths: DataFrame) -> DataFrame:
    """Offset of subject against query and the aligned share; lengths(id, length) is joined by query."""
    rows = hits.join(lengths.select(F.col("id").alias("qid"), F.col("length").alias("query_length")), "qid")
    aligned = F.col("qend") - F.col("qstart") + 1
    return rows.withColumns({"offset": F.col("sstart") - F.col("qstart"), "aligned": aligned, "percentage_aligned": F.try_divide(aligned.cast("double"), F.col("query_length").cast("double"))})


def query_lengths(fasta: DataFrame) -> DataFrame:
    """Protein lengths without the terminal character."""
    return fasta.select("id", F.greatest(F.length("seq") - 1, F.lit(0)).alias("length"))


def nested_offsets(orfs: DataFrame, tx: str = "canonical_id", order: str = "file_pos") -> DataFrame:
    """Distance of a nested frame's coding edge from its top-level frame's, over that one's length.

    The last top-level frame (nested = 0) before a row in file order is its top; zero length gives 0.
    """
    w = W.partitionBy(tx).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = F.when(F.col("strand") == "-", F.col("stop")).otherwise(F.col("start"))
    top = F.last(F.when(F.col("nested") == 0, F.struct(edge.alias("edge"), F.col("length").alias("length"))), ignorenulls=True).over(w)
    rows = orfs.withColumn("_top", top)
    offset = F.try_divide(F.abs(edge - F.col("_top.edge")).cast("double"), F.nullif(F.col("_top.length").cast("double"), F.lit(0.0)))
    return rows.withColumn("nested_offset", F.coalesce(offset, F.lit(0.0))).drop("_top")


def enumerate_orfs(transcripts: DataFrame, orfs: DataFrame) -> DataFrame:
    """Frames ``tx.p1, tx.p2, ...`` of transcripts, up to the first missing number; antisense frames count but are not returned."""
    parts = orfs.withColumns({"tx": F.regexp_replace("id", r"\.p[0-9]+$", ""), "x": F.regexp_extract("id", r"\.p([0-9]+)$", 1).cast("long")})
    w = W.partitionBy("tx").orderBy("x")
    parts = parts.dropDuplicates(["tx", "x"]).withColumn("_k", F.row_number().over(w)).where("_k = x").drop("_k")
    return transcripts.join(parts, "tx").where("orf_strand = '+'")


def merge_evidence(blast: DataFrame, predicted: DataFrame) -> DataFrame:
    """Full outer join of two evidence tables keyed (genomic_coords, canonical_id)."""
    return blast.join(predicted, ["genomic_coords", "canonical_id"], "full")


def projection_evidence(overlaps: DataFrame, meta: DataFrame, coords: DataFrame, mask: DataFrame) -> DataFrame:
    """Overlapping projections with label, identity, coordinates and masking; several rows an id are kept."""
    known = coords.join(meta, "toga_id")
    mask = mask.distinct().groupBy("projection").agg(F.min("masked").alias("toga_masked")) if "file_pos" not in mask.columns else first_mask(mask)
    rows = overlaps.join(known, "toga_id", "left").join(mask.withColumnRenamed("projection", "toga_id"), "toga_id", "left")
    return rows.withColumn("toga_masked", F.coalesce("toga_masked", F.lit(False)))


def first_mask(mask: DataFrame) -> DataFrame:
    """One row a projection, the first in file order."""
    return mask.groupBy("projection").agg(F.min_by("masked", "file_pos").alias("toga_masked"))


def attach_projections(evidence: DataFrame, projections: DataFrame) -> DataFrame:
    return evidence.join(projections, ["genomic_coords", "canonical_id"], "left")


SENTINELS = {"toga_overlap_bp": -1, "toga_masked": False, "blast_id": "X", "toga_id": "X", "translationAI_id": "X", "toga_label": "X", "blast_nested": -1}


def fill_sentinels(df: DataFrame, others: float = 0) -> DataFrame:
    """The fixed stand-ins for missing evidence, and 0 for every other missing value."""
    named = {c: v for c, v in SENTINELS.items() if c in df.columns}
    return df.na.fill(named).na.fill(others).na.fill("0")


def prediction_bed(transcripts: DataFrame, predictions: DataFrame, first_gets_codon: int = 3) -> DataFrame:
    """Transcripts trimmed to predicted frames: ``orf_start`` bases upstream, what follows ``orf_stop`` downstream.

    The first variant's stop is moved by ``first_gets_codon`` bases, later ones' are not.
    """
    rows = transcripts.join(predictions, transcripts.name == predictions.id)
    stop = F.col("orf_stop") + F.when(F.col("variant") == 0, first_gets_codon).otherwise(0)
    rows = rows.withColumns({"_cut": B.total(F.col("block_lens")) - stop, "name": F.concat_ws("_", "name", F.col("variant").cast("string")), "score": ((F.col("p_start") + F.col("p_stop")) / 2 * 1000).cast("int").cast("string")})
    return B.trim_ends(rows, F.col("orf_start"), F.col("_cut")).drop("_cut")


def predictions_on_bed(predictions: DataFrame, bed: DataFrame) -> DataFrame:
    """Scores of predictions (id, start_score, stop_score) with the coordinates of their trimmed blocks; ids are ``tx_variant``.

    (translationAI_coords, translationAI_id, translationAI_orf_start, translationAI_orf_stop); blocks without prediction are left out.
    """
    rows = bed.select("chrom", "start", "stop", "strand", "name").join(predictions, F.col("name") == F.col("id"))
    coords = S.coordinates(F.col("chrom"), F.col("start"), F.col("stop"), F.col("strand"))
    return rows.select(coords.alias("translationAI_coords"), F.regexp_replace("name", "_[^_]*$", "").alias("translationAI_id"), F.col("start_score").alias("translationAI_orf_start"), F.col("stop_score").alias("translationAI_orf_stop"))


def in_phase(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines whose last column is ``+``."""
    return lines.where(F.trim(F.substring_index(value, "\t", -1)) == "+")


def nested_coding(orfs: DataFrame, nested: DataFrame) -> DataFrame:
    """Nested frames cut out of their exported frames: ``offset`` codons and the start codon go from the 5' end.

    Malformed results are kept apart by ``trim_error``.
    """
    rows = orfs.join(nested.select(F.regexp_replace("id", r"_ORF[0-9]+$", "").alias("_id"), F.col("id").alias("nested_id"), "nested", "offset"), F.col("name") == F.col("_id")).drop("_id")
    rows = B.trim_upstream(rows, F.when(F.col("nested") > 0, F.col("offset") * 3 + 1).otherwise(0))
    shift = F.when((F.col("nested") > 0) & F.col("trim_error").isNull(), 1).otherwise(0)  # the strand's own one-base fix
    rows = rows.withColumns({"start": F.col("start") - F.when(F.col("strand") == "+", shift).otherwise(0), "stop": F.col("stop") + F.when(F.col("strand") == "-", shift).otherwise(0)})
    bad = F.when(F.col("trim_error").isNotNull(), F.col("trim_error")).when(F.col("stop") < F.col("start"), "stop before start").when(F.size("block_lens") == 0, "no block")
    return rows.withColumn("trim_error", bad)


def headers_for_predictor(fasta: DataFrame, bed: DataFrame, strip_prefix: str = "") -> DataFrame:
    """FASTA records renamed to the predictor's header; an id without BED row is an error."""
    bed = bed.select(F.col("name").alias("_n"), "chrom", "start", "stop", "strand")
    clean = F.regexp_replace("id", "^" + strip_prefix, "") if strip_prefix else F.col("id")
    rows = fasta.withColumn("_id", clean).join(bed, F.col("_id") == F.col("_n"), "left")
    found = F.when(F.col("_n").isNull(), F.raise_error(F.concat(F.lit("no BED row for "), "_id"))).otherwise(S.predictor_header(F.col("chrom"), F.col("start"), F.col("stop"), F.col("strand"), F.col("_n")))
    return rows.select(found.alias("header"), "seq")
