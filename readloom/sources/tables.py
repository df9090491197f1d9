"""Readers of the pipeline's text formats, with fixed schemas and the line's place in the data.

Every reader that feeds an order-dependent operator adds ``file_pos``, increasing in file order
within each file; it comes from the scan and costs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BED_WIDTHS = (6, 8, 9, 12)


def lines(spark: SparkSession, path) -> DataFrame:
    """(value, file_pos) of text files; gzip is read as it is."""
    return spark.read.text(path).select("value", F.monotonically_increasing_id().alias("file_pos"))


def _numbers(text):
    return F.split(F.regexp_replace(text, ",$", ""), ",").cast("array<bigint>")


def parse_bed(df: DataFrame, value: str = "value") -> DataFrame:
    """BED lines of 6, 8, 9 or 12 columns; another width or mismatched blocks give ``bed_error`` and nulls."""
    f = F.split(F.col(value), "\t")
    n = F.size(f)
    at = lambda i: F.get(f, F.lit(i))
    number = lambda i: F.expr(f"try_cast(get(split({value}, '\\t'), {i}) as bigint)")
    lens, starts = _numbers(at(10)), _numbers(at(11))
    out = df.withColumns(
        {
            "chrom": at(0),
            "start": number(1),
            "stop": number(2),
            "name": at(3),
            "score": at(4),
            "strand": at(5),
            "thick_start": F.when(n >= 8, number(6)),
            "thick_stop": F.when(n >= 8, number(7)),
            "rgb": F.when(n >= 9, at(8)),
            "block_count": F.when(n >= 12, number(9).cast("int")),
            "block_lens": F.when(n >= 12, lens),
            "block_starts": F.when(n >= 12, starts),
        }
    )
    wrong_width = ~n.isin(*BED_WIDTHS)
    mismatch = (n >= 12) & ((F.size("block_lens") != F.col("block_count")) | (F.size("block_starts") != F.col("block_count")))
    out = out.withColumn("bed_error", F.when(wrong_width, F.concat(F.lit("columns: "), n.cast("string"))).when(mismatch, "block lists differ from the block count"))
    good = F.col("bed_error").isNull()
    return out.withColumns({c: F.when(good, F.col(c)) for c in ("chrom", "start", "stop", "name", "score", "strand", "thick_start", "thick_stop", "rgb", "block_count", "block_lens", "block_starts")})


def read_bed(spark: SparkSession, path) -> DataFrame:
    return parse_bed(lines(spark, path)).drop("value")


def render_bed(df: DataFrame, width: int = 12) -> DataFrame:
    """One ``value`` column of BED lines of the given width."""
    columns = ["chrom", "start", "stop", "name", "score", "strand", "thick_start", "thick_stop", "rgb"][: min(width, 9)]
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in columns]
    if width == 12:
        join = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
        parts += [F.size("block_lens").cast("string"), join("block_lens"), join("block_starts")]
    return df.select(F.concat_ws("\t", *parts).alias("value"))


def last_by_key(df: DataFrame, key: str, order: str = "file_pos") -> DataFrame:
    """One row a key, the last in file order, as an index by id keeps it."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("r")).select(key, "r.*")


def read_fasta(spark: SparkSession, path, whole_header: bool = False) -> DataFrame:
    """(id, seq, file_pos): records split at ``>``; the id is the first word of the header, or all of it."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value"), F.monotonically_increasing_id().alias("file_pos"))
    head = F.trim(F.substring_index("value", "\n", 1))
    body = F.expr("substring(value, length(substring_index(value, '\n', 1)) + 1)")
    return records.where(F.trim("value") != "").select((head if whole_header else F.split(head, r"\s+")[0]).alias("id"), F.regexp_replace(body, r"\s", "").alias("seq"), "file_pos")


def parse_sam(df: DataFrame, value: str = "value") -> DataFrame:
    """Alignment lines with the eleven fixed columns and the tags; header lines (@) are left out."""
    f = F.split(F.col(value), "\t")
    kinds = {"flag": "int", "pos": "bigint", "mapq": "int", "mate_pos": "bigint", "template_length": "bigint"}
    columns = {c: F.get(f, F.lit(i)).cast(kinds.get(c, "string")) for i, c in enumerate(SAM_COLUMNS)}
    columns["tags"] = F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0)))
    return df.where(~F.col(value).startswith("@")).withColumns(columns)


def read_sam(spark: SparkSession, path) -> DataFrame:
    return parse_sam(lines(spark, path)).drop("value")


def sam_header(spark: SparkSession, path) -> DataFrame:
    """The header lines, to stand before each output of a split."""
    return lines(spark, path).where(F.col("value").startswith("@"))


SAM_COLUMNS = ("name", "flag", "chrom", "pos", "mapq", "cigar", "mate_chrom", "mate_pos", "template_length", "seq", "quality")


def sam_line():
    """An alignment as its line of text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("*")) for c in SAM_COLUMNS]
    return F.concat_ws("\t", *parts, F.when(F.size("tags") > 0, F.array_join("tags", "\t")))


def render_sam(df: DataFrame) -> DataFrame:
    return df.select(sam_line().alias("value"))


def sam_spans(df: DataFrame) -> DataFrame:
    """Alignments as spans: chrom, start, stop, name, mapq, strand (bit 0x10 of the flag)."""
    from ..functions import cigar as C

    ops = C.parse(F.col("cigar"))
    start = F.col("pos") - 1
    return df.select("chrom", start.alias("start"), (start + C.reference_span(ops)).alias("stop"), "name", "mapq", F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+").alias("strand"))


def sam_to_bed12(df: DataFrame) -> DataFrame:
    """Alignments as BED12, blocks split at introns."""
    from ..functions import cigar as C

    blocks = C.aligned_blocks(F.col("pos"), C.parse(F.col("cigar")))
    df = df.withColumn("_b", blocks)
    start, stop = F.col("pos") - 1, F.element_at("_b", -1)["stop"]
    return df.select(
        "chrom",
        start.alias("start"),
        stop.alias("stop"),
        "name",
        F.col("mapq").cast("string").alias("score"),
        F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+").alias("strand"),
        start.alias("thick_start"),
        stop.alias("thick_stop"),
        F.lit("255,0,0").alias("rgb"),
        F.size("_b").alias("block_count"),
        F.transform("_b", lambda b: b["stop"] - b["start"]).alias("block_lens"),
        F.transform("_b", lambda b: b["start"] - start).alias("block_starts"),
    )


def bed12_to_exons(df: DataFrame) -> DataFrame:
    """One row a block in genome order: chrom, start, stop, name, score, strand, exon_no."""
    keep = [c for c in ("chrom", "name", "score", "strand", "file_pos") if c in df.columns]
    zipped = F.arrays_zip(F.col("block_starts").alias("s"), F.col("block_lens").alias("n"))
    out = df.select(*keep, F.col("start").alias("tx_start"), F.col("stop").alias("tx_stop"), F.posexplode(zipped).alias("exon_no", "b"))
    start = F.col("tx_start") + F.col("b.s")
    return out.select(*keep, "tx_start", "tx_stop", F.col("exon_no").cast("long").alias("exon_no"), start.alias("start"), (start + F.col("b.n")).alias("stop"))


HIT_SCHEMA = "qid string, sid string, pid double, length long, mismatches long, gaps long, qstart long, qend long, sstart long, send long, evalue double, bits double"


def _tsv(spark: SparkSession, path, schema: str, header: bool = False) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema, header=header)


def read_hits(spark: SparkSession, path) -> DataFrame:
    """Twelve-column protein hits, with the whole line for first-hit selection."""
    f = F.split("value", "\t")
    fields = [x.strip().split(" ") for x in HIT_SCHEMA.split(",")]
    return lines(spark, path).select("value", "file_pos", *[F.get(f, F.lit(i)).cast(kind).alias(name) for i, (name, kind) in enumerate(fields)])


def read_orf_finder(spark: SparkSession, path, transdecoder: bool = False) -> DataFrame:
    """(id, start, stop, strand) of ORF-finder BED lines, or the coding rows of the GFF-like variant."""
    f = F.split("value", "\t")
    at = lambda i: F.get(f, F.lit(i))
    if transdecoder:
        rows = lines(spark, path).where(at(7) == "CDS")
        return rows.select(F.expr("substring(get(split(value, '\t'), 3), 5)").alias("id"), at(1).cast("long").alias("start"), at(2).cast("long").alias("stop"), at(6).alias("strand"), "file_pos")
    name = F.replace(F.expr("substring(split(get(split(value, '\t'), 3), ';')[0], 4)"), F.lit("_ORF."), F.lit(".p"))
    return lines(spark, path).select(name.alias("id"), at(1).cast("long").alias("start"), at(2).cast("long").alias("stop"), at(5).alias("strand"), "file_pos")


def read_gff_coding(spark: SparkSession, path) -> DataFrame:
    """Coding rows with the end of the gene row before them on their chromosome, in file order within each file.

    The gene is carried within each task's part of a file, and from part to part by one row each.
    """
    f = F.split("value", "\t")
    at = lambda i: F.get(f, F.lit(i))
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("file_pos")).where(~F.col("value").startswith("#"))
    rows = rows.select(at(0).alias("chrom"), at(2).alias("kind"), at(3).cast("long").alias("start"), at(4).cast("long").alias("stop"), at(6).alias("strand"), F.substring(F.split(at(8), ";")[0], 8, 1 << 30).alias("id"), "file", "file_pos", F.shiftright("file_pos", 33).alias("_part")).where(F.col("kind").isin("gene", "CDS"))
    gene = F.when(F.col("kind") == "gene", F.col("stop"))
    within = W.partitionBy("file", "chrom", "_part").orderBy("file_pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = rows.groupBy(F.col("file").alias("_f"), F.col("chrom").alias("_c"), F.col("_part").alias("_p")).agg(F.max_by(gene, F.when(gene.isNotNull(), F.col("file_pos"))).alias("_gene"))
    before = F.last("_gene", ignorenulls=True).over(W.partitionBy("_f", "_c").orderBy("_p").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("_f", "_c", "_p", before.alias("_before"))
    joined = rows.join(parts, (F.col("file") == F.col("_f")) & (F.col("chrom") == F.col("_c")) & (F.col("_part") == F.col("_p")))
    carried = joined.withColumn("final_stop", F.coalesce(F.last(gene, ignorenulls=True).over(within), F.col("_before")))
    return carried.where("kind = 'CDS'").select("chrom", "start", "stop", "strand", "id", "file_pos", "final_stop")


def read_nested_orfs(spark: SparkSession, path) -> DataFrame:
    """(id, nested, offset) of ``>tx.p1_ORF2<TAB>offset`` lines."""
    from ..functions.sequence import nested_number

    f = F.split("value", "\t")
    name = F.regexp_replace(F.get(f, F.lit(0)), "^>", "")
    return lines(spark, path).select(name.alias("id"), nested_number(name).alias("nested"), F.get(f, F.lit(1)).cast("int").alias("offset"), "file_pos")


def parse_predictions(df: DataFrame, value: str = "value") -> DataFrame:
    """Start/stop predictions: one row a variant (id, variant, orf_start, orf_stop, p_start, p_stop)."""
    f = F.split(F.col(value), "\t")
    key = F.split(F.split(F.get(f, F.lit(0)), r"\(")[2], r"\)")[0]
    variants = F.filter(F.slice(f, F.lit(2), F.greatest(F.size(f) - 1, F.lit(0))), lambda x: x != "")
    out = df.select(key.alias("id"), F.posexplode(variants).alias("variant", "v"))
    part = lambda i: F.split("v", ",")[i]
    return out.select("id", "variant", part(0).cast("long").alias("orf_start"), part(1).cast("long").alias("orf_stop"), part(2).cast("double").alias("p_start"), part(3).cast("double").alias("p_stop"))


def read_clean_predictions(spark: SparkSession, path) -> DataFrame:
    """(id, start_score, stop_score); the last line of an id counts."""
    f = F.split("value", "\t")
    rows = lines(spark, path).select(F.get(f, F.lit(0)).alias("id"), F.get(f, F.lit(3)).cast("double").alias("start_score"), F.get(f, F.lit(4)).cast("double").alias("stop_score"), "file_pos")
    return last_by_key(rows, "id").drop("file_pos")


def read_projection_meta(spark: SparkSession, path, header: bool = False) -> DataFrame:
    """(toga_id, toga_label, toga_pid, toga_blosum); gzip or plain, with or without header."""
    return _tsv(spark, path, "toga_id string, toga_label string, toga_pid double, toga_blosum double", header)


def read_masking(spark: SparkSession, path) -> DataFrame:
    """(projection, masked) from a table with header: columns 0 and 6."""
    rows = _tsv(spark, path, "projection string, a string, b string, c string, d string, e string, query_codon string", True)
    return rows.select("projection", (F.col("query_codon") == "MASKED").alias("masked"))


def annotation_coordinates(bed: DataFrame) -> DataFrame:
    """(toga_id, toga_coords) of annotated projections, from their coding (thick) ends."""
    from ..functions.sequence import coordinates

    return bed.select(F.col("name").alias("toga_id"), coordinates(F.col("chrom"), F.col("thick_start"), F.col("thick_stop"), F.col("strand")).alias("toga_coords"))


def read_multiplex_index(spark: SparkSession, path) -> DataFrame:
    """(sequence, ids) of an index file with ids joined by the separator U+237D."""
    f = F.split("value", "\t")
    return lines(spark, path).select(F.get(f, F.lit(0)).alias("sequence"), F.split(F.get(f, F.lit(1)), "⍽").alias("ids"))


def list_files(spark: SparkSession, folder: str, ending: str = ".bam") -> DataFrame:
    """Paths in a folder (not below) that end so, whatever the case."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder).select("path", "length")
    return rows.where(F.lower("path").endswith(ending.lower()))
