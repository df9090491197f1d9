"""Transcript-shaped tables derived from the test data, and the same derivations as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as exons, without their number: chrom, strand, tx, tx_start, len, gap and the columns that order them."""
    li = table(spark, sf_dir, "lineitem")
    tx = F.col("l_orderkey")
    return li.select(
        tx.alias("tx"),
        F.concat(F.lit("chr"), (tx % 7).cast("string")).alias("chrom"),
        F.when(tx % 2 == 0, "+").otherwise("-").alias("strand"),
        ((tx * 37) % 100000).alias("tx_start"),
        (F.lit(30) + F.col("l_quantity").cast("int") * 3).cast("long").alias("len"),
        (F.lit(20) + F.col("l_partkey") % 180).alias("gap"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_shipdate",
    )


ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def numbered(spark: SparkSession, sf_dir: str, key: str = "tx") -> DataFrame:
    """Exons with their number, the bases and gaps before them (rel), the exons of their transcript (blocks) and the columns that order them.

    Dealt by ``key`` (``tx``, or ``name`` for joins by name) and sorted once: what follows by the same key and order needs no
    other shuffle or sort. What a line item's columns tell is derived beyond the shuffle.
    """
    li = table(spark, sf_dir, "lineitem")
    tx = F.col("l_orderkey")
    rows = li.select(tx.alias("tx") if key == "tx" else tx.cast("string").alias("name"), F.col("l_quantity").cast("int").alias("_quantity"), *ORDER)
    rows = rows.withColumns({"len": (F.lit(30) + F.col("_quantity") * 3).cast("long"), "gap": F.lit(20) + F.col("l_partkey") % 180})
    w = W.partitionBy(key).orderBy(*ORDER)
    rows = rows.withColumns(
        {
            "exon_no": (F.row_number().over(w) - 1).cast("long"),
            "rel": F.coalesce(F.sum(F.col("len") + F.col("gap")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "blocks": F.count("*").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        }
    )
    rows = rows.withColumn("name", F.col("tx").cast("string")) if key == "tx" else rows.withColumn("tx", F.col("name").cast("long"))
    tx = F.col("tx")
    rows = rows.withColumns({"chrom": F.concat(F.lit("chr"), (tx % 7).cast("string")), "strand": F.when(tx % 2 == 0, "+").otherwise("-"), "tx_start": (tx * 37) % 100000})
    return rows.withColumns({"s": F.col("tx_start") + F.col("rel"), "e": F.col("tx_start") + F.col("rel") + F.col("len")})


def gathered(rows: DataFrame, key: str = "tx", **columns) -> DataFrame:
    """One row a transcript (its first exon) of :func:`numbered` rows, with ``columns`` over all of its exons, lists in their order."""
    whole = W.partitionBy(key).orderBy(*ORDER).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return rows.withColumns({c: x.over(whole) for c, x in columns.items()}).where("exon_no = 0")


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, s, e, tx, exon_no, strand, len, gap, tx_start, rel."""
    return numbered(spark, sf_dir).select("tx", "chrom", "strand", "tx_start", "len", "gap", "exon_no", "rel", "s", "e")


def bed12(gathered: DataFrame, *more: str) -> DataFrame:
    """BED12 rows of transcripts whose blocks (s, e) are gathered as ``x``, with tx and ``more`` columns."""
    start = F.get("x", F.lit(0))["s"]
    stop = F.array_max(F.transform("x", lambda b: b["e"]))
    return gathered.select(
        "tx",
        "chrom",
        start.alias("start"),
        stop.alias("stop"),
        "name",
        F.lit("0").alias("score"),
        "strand",
        start.alias("thick_start"),
        stop.alias("thick_stop"),
        F.lit("0").alias("rgb"),
        F.size("x").alias("block_count"),
        F.transform("x", lambda b: b["e"] - b["s"]).alias("block_lens"),
        F.transform("x", lambda b: b["s"] - start).alias("block_starts"),
        *more,
    )


def transcripts(spark: SparkSession, sf_dir: str, key: str = "tx") -> DataFrame:
    """BED12 rows of the transcripts, with tx as a number beside the name."""
    return bed12(gathered(numbered(spark, sf_dir, key), key, x=F.collect_list(F.struct("s", "e"))))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment rows: name, flag, chrom, pos, mapq, cigar, seq, tags."""
    last = F.col("exon_no") == F.col("blocks") - 1
    piece = F.concat((F.col("len") - 1).cast("string"), F.lit("="), F.when(F.col("gap") % 3 == 0, "1X").otherwise("1="), F.when(last, "").otherwise(F.concat(F.col("gap").cast("string"), F.lit("N"))))
    g = gathered(numbered(spark, sf_dir), x=F.collect_list(piece))
    cigar = F.concat((F.col("tx") % 30).cast("string"), F.lit("S"), F.array_join("x", ""), (F.col("tx") % 45).cast("string"), F.lit("S"))
    right, left = (F.col("tx") % 45).cast("int"), (F.col("tx") % 30).cast("int")
    # Both clips are A's (or T's read backwards) after a few other bases.
    seq = F.concat(F.repeat(F.lit("T"), left), F.lit("GATTACAGATTACA"), F.repeat(F.lit("C"), (F.col("tx") % 5).cast("int")), F.repeat(F.lit("A"), right))
    return g.select("tx", "name", F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"), "chrom", (F.col("tx_start") + 1).alias("pos"), F.lit(60).alias("mapq"), cigar.alias("cigar"), seq.alias("seq"), F.array().cast("array<string>").alias("tags"))


def odd_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignments with unmapped reads, hard clips, supplementary and secondary flags; a third of each clip is no tail."""
    k, left, right = F.col("tx") % 11, (F.col("tx") % 30).cast("int"), (F.col("tx") % 45).cast("int")
    part = lambda n: F.floor(n / 3).cast("int")
    seq = F.concat(F.repeat(F.lit("T"), left - part(left)), F.repeat(F.lit("G"), part(left)), F.lit("GATTACAGATTACA"), F.repeat(F.lit("C"), part(right)), F.repeat(F.lit("A"), right - part(right)))
    flag = F.when(k == 0, 4).when(k == 2, 2064).when(k == 3, 272).otherwise(F.col("flag")).cast("int")
    return alignments(spark, sf_dir).withColumns({"flag": flag, "seq": seq, "cigar": F.when(k == 1, F.regexp_replace("cigar", "S$", "H")).otherwise(F.col("cigar"))})


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, seq: whole texts as bases with an A tail."""
    letters = F.upper(F.regexp_replace("text", "[^a-zA-Z]+", ""))
    seq = F.concat(F.translate(letters, "BDEFHIJKLMNOPQRSUVWXYZ", "CGTACGTACGTACGTACGTACG"), F.repeat(F.lit("A"), (F.col("n_chars") % 40).cast("int")))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", seq.alias("seq"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protein-search hits: qid, sid, pid, qstart, qend, sstart, log10_e, ln."""
    li = table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey")
    return li.select(
        F.col("l_orderkey").alias("qid"),
        part.alias("sid"),
        (F.lit(50.0) + (part % 500).cast("double") / 10).alias("pid"),
        (part % 50 + 1).alias("qstart"),
        (part % 50 + 21 + F.col("l_quantity").cast("long")).alias("qend"),
        (F.col("l_suppkey") % 60 + 1).alias("sstart"),
        (F.lit(-10) - F.col("l_suppkey") % 90).alias("log10_e"),
        F.col("l_linenumber").cast("long").alias("ln"),
    )


def predictions(spark: SparkSession, sf_dir: str, *more: str, key: str = "tx") -> DataFrame:
    """tx, coords, p of frames, one an exon, and ``more`` of the exon's columns; dealt by ``key``."""
    e = numbered(spark, sf_dir, key)
    p = ((F.col("tx") * 7919 + F.col("exon_no") * 613 + F.col("s")) % 1000).cast("double") / 1000
    return e.select("tx", "exon_no", F.concat_ws("|", "chrom", F.col("s").cast("string"), F.col("e").cast("string"), "strand").alias("coords"), p.alias("p"), *more)


def transcript_sequences(spark: SparkSession, sf_dir: str, key: str = "tx") -> DataFrame:
    """id, tx, seq: bases of every transcript in reading direction, drawn from digests of its exons."""
    digest = F.concat(*[F.sha2(F.concat_ws(":", "name", F.col("exon_no").cast("string"), F.lit(k)), 256) for k in "012"])
    bases = F.substring(F.translate(digest, "0123456789abcdef", "ACGTACGTACGTACGT"), F.lit(1), F.col("len").cast("int"))
    return gathered(numbered(spark, sf_dir, key), key, x=F.collect_list(bases)).select(F.col("name").alias("id"), "tx", F.array_join("x", "").alias("seq"))


#: The derivations in the oracle's dialect, to stand before a query.
SQL = """
WITH fx_raw AS (
  SELECT l_orderkey AS tx, 'chr' || CAST(l_orderkey % 7 AS VARCHAR) AS chrom,
    CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, (l_orderkey * 37) % 100000 AS tx_start,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS exon_no,
    CAST(30 + CAST(l_quantity AS INT) * 3 AS BIGINT) AS len, 20 + l_partkey % 180 AS gap
  FROM lineitem
), fx_exons AS (
  SELECT *, tx_start + rel AS s, tx_start + rel + len AS e FROM (
    SELECT *, CAST(coalesce(sum(len + gap) OVER (PARTITION BY tx ORDER BY exon_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rel FROM fx_raw)
), fx_tx AS (
  SELECT chrom, tx, strand, min(s) AS s, max(e) AS e, count(*) AS blocks, CAST(sum(e - s) AS BIGINT) AS exonic FROM fx_exons GROUP BY chrom, tx, strand
), fx_cum AS (
  SELECT *, CAST(coalesce(sum(len) OVER (PARTITION BY tx ORDER BY exon_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
    CAST(sum(len) OVER (PARTITION BY tx) AS BIGINT) AS exonic
  FROM fx_exons
), fx_sam AS (
  SELECT tx, chrom, strand, CASE WHEN strand = '-' THEN 16 ELSE 0 END AS flag, min(tx_start) + 1 AS pos,
    CAST(tx % 30 AS VARCHAR) || 'S' || string_agg(CAST(len - 1 AS VARCHAR) || '=' || CASE WHEN gap % 3 = 0 THEN '1X' ELSE '1=' END || CASE WHEN exon_no < last THEN CAST(gap AS VARCHAR) || 'N' ELSE '' END, '' ORDER BY exon_no) || CAST(tx % 45 AS VARCHAR) || 'S' AS cigar,
    CAST(sum(len) AS BIGINT) AS aligned, CAST(sum(CASE WHEN gap % 3 = 0 THEN len - 1 ELSE len END) AS BIGINT) AS matches, max(e) - min(s) AS span
  FROM (SELECT *, max(exon_no) OVER (PARTITION BY tx) AS last FROM fx_exons) GROUP BY tx, chrom, strand
), fx_reads AS (
  SELECT doc_id, lang, translate(upper(regexp_replace(text, '[^a-zA-Z]', '', 'g')), 'BDEFHIJKLMNOPQRSUVWXYZ', 'CGTACGTACGTACGTACGTACG') || repeat('A', CAST(n_chars % 40 AS INT)) AS seq FROM documents
), fx_hits AS (
  SELECT l_orderkey AS qid, l_partkey AS sid, 50.0e0 + CAST(l_partkey % 500 AS DOUBLE) / 10 AS pid, l_partkey % 50 + 1 AS qstart, l_partkey % 50 + 21 + CAST(l_quantity AS BIGINT) AS qend,
    l_suppkey % 60 + 1 AS sstart, -10 - l_suppkey % 90 AS log10_e, CAST(l_linenumber AS BIGINT) AS ln
  FROM lineitem
), fx_txseq AS (
  SELECT tx, CAST(tx AS VARCHAR) AS id, string_agg(substr(translate(sha256(tx || ':' || exon_no || ':0') || sha256(tx || ':' || exon_no || ':1') || sha256(tx || ':' || exon_no || ':2'), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, CAST(len AS INT)), '' ORDER BY exon_no) AS seq
  FROM fx_exons GROUP BY tx
), fx_pred AS (
  SELECT tx, exon_no, concat_ws('|', chrom, CAST(s AS VARCHAR), CAST(e AS VARCHAR), strand) AS coords, CAST((tx * 7919 + exon_no * 613 + s) % 1000 AS DOUBLE) / 1000 AS p FROM fx_exons
)
"""
