"""Binary and sorted alignment files: round trips, splits, order, headers, lost tasks."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from readloom.sources import alignments as A
from readloom.sources import tables as T
from readloom.sources.files import found

HEADER = "@HD\tVN:1.6\tSO:coordinate\n@SQ\tSN:chr2\tLN:100000\n@SQ\tSN:chr1\tLN:90000\n@CO\tfree text\n"
PLAIN = "name string, flag int, chrom string, pos bigint, mapq int, cigar string, mate_chrom string, mate_pos bigint, template_length bigint, seq string, quality string, tags array<string>"


def records(n=700, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 7, 50, 90, 300])
        seq = "".join(rng.choice("ACGTN") for _ in range(size)) or "*"
        chrom = rng.choice(["chr1", "chr2", "*"])
        tags = rng.sample(["NM:i:0", "AS:i:-200", "xx:i:70000", "tp:A:P", "cs:Z::6-ata*gc", "de:f:0.25", "zb:B:c,1,-2,3", "zf:B:f,0.5,2", "big:i:4000000000"[0:2] + ":i:4000000000", "he:H:1AE3"], rng.randrange(5))
        cigar = "*" if chrom == "*" or seq == "*" else f"{size}="
        out.append((f"r{i}/{rng.randrange(9)}", rng.choice([0, 16, 4, 272, 2064]), chrom, rng.randrange(1, 80_000) if chrom != "*" else 0, rng.randrange(61), cigar, rng.choice(["*", "=" if chrom != "*" else "*"]), rng.randrange(0, 50), rng.randrange(-500, 500), seq, "*" if rng.random() < 0.3 or seq == "*" else "".join(chr(33 + rng.randrange(60)) for _ in seq), tags))
    # Reads of more than a block, and long introns.
    out.append(("long", 0, "chr1", 5, 60, "3S150000=2N50000X", "*", 0, 0, "ACGTT" * 40_000 + "ACG", "*", ["NM:i:50000"]))
    out.append(("longer", 16, "chr2", 9, 60, "90000=", "*", 0, 0, "GATTA" * 18_000, "I" * 90_000, []))
    return out


def key(rows):
    return sorted(tuple(r[:11]) + (tuple(r[11]),) for r in rows)


def test_round_trip_in_many_partitions(spark, tmp_path):
    rows = records()
    df = spark.createDataFrame(rows, PLAIN)
    A.write_alignments(df.coalesce(1), str(tmp_path / "bam"), HEADER, sort=False)
    assert len(found(str(tmp_path / "bam"), ".bam")) == 1
    for span in (A.RANGE, 20_000, 1_500):
        got = A.read_bam(spark, f"file://{tmp_path}/bam", span=span)
        assert span == A.RANGE or got.rdd.getNumPartitions() > 3
        assert key(got.drop("file_pos").collect()) == key(rows)
    assert got.select("file_pos").distinct().count() == len(rows)
    in_order = [r.name for r in A.read_bam(spark, str(tmp_path / "bam")).orderBy("file_pos").collect()]
    assert in_order == [r[0] for r in rows]


def test_same_rows_as_text_and_told_apart(spark, tmp_path):
    df = spark.createDataFrame(records(60), PLAIN)
    A.write_alignments(df, str(tmp_path / "x"), HEADER, "sam")
    A.write_alignments(df, str(tmp_path / "y"), HEADER, "bam")
    text, binary = T.read_sam(spark, str(tmp_path / "x")), A.read_bam(spark, str(tmp_path / "y"))
    assert key(text.select(*binary.columns).drop("file_pos").collect()) == key(binary.drop("file_pos").collect())
    (tmp_path / "both").mkdir()
    for folder in "xy":
        for path, _ in found(str(tmp_path / folder)):
            (tmp_path / "both" / path.rsplit("/", 1)[1]).write_bytes(open(path, "rb").read())
    assert {r.compressed for r in A.compressed(spark, str(tmp_path / "both")).collect()} == {True, False}
    assert A.read_alignments(spark, str(tmp_path / "both")).count() == 2 * df.count()


@pytest.mark.parametrize("kind", ["bam", "sam"])
def test_header_first_and_coordinate_order(spark, tmp_path, kind):
    df = spark.createDataFrame(records(), PLAIN).repartition(4)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        A.write_alignments(df, str(tmp_path / "out"), HEADER, kind)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    files = [p for p, _ in found(str(tmp_path / "out"))]
    assert len(files) > 2
    order = []
    for path in files:
        if kind == "bam":
            assert A.read_header(path)[:2] == (HEADER, ["chr2", "chr1"])
            rows = A.read_bam(spark, path).orderBy("file_pos").collect()
        else:
            assert open(path).read().startswith(HEADER)
            rows = T.read_sam(spark, path).orderBy("file_pos").collect()
        order += [({"chr2": 0, "chr1": 1}.get(r.chrom, 2), r.pos) for r in rows]
    assert order == sorted(order) and len(order) == df.count()


def test_failed_write_leaves_nothing(spark, tmp_path):
    @F.udf("string")
    def broken(name):
        if name.startswith("r5"):
            raise RuntimeError("this task is lost")
        return name

    df = spark.createDataFrame(records(200), PLAIN).repartition(5)
    with pytest.raises(Exception, match="task is lost"):
        A.write_alignments(df.withColumn("name", broken("name")), str(tmp_path / "out"), HEADER, sort=False)
    assert not (tmp_path / "out").exists() or found(str(tmp_path / "out")) == []
    A.write_alignments(df, str(tmp_path / "out"), HEADER)
    assert A.read_bam(spark, str(tmp_path / "out")).count() == df.count()
    with pytest.raises(Exception, match="FileExistsError|exists"):
        A.write_alignments(df, str(tmp_path / "out"), HEADER)


def test_empty_table_has_its_header(spark, tmp_path):
    A.write_alignments(spark.createDataFrame([], PLAIN), str(tmp_path / "out"), HEADER)
    (path, _), = found(str(tmp_path / "out"))
    assert A.read_header(path)[1] == ["chr2", "chr1"] and A.read_bam(spark, path).count() == 0
    assert open(path, "rb").read().endswith(A.END_OF_FILE)


def test_blocks_and_bins():
    assert struct.unpack("<H", A.compress(b"x")[16:18])[0] + 1 == len(A.compress(b"x"))
    assert [A._bin(0, 1), A._bin(0, 1 << 14), A._bin(0, (1 << 14) + 1), A._bin(1 << 26, (1 << 26) + 1), A._bin(0, 1 << 29)] == [4681, 4681, 585, 4681 + (1 << 12), 0]


def test_codec_keeps_every_letter():
    """Bases by digits: letters of either case, unknown ones as N, odd and even lengths, and CIGARs that are none."""
    for seq, shown in (("=ACMGRSVTWYHKDBN", None), ("acgtnACGT", "ACGTNACGT"), ("AéZ.", "ANNN"), ("A", None), ("", "*"), (None, "*")):
        row = ("r", 16, "b", 7, 60, "12S3=400N1X2H", "*", 0, 0, seq, "*", ["tp:i:5"])
        got = A.decode(A.encode(row, {"a": 0, "b": 1})[4:], ["a", "b"])
        assert got == (*row[:9], shown or seq, "*", ["tp:i:5"])
    for wrong in ("=", "5=X", "5Q"):
        with pytest.raises(ValueError):
            A.encode(("r", 0, "a", 1, 0, wrong, "*", 0, 0, "A", "*", []), {"a": 0})
