"""Packed sequences and slices by offsets, against the sequences themselves."""

import random
import time

import pytest

from readloom.sources import genomes as G
from readloom.sources.files import Parts, found


def sequences(seed=3):
    rng = random.Random(seed)
    out = {"empty": "", "one": "a", "n": "N" * 9, "mixed": "ACgtNNnnACGTRYacgtT"}
    for i in range(12):
        out[f"chr{i}"] = "".join(rng.choice(["ACGT"[rng.randrange(4)] * rng.randrange(1, 4), "nnN", "acgt", "N", "GATTACA"]) for _ in range(rng.randrange(1, 400)))
    return out


def plain(seq):
    """As packed sequences give it back: other letters are N, lower case stays."""
    return "".join(c if c.upper() in "ACGT" else ("n" if c.islower() else "N") for c in seq)


def revcomp(s):
    return s[::-1].translate(str.maketrans("ATGCatgc", "TACGtacg"))


@pytest.fixture
def genome(spark, tmp_path):
    seqs = sequences()
    G.write_twobit(spark.createDataFrame(list(seqs.items()), "chrom string, seq string").repartition(3), str(tmp_path / "two"))
    (tmp_path / "fa").mkdir()
    with open(tmp_path / "fa" / "a.fa", "w") as f:
        for name, s in list(seqs.items())[:7]:
            f.write(f">{name} x>y\n" + "".join(s[i : i + 7] + "\n" for i in range(0, len(s), 7)))
    with open(tmp_path / "fa" / "b.fasta", "wb") as f:
        for name, s in list(seqs.items())[7:]:
            f.write(f">{name}\r\n".encode() + b"\r\n".join(s[i : i + 11].encode() for i in range(0, len(s), 11)) + b"\r\n")
    return seqs, tmp_path


def test_packed_round_trip_in_stretches(spark, genome):
    seqs, path = genome
    assert len(found(str(path / "two"), ".2bit")) > 1
    for stretch, partition in ((7, 21), (1 << 16, 1 << 24)):
        rows = G.read_twobit(spark, f"file://{path}/two", stretch=stretch, partition=partition)
        got = {r.chrom: r.seq for r in G.whole_sequences(rows).collect()}
        assert got == {k: plain(s) for k, s in seqs.items()}
    assert G.read_twobit(spark, str(path / "two"), stretch=7, partition=21).rdd.getNumPartitions() > 50
    G.write_twobit(spark.createDataFrame([], "chrom string, seq string"), str(path / "none"))
    with pytest.raises(Exception, match="FileExistsError|exists"):
        G.write_twobit(spark.createDataFrame([("c", "A")], "chrom string, seq string"), str(path / "two"))


def test_big_endian_file(spark, tmp_path):
    """The signature tells the order of the bytes."""
    import struct

    body = struct.pack(">I", 5) + struct.pack(">III", 1, 1, 2) + struct.pack(">I", 0) + bytes(4) + bytes([0b10011100, 0b00000000])
    head = struct.pack(">4I", G.SIGNATURE, 0, 1, 0) + b"\x01c" + struct.pack(">I", 16 + 6)
    (tmp_path / "x.2bit").write_bytes(head + body)
    assert G.whole_sequences(G.read_twobit(spark, str(tmp_path / "x.2bit"))).first()[:] == ("c", "ANNTT")


@pytest.mark.parametrize("kind", ["two", "fa"])
def test_slices(spark, genome, kind, monkeypatch):
    seqs, path = genome
    monkeypatch.setattr(G, "SCAN_BYTES", 50)  # headers in many ranges
    rng = random.Random(1)
    spans = [(name, a := rng.randrange(0, len(s) + 3), a + rng.randrange(0, 60), rng.choice("+-"), i) for name, s in seqs.items() for i in range(15)]
    spans += [("unknown", 0, 5, "+", 99), (spans[0][0], spans[0][1], spans[0][2], spans[0][3], 100)]
    index = G.genome_index(spark, str(path / kind))
    assert index.count() == len(seqs)
    df = spark.createDataFrame(spans, "chrom string, start long, stop long, strand string, file int")
    got = sorted((r.chrom, r.start, r.stop, r.strand, r.file, r.seq) for r in G.slices(index, df, region=40).collect())
    same = plain if kind == "two" else str
    want = [(c, a, b, s, i, (lambda x: revcomp(x) if s == "-" else x)(same(seqs[c])[a:b])) for c, a, b, s, i in spans if c in seqs]
    assert got == sorted(want)


def test_uneven_lines_are_told(spark, tmp_path):
    (tmp_path / "u.fa").write_text(">c\nACGT\nAC\nACGTAC\n")
    spans = spark.createDataFrame([("c", 0, 12, "+")], "chrom string, start long, stop long, strand string")
    with pytest.raises(Exception, match="differ in width"):
        G.slices(G.genome_index(spark, str(tmp_path)), spans).collect()


def test_a_slice_costs_what_it_asks_for(tmp_path):
    """Small slices of a long sequence don't read it; time follows the bases asked for."""
    (tmp_path / "long.2bit").write_bytes(b"")
    record = G.pack_record(b"ACGT" * 4_000_000)
    head = G.struct.pack("<4I", G.SIGNATURE, 0, 1, 0) + b"\x01c" + G.struct.pack("<I", 22)
    (tmp_path / "long.2bit").write_bytes(head + record)
    file = G.TwoBitFile(str(tmp_path / "long.2bit"))

    def took(size, n=200):
        began = time.process_time()
        for i in range(n):
            file.bases("c", 70_001 * i % 15_000_000, 70_001 * i % 15_000_000 + size)
        return time.process_time() - began

    took(100)
    assert took(100) < 0.2 and took(200_000) < 80 * max(took(20_000), 0.005)


def test_only_committed_attempts_are_seen(tmp_path):
    parts = Parts(str(tmp_path / "out"), ".x")
    names = []
    for attempt in (1, 2):  # the first attempt of the partition is lost
        name, out = parts.pending(0, attempt)
        out.write(b"%d" % attempt)
        out.close()
        names.append(name)
    parts.commit(names[1:])
    assert [open(p).read() for p, _ in found(str(tmp_path / "out"))] == ["2"]
    other = Parts(str(tmp_path / "out"), ".x")
    other.pending(1, 1)[1].close()
    other.abort()
    assert len(found(str(tmp_path / "out"))) == 1


def test_many_short_sequences_cost_few_reads(spark, tmp_path, monkeypatch):
    """Ranges are dealt by the index alone, and read as they lie in the file: not a request a name, a length or a stretch."""
    rng = random.Random(6)
    seqs = {f"s{i}": "".join(rng.choice("ACGTacgtN") for _ in range(rng.choice([0, 1, 30, 90, 2000 if i % 100 == 7 else 5]))) for i in range(3000)}
    G.write_twobit(spark.createDataFrame(list(seqs.items()), "chrom string, seq string").coalesce(1), str(tmp_path / "many"))
    asked, real = [], G.opened

    class Counted:
        def __init__(self, path):
            self.file = real(path)

        def read_at(self, size, offset):
            asked.append(size)
            return self.file.read_at(size, offset)

    monkeypatch.setattr(G, "opened", Counted)
    reader = G._TwoBitReader(str(tmp_path / "many"), 10, 1000)
    parts = reader.partitions()
    size = sum(s for _, s in found(str(tmp_path / "many"), ".2bit"))
    assert len(parts) > 50 and len(asked) < 1000 and sum(asked) < 2 * size + (1 << 21)
    asked.clear()
    got: dict = {}
    for part in parts:
        for batch in reader.read(part):
            for chrom, start, seq in zip(*[c.to_pylist() for c in batch.columns]):
                assert len(seq) <= 10 and start not in got.setdefault(chrom, {})
                got[chrom][start] = seq
    assert {c: "".join(x[k] for k in sorted(x)) for c, x in got.items()} == {k: plain(s) for k, s in seqs.items()}
    assert len(asked) < 12 * len(parts)
