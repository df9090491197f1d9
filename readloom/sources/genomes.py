"""Genomes in files that are read by byte ranges: packed two-bit sequences, and FASTA by an index of offsets.

``twobit`` is a Spark data source: ``spark.read.format("twobit").load(path)`` gives (chrom, start, seq) in stretches, every
sequence split over as many partitions as its length asks for; ``df.write.format("twobit").save(path)`` writes (chrom, seq)
rows, one file a task. :func:`slices` reads the asked parts alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .files import Parts, found, opened

# Fixed values of the format: its signature and the order of the bases.
SIGNATURE = 0x1A412743
PACKED = b"TCAG"

_UNPACK = np.frombuffer(PACKED, np.uint8)[(np.arange(256)[:, None] >> np.array([6, 4, 2, 0])) & 3]
_PACK = np.zeros(256, np.uint8)
for _i, _b in enumerate(PACKED):
    _PACK[[_b, _b + 32]] = _i
_KNOWN = np.isin(np.arange(256), np.frombuffer(PACKED + PACKED.lower(), np.uint8))

#: Bases of a row, and of a partition, of a scan.
STRETCH, PARTITION = 1 << 16, 1 << 24


#: Bytes of a file that are read at once where what follows will be needed.
AHEAD = 1 << 20


class _Held:
    """Bytes of a file, taken one after the other from blocks of ``ahead`` bytes."""

    def __init__(self, file, at: int, ahead: int = AHEAD):
        self.file, self.at, self.ahead, self.block, self.first = file, at, ahead, b"", at

    def take(self, size: int) -> bytes:
        k = self.at - self.first
        if k + size > len(self.block):
            self.block, self.first, k = self.file.read_at(max(size, self.ahead), self.at), self.at, 0
        self.at += size
        return self.block[k : k + size]


class TwoBitFile:
    """One file: its index of names, and any range of any sequence."""

    def __init__(self, path: str):
        self.file = opened(path)
        head = self._at(0, 16)
        self.order = "<" if struct.unpack("<I", head[:4])[0] == SIGNATURE else ">"
        signature, version, self.count, _ = struct.unpack(self.order + "4I", head)
        if signature != SIGNATURE or version:
            raise ValueError(f"{path} is not a .2bit file of version 0")
        self._offsets: dict[str, int] | None = None
        self._known: tuple[str, tuple] | None = None

    @property
    def offsets(self) -> dict[str, int]:
        """Where each sequence's record lies."""
        if self._offsets is None:
            self._offsets = {chrom: at for _, chrom, at in self.entries(16, self.count)}
        return self._offsets

    def entries(self, at: int, count: int) -> Iterator[tuple[int, str, int]]:
        """(place in the index, name, offset of the record) of ``count`` entries of the index from the place ``at`` on."""
        held, number = _Held(self.file, at, min(AHEAD, 64 + 32 * count)), struct.Struct(self.order + "I")
        for _ in range(count):
            size = held.take(1)[0]
            entry = held.take(size + 4)
            yield at, entry[:size].decode(), number.unpack_from(entry, size)[0]
            at += size + 5

    def learn(self, chrom: str, offset: int) -> None:
        """Tell a sequence's place without the index."""
        self._offsets = self._offsets or {}
        self._offsets[chrom] = offset

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def _numbers(self, offset: int, count: int) -> np.ndarray:
        return np.frombuffer(self._at(offset, 4 * count), self.order + "u4").astype(np.int64)

    def length(self, chrom: str) -> int:
        return int(self._numbers(self.offsets[chrom], 1)[0])

    def _record(self, chrom: str) -> tuple:
        """(length, stretches of N, masked stretches, offset of the packed bases); that of the last sequence is kept."""
        if self._known is None or self._known[0] != chrom:
            at = self.offsets[chrom]
            size, n = self._numbers(at, 2).tolist()
            unknown = self._numbers(at + 8, 2 * n).reshape(2, n)
            at += 8 + 8 * n
            m = int(self._numbers(at, 1)[0])
            masked = self._numbers(at + 4, 2 * m).reshape(2, m)
            self._known = chrom, (size, unknown, masked, at + 8 + 8 * m)
        return self._known[1]

    def bases(self, chrom: str, start: int, stop: int) -> np.ndarray:
        """Bytes of [start, stop), cut to the sequence: N where unknown, lower case where masked."""
        size, unknown, masked, at = self._record(chrom)
        start, stop = max(start, 0), min(stop, size)
        if start >= stop:
            return np.zeros(0, np.uint8)
        first = start // 4
        packed = np.frombuffer(self._at(at + first, (stop + 3) // 4 - first), np.uint8)
        return _marked(_UNPACK[packed].reshape(-1)[start - 4 * first : stop - 4 * first].copy(), start, unknown, masked)


def _marked(out: np.ndarray, start: int, unknown: np.ndarray, masked: np.ndarray) -> np.ndarray:
    """Bases from ``start`` on with N where ``unknown`` and in lower case where ``masked``, both (starts, sizes)."""
    for (starts, sizes), lower in ((unknown, False), (masked, True)):
        i, j = int(np.searchsorted(starts + sizes, start, "right")), int(np.searchsorted(starts, start + len(out), "left"))
        if i < j:
            edge = np.zeros(len(out) + 1, np.int32)
            np.add.at(edge, np.maximum(starts[i:j] - start, 0), 1)
            np.add.at(edge, np.minimum(starts[i:j] + sizes[i:j] - start, len(out)), -1)
            inside = np.cumsum(edge[:-1]) > 0
            out[inside] = out[inside] | 32 if lower else ord("N")
    return out


def _unpacked(block: bytes, order: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(length, stretches of N, masked stretches, packed bases) of a whole record's bytes."""
    number = np.dtype(order + "u4")
    size, n = np.frombuffer(block, number, 2).tolist()
    unknown = np.frombuffer(block, number, 2 * n, 8).astype(np.int64).reshape(2, n)
    at = 8 + 8 * n
    m = int(np.frombuffer(block, number, 1, at)[0])
    masked = np.frombuffer(block, number, 2 * m, at + 4).astype(np.int64).reshape(2, m)
    at += 8 + 8 * m
    return size, unknown, masked, np.frombuffer(block, np.uint8, (size + 3) // 4, at)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def pack_record(seq: bytes) -> bytes:
    """One sequence's record; letters other than A, C, G and T become N, lower case is masking."""
    data = np.frombuffer(seq, np.uint8)
    blocks = b""
    for flags in (~_KNOWN[data], (data >= 97) & (data <= 122)):
        starts, sizes = _runs(flags)
        blocks += struct.pack("<I", len(starts)) + starts.astype("<u4").tobytes() + sizes.astype("<u4").tobytes()
    code = np.zeros(-(-len(data) // 4) * 4, np.uint8)
    code[: len(data)] = _PACK[data]
    four = code.reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return struct.pack("<I", len(data)) + blocks + bytes(4) + packed.tobytes()


@dataclass
class _Range(InputPartition):
    """``count`` whole sequences from the place ``at`` of a file's index on, or the range ``start`` to ``stop`` of one."""

    path: str
    at: int
    count: int
    start: int = 0
    stop: int = -1

    def __init__(self, path: str, at: int, count: int, start: int = 0, stop: int = -1):
        super().__init__((path, at, count, start, stop))
        self.path, self.at, self.count, self.start, self.stop = path, at, count, start, stop


class _TwoBitReader(DataSourceReader):
    def __init__(self, path: str, stretch: int, partition: int):
        self.path, self.stretch, self.size = path, stretch, max(partition // stretch, 1) * stretch

    def partitions(self) -> list[_Range]:
        """Ranges of at most ``partition`` bases; short sequences of a file share one.

        Only the files' indexes are read, once and in blocks; a record's bytes bound its bases, and only of those that may be
        too long the length is looked up. A range names a part of the index, so neither the driver nor a task holds or sends all names.
        """
        out = []
        for path, total in found(self.path, ".2bit"):
            file = TwoBitFile(path)
            places, offsets = np.zeros((2, file.count), np.int64)
            for i, (place, _, offset) in enumerate(file.entries(16, file.count)):
                places[i], offsets[i] = place, offset
            ends = np.append(np.sort(offsets), total)
            bases = ((ends[np.searchsorted(ends, offsets, side="right").clip(max=file.count)] - offsets) * 4).tolist()
            begun, held = None, 0
            for place, offset, most in zip(places.tolist(), offsets.tolist(), bases):
                length = most if most <= self.size else int(file._numbers(offset, 1)[0])
                if begun is not None and held + length > self.size:
                    out.append(_Range(path, *begun))
                    begun, held = None, 0
                if length > self.size:
                    out += [_Range(path, place, 1, start, min(start + self.size, length)) for start in range(0, length, self.size)]
                else:
                    begun, held = (begun[0], begun[1] + 1) if begun else (place, 1), held + length
            if begun is not None:
                out.append(_Range(path, *begun))
        return out or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        """Stretches in batches of some sequences; the records of several are read in blocks, as they lie in the file."""
        if not partition.path:
            return
        file = TwoBitFile(partition.path)
        entries = [(chrom, offset) for _, chrom, offset in file.entries(partition.at, partition.count)]
        if partition.stop >= 0:
            (chrom, offset), at, step = entries[0], partition.start, max(AHEAD // self.stretch, 1) * self.stretch
            file.learn(chrom, offset)
            while at < partition.stop:
                yield self._batch([(chrom, at, file.bases(chrom, at, min(at + step, partition.stop)))])
                at += step
            return
        held, some, size = None, [], 0
        for chrom, offset in entries:
            if held is None or held.at != offset:
                held = _Held(file.file, offset, min(AHEAD, 64 + self.size // 8))
            head = held.take(8)
            length, n = struct.unpack(file.order + "2I", head)
            more = held.take(8 * n + 4)
            m = struct.unpack_from(file.order + "I", more, 8 * n)[0]
            rest = held.take(8 * m + 4 + (length + 3) // 4)
            _, unknown, masked, packed = _unpacked(head + more + rest, file.order)
            some.append((chrom, 0, _marked(_UNPACK[packed].reshape(-1)[:length].copy(), 0, unknown, masked)))
            size += length
            if size >= AHEAD or len(some) >= 1 << 12:
                yield self._batch(some)
                some, size = [], 0
        if some:
            yield self._batch(some)

    def _batch(self, pieces: list[tuple[str, int, np.ndarray]]) -> pa.RecordBatch:
        """Pieces of sequences as rows of stretches; an empty one is a row."""
        counts = np.array([max(-(-len(x) // self.stretch), 1) for _, _, x in pieces])
        row = np.repeat(np.arange(len(pieces)), counts)
        place = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * self.stretch
        sizes = np.array([len(x) for _, _, x in pieces])[row]
        cut = np.concatenate([[0], np.cumsum(np.minimum(sizes - place, self.stretch))]).astype(np.int32)
        letters = np.concatenate([x for _, _, x in pieces])
        seq = pa.StringArray.from_buffers(len(row), pa.py_buffer(cut), pa.py_buffer(letters))
        start = np.array([at for _, at, _ in pieces])[row] + place
        return pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in pieces]).take(pa.array(row)), pa.array(start, pa.int64()), seq], names=["chrom", "start", "seq"])


@dataclass
class _Written(WriterCommitMessage):
    name: str


class _TwoBitWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.parts = Parts(path, ".2bit")
        self.parts.refuse_existing()

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        names, records = [], []
        for batch in batches:
            for chrom, seq in zip(batch.column("chrom").to_pylist(), batch.column("seq").to_pylist()):
                names.append(chrom.encode())
                records.append(pack_record((seq or "").encode("ascii", "replace")))
        if not names:
            return _Written("")
        if len(set(names)) < len(names):
            raise ValueError("a sequence name occurs twice")
        name, out = self.parts.pending(context.partitionId(), context.taskAttemptId())
        at = 16 + sum(len(n) + 5 for n in names)
        with out:
            out.write(struct.pack("<4I", SIGNATURE, 0, len(names), 0))
            for n, r in zip(names, records):
                out.write(struct.pack("<B", len(n)) + n + struct.pack("<I", at))
                at += len(r)
            for r in records:
                out.write(r)
        return _Written(name)

    def commit(self, messages: list[_Written | None]) -> None:
        self.parts.commit([m.name for m in messages if m and m.name])

    def abort(self, messages: list[_Written | None]) -> None:
        self.parts.abort()


class TwoBitSource(DataSource):
    """Options: ``path``; ``stretch`` (bases of a row) and ``partition`` (bases of a task) for reading."""

    @classmethod
    def name(cls) -> str:
        return "twobit"

    def schema(self) -> str:
        return "chrom string, start bigint, seq string"

    def reader(self, schema) -> _TwoBitReader:
        return _TwoBitReader(self.options["path"], int(self.options.get("stretch", STRETCH)), int(self.options.get("partition", PARTITION)))

    def writer(self, schema, overwrite: bool) -> _TwoBitWriter:
        return _TwoBitWriter(self.options["path"])


def read_twobit(spark: SparkSession, path: str, **options) -> DataFrame:
    """(chrom, start, seq) of a .2bit file, or of those of a folder."""
    spark.dataSource.register(TwoBitSource)
    return spark.read.format("twobit").options(**options).load(path)


def write_twobit(genome: DataFrame, path: str) -> None:
    """Write (chrom, seq) rows; a task holds its own file's sequences packed, a quarter of their size."""
    genome.sparkSession.dataSource.register(TwoBitSource)
    genome.select("chrom", "seq").write.format("twobit").mode("append").save(path)


def whole_sequences(stretches: DataFrame) -> DataFrame:
    """(chrom, seq) of a scan's stretches, where a sequence fits a row."""
    ordered = F.array_sort(F.collect_list(F.struct("start", "seq")))
    return stretches.groupBy("chrom").agg(F.array_join(F.transform(ordered, lambda x: x["seq"]), "").alias("seq"))


# Slices by an index of offsets.

#: Bases of a sequence whose spans one task group reads.
REGION = 1 << 22
#: Bytes of a file that one task looks through for headers.
SCAN_BYTES = 1 << 26

_INDEX = "file string, chrom string, kind string, data long, data_stop long, line_bases long, line_width long"


def genome_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each sequence of .2bit and FASTA files (of any other ending) lies: file, chrom, kind, and for FASTA the bytes and line widths.

    FASTA files are looked through in byte ranges, for headers alone.
    """
    ranges = [(p, a, min(a + SCAN_BYTES, size)) for p, size in found(path) if not p.lower().endswith(".2bit") for a in range(0, size, SCAN_BYTES)]
    packed = [(p,) for p, _ in found(path) if p.lower().endswith(".2bit")]
    spread = lambda rows, schema: spark.createDataFrame(rows, schema).repartition(max(min(len(rows), 200), 1), "file")

    def names(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                chroms = list(TwoBitFile(p).offsets)
                none = pa.nulls(len(chroms), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(chroms)), pa.array(chroms), pa.array(["2bit"] * len(chroms)), none, none, none, none], names=[x.split()[0] for x in _INDEX.split(", ")])

    def headers(batches):
        for batch in batches:
            for p, a, b in zip(*[c.to_pylist() for c in batch.columns]):
                rows = list(_headers(p, a, b))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([p] * len(rows)), *[pa.array(list(c), pa.int64() if i else pa.string()) for i, c in enumerate(zip(*rows))]], names=["file", "chrom", "header", "data", "line_bases", "line_width", "size"])

    fasta = spread(ranges, "file string, a long, b long").mapInArrow(headers, "file string, chrom string, header long, data long, line_bases long, line_width long, size long")
    stop = F.coalesce(F.lead("header").over(W.partitionBy("file").orderBy("header")), F.col("size"))
    fasta = fasta.select("file", "chrom", F.lit("fasta").alias("kind"), "data", stop.alias("data_stop"), "line_bases", "line_width")
    return spread(packed, "file string").mapInArrow(names, _INDEX).union(fasta)


def _headers(path: str, a: int, b: int):
    """(name, offset of the header, of the first base, bases and bytes of the first line, size of the file) of the headers that begin in [a, b)."""
    with opened(path) as file:
        size = file.size()
        at, step = max(a - 1, 0), 1 << 22  # a header begins after a line's end, which may be the byte before
        while at < b:
            block = file.read_at(min(step, b - at), at)
            data = np.frombuffer(block, np.uint8)
            marks = np.flatnonzero(data == ord(">"))
            for i in marks.tolist():
                if (at + i == 0 or (i and data[i - 1] == 10)) and at + i >= a:
                    name, first = _line(file, at + i, size)
                    _, after = _line(file, first, size)
                    text = file.read_at(after - first, first)
                    bases = 0 if text[:1] == b">" else len(text.rstrip(b"\r\n"))
                    yield name[1:].split()[0].decode() if name[1:].split() else "", at + i, first, bases, after - first, size
            at += len(block) if len(block) == b - at else len(block) - 1  # the last byte is looked at again, as the one before
            if not block:
                break


def _line(file, at: int, size: int) -> tuple[bytes, int]:
    """The line at ``at`` without its end (its first megabyte), and where the next one begins."""
    held, place = b"", at
    while place < size:
        block = file.read_at(1 << 16, place)
        end = block.find(b"\n")
        if len(held) < 1 << 20:
            held += block if end < 0 else block[:end]
        if end >= 0:
            return held.rstrip(b"\r"), place + end + 1
        place += len(block)
    return held, size


def _fasta_bases(file, entry: tuple, start: int, stop: int) -> np.ndarray:
    data, data_stop, bases, width = entry
    if not bases:
        return np.zeros(0, np.uint8)
    offset = lambda k: data + k // bases * width + k % bases
    last = max(stop - 1, start)
    a, b = offset(max(start, 0)), min(offset(last) + 1, data_stop)
    raw = np.frombuffer(file.read_at(max(b - a, 0), a), np.uint8) if stop > start else np.zeros(0, np.uint8)
    blank = raw <= 32
    used = len(raw) - int(np.argmin(blank[::-1])) if len(raw) and not blank.all() else 0  # a line's end may follow the last base
    if not np.array_equal(blank[:used], (a - data + np.arange(used)) % width >= bases):
        raise ValueError("lines of a sequence differ in width: it can't be read by offsets")
    return raw[:used][~blank[:used]]


def slices(index: DataFrame, spans: DataFrame, region: int = REGION) -> DataFrame:
    """All columns of ``spans`` (chrom, start, stop, strand, ...) with ``seq``, reverse-complemented on -, cut to the sequence; unknown sequences are left out.

    Each span meets its sequence's place in the index; spans are dealt by file, sequence and region, so a long sequence's spans
    spread over many tasks, and every task reads the bytes that were asked for, in order.
    """
    from ..functions.sequence import reverse_complement

    entry = ("file", "kind", "data", "data_stop", "line_bases", "line_width")
    places = index.dropDuplicates(["chrom"]).select(F.col("chrom").alias("_chrom"), *[F.col(c).alias(f"_{c}") for c in entry])
    rows = spans.join(places, F.col("chrom") == F.col("_chrom")).withColumn("_region", F.floor(F.col("start") / region))
    rows = rows.repartition("_file", "_chrom", "_region").sortWithinPartitions("_file", "_chrom", "start").drop("_chrom", "_region")
    own = spans.columns
    at = [rows.columns.index(c) for c in ("chrom", "start", "stop", *[f"_{c}" for c in entry])]

    def read(batches):
        name, file = None, None
        for batch in batches:
            out = []
            for chrom, start, stop, path, kind, *place in zip(*[batch.column(i).to_pylist() for i in at]):
                if path != name:
                    name, file = path, TwoBitFile(path) if kind == "2bit" else opened(path)
                got = file.bases(chrom, start, stop) if kind == "2bit" else _fasta_bases(file, tuple(place), start, stop)
                out.append(got.tobytes().decode("ascii"))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(own))], pa.array(out, pa.string())], names=[*own, "_seq"])

    kinds = ", ".join(f"`{c}` {spans.schema[c].dataType.simpleString()}" for c in own)
    got = rows.mapInArrow(read, f"{kinds}, _seq string")
    return got.select(*own, F.when(F.col("strand") == "-", reverse_complement(F.col("_seq"))).otherwise(F.col("_seq")).alias("seq"))
