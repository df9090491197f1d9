"""Binary alignments and sorted alignment files: data sources ``bam`` and ``sam``.

A BAM file is a chain of small compressed blocks, and records cross them. A partition is a range of the file's bytes: it
starts at the first block in its range, finds the first record by the form that ten records in a row must have,
and reads the records that begin in its blocks, the last one into the next range's. Only the header is read when the scan is planned.

Written folders hold one file a task, each with the whole header first; after :func:`coordinate_sort` their names are in
coordinate order. Files of lost or repeated attempts are never seen (``files.Parts``).
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .files import Parts, found, opened
from .tables import SAM_COLUMNS, read_sam

# Fixed values of the format.
MAGIC = b"BAM\x01"
CIGAR = "MIDNSHP=X"
BASES = "=ACMGRSVTWYHKDBN"
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_BLOCK_HEAD = b"\x1f\x8b\x08\x04"
_NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}

#: Bytes of a file that one task reads, and of a block before compression.
RANGE, BLOCK = 1 << 25, 0xFF00
#: Records in a row that make a place a record's beginning.
SURE = 10
#: Bytes of a record at most, in looking for one: longer reads are found from a file's start only.
LONGEST = 1 << 24

SCHEMA = "name string, flag int, chrom string, pos bigint, mapq int, cigar string, mate_chrom string, mate_pos bigint, template_length bigint, seq string, quality string, tags array<string>, file_pos bigint"


class Blocks:
    """Decompressed blocks of a file from a byte offset on."""

    def __init__(self, path: str):
        self.file = opened(path)
        self.size = self.file.size()

    def first_at(self, offset: int) -> int:
        """The first block that begins at or after ``offset``: its head is right and the next block's follows it."""
        while offset < self.size:
            window = self.file.read_at(min(1 << 17, self.size - offset), offset)
            at = window.find(_BLOCK_HEAD)
            while at >= 0:
                size = self.length(offset + at)
                if size and (offset + at + size >= self.size or self.length(offset + at + size)):
                    return offset + at
                at = window.find(_BLOCK_HEAD, at + 1)
            offset += max(len(window) - len(_BLOCK_HEAD) + 1, 1)
        return self.size

    def length(self, offset: int) -> int:
        """Bytes of the block at ``offset``; 0 if there is none."""
        head = self.file.read_at(min(18, self.size - offset), offset)
        if len(head) < 18 or head[:4] != _BLOCK_HEAD:
            return 0
        extra = struct.unpack("<H", head[10:12])[0]
        fields = head[12:] if extra == 6 else self.file.read_at(extra, offset + 12)
        while len(fields) >= 6:
            size = struct.unpack("<H", fields[2:4])[0]
            if fields[:2] == b"BC" and size == 2:
                return struct.unpack("<H", fields[4:6])[0] + 1
            fields = fields[4 + size :]
        return 0

    def read(self, offset: int) -> tuple[bytes, int]:
        """(content of the block at ``offset``, offset of the next one)."""
        size = self.length(offset)
        if not size:
            raise ValueError(f"no block at byte {offset}")
        block = self.file.read_at(size, offset)
        return zlib.decompress(block[12 + struct.unpack("<H", block[10:12])[0] : -8], -15), offset + size


class _Stream:
    """Bytes of consecutive blocks with the blocks that they came from."""

    def __init__(self, blocks: Blocks, offset: int):
        self.blocks, self.next = blocks, offset
        self.data = b""
        self.base = 0  # place in the stream of data[0]
        self.begins: list[tuple[int, int]] = []  # (place in the stream, block)

    def fill(self, stop: int) -> bool:
        """Hold the bytes up to place ``stop``; False where the file ends before."""
        held, size = [self.data], self.base + len(self.data)
        if size >= stop:
            return True
        while size < stop and self.next < self.blocks.size:
            block = self.next
            content, self.next = self.blocks.read(block)
            if content:
                self.begins.append((size, block))
                held.append(content)
                size += len(content)
        self.data = b"".join(held)
        return size >= stop

    def take(self, at: int, size: int) -> bytes | None:
        return self.data[at - self.base : at - self.base + size] if self.fill(at + size) else None

    def block_of(self, at: int) -> tuple[int, int]:
        """(its place in the stream, the block) that holds place ``at``, which must be held."""
        k = len(self.begins) - 1
        while k and self.begins[k][0] > at:
            k -= 1
        return self.begins[k]

    def drop(self, at: int) -> None:
        """Forget what lies before place ``at``."""
        self.data, self.base = self.data[at - self.base :], at
        while len(self.begins) > 1 and self.begins[1][0] <= at:
            self.begins.pop(0)


def read_header(path: str) -> tuple[str, list[str], int, int]:
    """(header text, sequence names, block and place in it of the first record)."""
    stream = _Stream(Blocks(path), 0)
    if stream.take(0, 4) != MAGIC:
        raise ValueError(f"{path} is not a BAM file")
    size = struct.unpack("<i", stream.take(4, 4))[0]
    text, at, names = stream.take(8, size).rstrip(b"\x00").decode(), 8 + size, []
    count = struct.unpack("<i", stream.take(at, 4))[0]
    at += 4
    for _ in range(count):
        size = struct.unpack("<i", stream.take(at, 4))[0]
        names.append(stream.take(at + 4, size - 1).decode())
        at += 8 + size
    if not stream.fill(at + 1):
        return text, names, stream.blocks.size, 0
    begin, block = next((b, o) for b, o in reversed(stream.begins) if b <= at)
    return text, names, block, at - begin


def _record_at(stream: _Stream, at: int, n_chroms: int) -> int | None:
    """The end of the record at place ``at``; None if there can be none."""
    head = stream.take(at, 36)
    if head is None:
        return None
    size, chrom, pos, name, _, _, cigars, _, bases, mate, mate_pos, _ = struct.unpack("<iiiBBHHHiiii", head)
    least = 32 + name + 4 * cigars + (bases + 1) // 2 + bases
    if not (least <= size <= LONGEST and name > 1 and bases >= 0 and -1 <= chrom < n_chroms and -1 <= mate < n_chroms and pos >= -1 and mate_pos >= -1):
        return None
    rest = stream.take(at + 36, name + 4 * cigars)
    if rest is None or rest[name - 1] or 0 in rest[: name - 1] or not all(33 <= c <= 126 for c in rest[: name - 1]):
        return None
    if any(x & 15 > 8 for x in struct.unpack(f"<{cigars}I", rest[name:])):
        return None
    return at + 4 + size


def _first_record(stream: _Stream, n_chroms: int, stop: int) -> int | None:
    """The first place of a record in the blocks before byte ``stop``."""
    at = 0
    while stream.fill(at + 1) and stream.block_of(at)[1] < stop:
        place, k = at, 0
        while k < SURE:
            end = _record_at(stream, place, n_chroms)
            if end is None or not stream.fill(end):
                break
            place, k = end, k + 1
        # Fewer records do at the end of the file.
        if k == SURE or k and not stream.fill(place + 1):
            return at
        at += 1
    return None


def _tags(data: bytes) -> list[str]:
    out, at = [], 0
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind == "A":
            value, at = chr(data[at]), at + 1
        elif kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end].decode(), end + 1
        elif kind == "B":
            of, n = chr(data[at]), struct.unpack("<i", data[at + 1 : at + 5])[0]
            size = struct.calcsize(_NUMBERS[of])
            value = ",".join([of, *(f"{x:g}" if of == "f" else str(x) for x in struct.unpack(f"<{n}{_NUMBERS[of]}", data[at + 5 : at + 5 + n * size]))])
            at += 5 + n * size
        else:
            size = struct.calcsize(_NUMBERS[kind])
            x = struct.unpack("<" + _NUMBERS[kind], data[at : at + size])[0]
            value, at = f"{x:g}" if kind == "f" else str(x), at + size
            kind = kind if kind == "f" else "i"
        out.append(f"{name}:{kind}:{value}")
    return out


#: Hexadecimal digits to bases, and back from any letter.
_BASE_OF = bytes(ord(BASES[int(chr(i), 16)]) if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_DIGIT_OF = bytes(ord(f"{BASES.find(chr(i).upper()) & 15:x}") for i in range(256))


def decode(record: bytes, names: list[str]) -> tuple:
    """The columns of a record, as those of its line of text; without its size."""
    chrom, pos, name, mapq, _, cigars, flag, bases, mate, mate_pos, length = struct.unpack("<iiBBHHHiiii", record[:32])
    at = 32 + name
    ops = struct.unpack(f"<{cigars}I", record[at : at + 4 * cigars])
    at += 4 * cigars
    packed = record[at : at + (bases + 1) // 2]
    at += len(packed)
    quality = record[at : at + bases]
    seq = packed.hex().encode().translate(_BASE_OF)[:bases].decode() or "*"
    where = lambda i: names[i] if i >= 0 else "*"
    other = "=" if mate >= 0 and mate == chrom else where(mate)
    shown = "*" if not bases or quality[0] == 255 else bytes(q + 33 for q in quality).decode("ascii")
    return record[32 : 32 + name - 1].decode(), flag, where(chrom), pos + 1, mapq, "".join(f"{x >> 4}{CIGAR[x & 15]}" for x in ops) or "*", other, mate_pos + 1, length, seq, shown, _tags(record[at + bases :])


@dataclass
class _Part(InputPartition):
    path: str
    start: int
    skip: int
    stop: int

    def __init__(self, path: str, start: int, skip: int, stop: int):
        super().__init__((path, start, skip, stop))
        self.path, self.start, self.skip, self.stop = path, start, skip, stop


class _BamReader(DataSourceReader):
    def __init__(self, path: str, span: int):
        self.path, self.span = path, span

    def partitions(self) -> list[_Part]:
        out = []
        for path, size in found(self.path, ".bam"):
            _, _, block, skip = read_header(path)
            out.append(_Part(path, block, skip, max(self.span, block + 1)))
            out += [_Part(path, a, -1, a + self.span) for a in range(max(self.span, block + 1), size, self.span)]
        return out or [_Part("", 0, 0, 0)]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        _, names, _, _ = read_header(part.path)
        blocks = Blocks(part.path)
        stream = _Stream(blocks, part.start if part.skip >= 0 else blocks.first_at(part.start))
        at = part.skip if part.skip >= 0 else _first_record(stream, len(names), part.stop)
        rows, held = [], 0
        while at is not None and stream.fill(at + 4):
            begin, block = stream.block_of(at)
            if block >= part.stop:
                break
            offset = at - stream.base
            size = int.from_bytes(stream.data[offset : offset + 4], "little", signed=True)
            if not stream.fill(at + 4 + size):
                raise ValueError(f"{part.path} ends within a record")
            rows.append((*decode(stream.data[offset + 4 : offset + 4 + size], names), block << 16 | at - begin))  # the record's virtual offset
            at, held = at + 4 + size, held + size
            if held > 1 << 20 or len(rows) == 4096:
                yield _table(rows)
                rows, held = [], 0
            if at - stream.base > 1 << 20:
                stream.drop(at)
        if rows:
            yield _table(rows)


_KINDS = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int64()]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=[*SAM_COLUMNS, "tags", "file_pos"])


def _bin(start: int, stop: int) -> int:
    """The smallest of the format's nested bins that holds [start, stop)."""
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == stop - 1 >> shift:
            return first + (start >> shift)
    return 0


def _encode_tag(tag: str) -> bytes:
    name, kind, value = tag.split(":", 2)
    head = name.encode()
    if kind == "A":
        return head + b"A" + value.encode()
    if kind in "ZH":
        return head + kind.encode() + value.encode() + b"\x00"
    if kind == "f":
        return head + b"f" + struct.pack("<f", float(value))
    if kind == "B":
        of, *numbers = value.split(",")
        return head + b"B" + of.encode() + struct.pack(f"<i{len(numbers)}{_NUMBERS[of]}", len(numbers), *(float(x) if of == "f" else int(x) for x in numbers))
    x = int(value)
    of = next(c for c, lo, hi in (("c", -128, 127), ("C", 0, 255), ("s", -32768, 32767), ("S", 0, 65535), ("i", -(1 << 31), (1 << 31) - 1), ("I", 0, (1 << 32) - 1)) if lo <= x <= hi)
    return head + of.encode() + struct.pack("<" + _NUMBERS[of], x)


_OPERATION = re.compile(r"([0-9]*)([^0-9])")


def encode(row: tuple, numbers: dict[str, int]) -> bytes:
    """A record with its size, from the columns of its line of text."""
    name, flag, chrom, pos, mapq, cigar, mate, mate_pos, length, seq, quality, tags = row
    ops, span = [], 0
    for n, c in _OPERATION.findall("" if cigar in (None, "*") else cigar):
        size = int(n)
        ops.append(size << 4 | CIGAR.index(c))
        span += size if c in "MDN=X" else 0
    seq = "" if seq in (None, "*") else seq
    packed = bytes.fromhex(seq.encode("ascii", "replace").translate(_DIGIT_OF).decode() + "0" * (len(seq) % 2))
    marks = b"\xff" * len(seq) if quality in (None, "*") else bytes(ord(c) - 33 for c in quality)
    number = lambda c: numbers[c] if c not in (None, "*") else -1
    begin = (pos or 0) - 1
    mate = chrom if mate == "=" else mate
    body = struct.pack("<iiBBHHHiiii", number(chrom), begin, len(name) + 1, mapq or 0, _bin(max(begin, 0), max(begin, 0) + max(span, 1)), len(ops), flag or 0, len(seq), number(mate), (mate_pos or 0) - 1, length or 0)
    body += name.encode() + b"\x00" + struct.pack(f"<{len(ops)}I", *ops) + packed + marks + b"".join(map(_encode_tag, tags or []))
    return struct.pack("<i", len(body)) + body


def compress(data: bytes) -> bytes:
    """One block."""
    worker = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = worker.compress(data) + worker.flush()
    return _BLOCK_HEAD + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(data), len(data))


def header_names(header: str) -> list[tuple[str, int]]:
    """(name, length) of the header's sequences, in order."""
    out = []
    for line in header.splitlines():
        if line.startswith("@SQ"):
            fields = dict(f.split(":", 1) for f in line.split("\t")[1:])
            out.append((fields["SN"], int(fields["LN"])))
    return out


@dataclass
class _Done(WriterCommitMessage):
    name: str


class _Writer(DataSourceArrowWriter):
    """One file a task, the header first."""

    def __init__(self, path: str, header: str, binary: bool):
        self.header, self.binary = header if not header or header.endswith("\n") else header + "\n", binary
        self.parts = Parts(path, ".bam" if binary else ".sam")
        self.parts.refuse_existing()

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Done:
        from pyspark import TaskContext

        context = TaskContext.get()
        first = next(batches, None)
        if first is None and context.partitionId():
            return _Done("")  # of empty tasks the first alone writes its header
        name, out = self.parts.pending(context.partitionId(), context.taskAttemptId())
        with out:
            for piece in self._pieces(first, batches):
                out.write(piece)
        return _Done(name)

    def _rows(self, first, rest) -> Iterator[tuple]:
        for batch in ([first] if first is not None else []):
            yield from zip(*[batch.column(c).to_pylist() for c in (*SAM_COLUMNS, "tags")])
        for batch in rest:
            yield from zip(*[batch.column(c).to_pylist() for c in (*SAM_COLUMNS, "tags")])

    def _pieces(self, first, rest) -> Iterator[bytes]:
        if not self.binary:
            yield self.header.encode()
            for row in self._rows(first, rest):
                yield ("\t".join(["*" if x is None else str(x) for x in row[:-1]] + list(row[-1] or [])) + "\n").encode()
            return
        chroms, text = header_names(self.header), self.header.encode()
        numbers = {c: i for i, (c, _) in enumerate(chroms)}
        held = bytearray(MAGIC + struct.pack("<i", len(text)) + text + struct.pack("<i", len(chroms)))
        for chrom, length in chroms:
            held += struct.pack("<i", len(chrom) + 1) + chrom.encode() + b"\x00" + struct.pack("<i", length)
        for row in self._rows(first, rest):
            held += encode(row, numbers)
            while len(held) >= BLOCK:
                yield compress(bytes(held[:BLOCK]))
                del held[:BLOCK]
        if held:
            yield compress(bytes(held))
        yield END_OF_FILE

    def commit(self, messages: list[_Done | None]) -> None:
        self.parts.commit([m.name for m in messages if m and m.name])

    def abort(self, messages: list[_Done | None]) -> None:
        self.parts.abort()


class BamSource(DataSource):
    """Options: ``path``; ``span`` (bytes of a partition) for reading; ``header`` (text) for writing."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _BamReader:
        return _BamReader(self.options["path"], int(self.options.get("span", RANGE)))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options.get("header", ""), True)


class SamSource(DataSource):
    """Writing only: the header stands first in every file."""

    @classmethod
    def name(cls) -> str:
        return "sam"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options.get("header", ""), False)


def read_bam(spark: SparkSession, path: str, **options) -> DataFrame:
    """The columns of ``read_sam``; ``file_pos`` is a record's virtual offset, increasing within its file."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").options(**options).load(path)


def compressed(spark: SparkSession, path: str) -> DataFrame:
    """(path, compressed) of a file, or of a folder's files: do they begin as gzip does, and so as BAM does? Two bytes of each are read, in tasks."""
    files = found(path)

    def look(batches):
        for batch in batches:
            paths, out = batch.column(0).to_pylist(), []
            for p in paths:
                with opened(p) as f:
                    out.append(f.read(2) == b"\x1f\x8b")
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(out)], names=["path", "compressed"])

    rows = spark.createDataFrame([(p,) for p, _ in files], "path string").repartition(max(min(len(files), 200), 1))
    return rows.mapInArrow(look, "path string, compressed boolean")


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """SAM and BAM files of a path, told apart by their first bytes."""
    kinds = {r.path: r.compressed for r in compressed(spark, path).collect()}  # one row a file, as many as the scan's plan lists
    parts = [read_bam(spark, p).select(*SAM_COLUMNS, "tags", "file_pos") for p, packed in kinds.items() if packed]
    texts = [p for p, packed in kinds.items() if not packed]
    if texts:
        parts.append(read_sam(spark, texts).select(*SAM_COLUMNS, "tags", "file_pos"))
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def header_of(path: str) -> str:
    """The header text of a file, or of a folder's first file."""
    first = found(path)[0][0]
    with opened(first) as f:
        if f.read(2) == b"\x1f\x8b":
            return read_header(first)[0]
    lines = []
    with opened(first) as f:
        rest = b""
        while block := f.read(1 << 16):
            *whole, rest = (rest + block).split(b"\n")
            lines += [x for x in whole if x.startswith(b"@")]
            if any(not x.startswith(b"@") for x in whole):
                break
    return "".join(x.decode() + "\n" for x in lines)


def coordinate_sort(rows: DataFrame, header: str) -> DataFrame:
    """Alignments by the header's order of sequences, then position, flag and name; unplaced ones last. Dealt by ranges, so that files in order are in coordinate order."""
    place = F.coalesce(F.try_element_at(F.map_from_entries(F.array(*[F.struct(F.lit(c), F.lit(i)) for i, (c, _) in enumerate(header_names(header))])), F.col("chrom")), F.lit(1 << 30)) if header_names(header) else F.lit(0)
    keyed = rows.withColumn("_place", place)
    keys = ("_place", "pos", "flag", "name")
    return keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")


def write_alignments(rows: DataFrame, path: str, header: str = "", kind: str = "bam", sort: bool = True) -> None:
    """Write ``bam`` or ``sam`` files, one a range of coordinates, every one with the header first. An existing result is refused."""
    spark = rows.sparkSession
    for source in (BamSource, SamSource):
        spark.dataSource.register(source)
    full = rows.withColumn("file_pos", F.lit(0).cast("long")).select(*[F.col(c).cast(k) for c, k in (x.split(" ", 1) for x in SCHEMA.split(", "))])
    (coordinate_sort(full, header) if sort else full).write.format(kind).option("header", header).mode("append").save(path)
