"""Media columns as progressive JPEG (operator 3).

The decoder accumulates spectral-selection and successive-approximation scans into
coefficient arrays, inverse-transforms them in numpy, upsamples chroma and returns the
full-resolution RGB tensor. The encoder stores a payload losslessly as coefficients.

Coefficients as storage: byte ``b`` becomes coefficient ``b`` from 128 on and ``b - 255``
below. All 256 of these values have magnitude category 8, and their amplitude bits are the
byte itself, so an encoded scan has one code length throughout. 64 bytes fill one block in
zigzag order; blocks fill Y, Cb and Cr of a 4:2:0 frame, padded to whole MCUs, and a
comment segment holds the payload's length.

Defined results: null and empty texts give one block of zero bytes; a media value that is
null or not a progressive JPEG gives nulls and a message in ``media_error``; equal texts give
equal media. Only the columns named are read, so extra columns pass through or are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, byte_views, row_chunks, table, tidy

# Fixed by the JPEG standard: the raster position of each coefficient in zigzag order.
ZIGZAG = np.array([u * 8 + v for s in range(15) for u, v in sorted(((i, s - i) for i in range(8) if 0 <= s - i < 8), key=lambda p: p[0] if s % 2 else p[1])])

_SCALE = 13


def _basis() -> np.ndarray:
    """Row k: the 64 samples of zigzag coefficient k, as integers scaled by 2**13.

    Integers keep every sum exact in float64, so results do not depend on summation order.
    """
    x = np.arange(8)
    c = np.where(x == 0, np.sqrt(0.5), 1.0)[:, None] * np.cos((2 * x[None] + 1) * x[:, None] * np.pi / 16) / 2
    full = np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)
    return np.rint(full[ZIGZAG] * (1 << _SCALE))


_BASIS = _basis()

# The encoder's Huffman tables: counts of codes by length, then symbols.
_DC_TABLE = (bytes([0, 0, 7, 1, 1] + [0] * 11), bytes([7, 8, 6, 5, 4, 3, 2, 1, 0]))
_AC_FIRST = (bytes([1] + [0] * 15), bytes([0x07]))
_AC_REFINE = (bytes([0, 0, 0, 15] + [0] * 12), bytes(n << 4 for n in range(15)))


def _codes(counts: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """(symbol, length, code) in canonical order."""
    out, code, at = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((symbols[at], length, code))
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _dc_words() -> dict[int, str]:
    """Code and amplitude bits of every difference of two coefficients halved."""
    code = {s: format(c, f"0{n}b") for s, n, c in _codes(*_DC_TABLE)}
    out = {}
    for d in range(-255, 256):
        n = abs(d).bit_length()
        out[d] = code[n] + (format(d if d > 0 else d + (1 << n) - 1, f"0{n}b") if n else "")
    return out


_DC_WORDS = _dc_words()


def _bits_to_bytes(bits: str) -> bytes:
    bits += "1" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big") if bits else b""


def _refinement(history: np.ndarray) -> bytes:
    """A refinement scan of blocks with no new coefficient: end-of-band runs, each with its blocks' correction bits."""
    parts = []
    for at in range(0, len(history), 32767):
        rows = history[at : at + 32767]
        n = len(rows).bit_length() - 1
        head = format(n, "04b") + (format(len(rows) - (1 << n), f"0{n}b") if n else "")
        parts += [np.frombuffer(head.encode(), np.uint8) - 48, rows.reshape(-1)]
    bits = np.concatenate(parts)
    pad = -len(bits) % 8
    return np.packbits(np.concatenate([bits, np.ones(pad, np.uint8)]) if pad else bits).tobytes()


@lru_cache(maxsize=4096)
def _mcu_order(wide: int, high: int) -> np.ndarray:
    """Luma raster positions in the order of an interleaved 4:2:0 scan."""
    grid = np.arange(4 * wide * high).reshape(high, 2, wide, 2)
    return grid.transpose(0, 2, 1, 3).reshape(-1)


_DHT = _segment(0xC4, b"\x00" + b"".join(_DC_TABLE) + b"\x10" + b"".join(_AC_FIRST) + b"\x11" + b"".join(_AC_REFINE))
_DQT = _segment(0xDB, b"\x00" + b"\x01" * 64)


def encode_payload(payload: bytes) -> bytes:
    """Store ``payload`` (a positive multiple of 64 bytes) as the coefficients of a progressive JPEG."""
    need = max(1, -(-(len(payload) // 64) // 6))
    wide = int(np.ceil(np.sqrt(need)))
    high = -(-need // wide)
    mcus = wide * high
    data = np.zeros(mcus * 384, np.uint8)
    data[: len(payload)] = np.frombuffer(payload, np.uint8)
    blocks = data.reshape(-1, 64)
    half = blocks >> 1
    correct = (blocks & 1) ^ (blocks < 128)
    parts = ((1, blocks[: 4 * mcus], slice(0, 4 * mcus)), (2, blocks[4 * mcus : 5 * mcus], slice(4 * mcus, 5 * mcus)), (3, blocks[5 * mcus :], slice(5 * mcus, 6 * mcus)))

    def scan(components: bytes, start: int, stop: int, high_bit: int, low_bit: int, body: bytes) -> bytes:
        head = bytes([len(components) // 2]) + components + bytes([start, stop, high_bit << 4 | low_bit])
        return _segment(0xDA, head) + body.replace(b"\xff", b"\xff\x00")

    dc = blocks[:, 0].astype(np.int16)
    dc -= np.int16(255) * (dc < 128)
    first = dc >> 1
    luma = first[_mcu_order(wide, high)]
    diff = np.concatenate([np.diff(x, prepend=np.int16(0)) for x in (luma, first[4 * mcus : 5 * mcus], first[5 * mcus :])])
    woven = np.concatenate([diff[: 4 * mcus].reshape(-1, 4), diff[4 * mcus : 5 * mcus, None], diff[5 * mcus :, None]], axis=1).reshape(-1)
    dc_bits = _bits_to_bytes("".join(map(_DC_WORDS.__getitem__, woven.tolist())))
    low = (dc & 1).astype(np.uint8)
    low = np.concatenate([low[: 4 * mcus][_mcu_order(wide, high)].reshape(-1, 4), low[4 * mcus : 5 * mcus, None], low[5 * mcus :, None]], axis=1).reshape(-1)
    out = [
        b"\xff\xd8",
        _segment(0xFE, b"payload_bytes=%d" % len(payload)),
        _DQT,
        _segment(0xC2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
        _DHT,
        scan(b"\x01\x00\x02\x00\x03\x00", 0, 0, 0, 1, dc_bits),
        scan(b"\x01\x00", 1, 5, 0, 1, half[parts[0][2], 1:6].tobytes()),
        scan(b"\x02\x00", 1, 63, 0, 1, half[parts[1][2], 1:].tobytes()),
        scan(b"\x03\x00", 1, 63, 0, 1, half[parts[2][2], 1:].tobytes()),
        scan(b"\x01\x00", 6, 63, 0, 1, half[parts[0][2], 6:].tobytes()),
    ]
    out += [scan(bytes([c, 0x01]), 1, 63, 1, 0, _refinement(correct[at, 1:])) for c, _, at in parts]
    pad = -len(low) % 8
    out.append(scan(b"\x01\x00\x02\x00\x03\x00", 0, 0, 1, 0, np.packbits(np.concatenate([low, np.ones(pad, np.uint8)])).tobytes()))
    return b"".join(out) + b"\xff\xd9"


class JpegError(ValueError):
    """The bytes are not a progressive JPEG that this decoder reads."""


@lru_cache(maxsize=64)
def _lookup(counts: bytes, symbols: bytes) -> list[int]:
    """By the next 16 bits: code length * 256 + symbol, 0 where no code fits."""
    out = np.zeros(1 << 16, np.int64)
    for symbol, length, code in _codes(counts, symbols):
        out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return out.tolist()


class _Bits:
    """Reads one entropy-coded segment (stuffing removed)."""

    def __init__(self, raw: bytes):
        self.data = raw.replace(b"\xff\x00", b"\xff")
        self.size = len(self.data)
        self.padded = self.data + b"\xff" * 8
        self.at = 0

    def symbol(self, lookup: list[int]) -> tuple[int, int]:
        """(symbol, code length)."""
        p = self.at
        x = lookup[int.from_bytes(self.padded[p >> 3 : (p >> 3) + 3], "big") >> (8 - (p & 7)) & 0xFFFF]
        if not x or (p >> 3) > self.size:
            raise JpegError("bad code")
        self.at = p + (x >> 8)
        return x & 255, x >> 8

    def take(self, n: int) -> int:
        p = self.at
        self.at = p + n
        return int.from_bytes(self.padded[p >> 3 : (p >> 3) + 4], "big") >> (32 - n - (p & 7)) & ((1 << n) - 1)

    def many(self, n: int) -> np.ndarray:
        """The next n bits as an array."""
        p, self.at = self.at, self.at + n
        got = np.unpackbits(np.frombuffer(self.padded, np.uint8, min(len(self.padded) - (p >> 3), (n + (p & 7) + 7) >> 3), p >> 3))[p & 7 : (p & 7) + n]
        if len(got) < n:
            raise JpegError("scan ends early")
        return got

    def uniform(self, code: int, length: int, size: int, most: int) -> np.ndarray:
        """Amplitudes of the following symbols for as long as each has this code (``length`` bits) and ``size`` bits."""
        step, p = length + size, self.at
        most = min(most, (self.size * 8 - p) // step)
        if step == 8 and not p & 7:
            got = np.frombuffer(self.data, np.uint8, most, p >> 3)
            same, value = (got >> size) == code, got & ((1 << size) - 1)
        else:
            bits = np.unpackbits(np.frombuffer(self.data, np.uint8, -(-(most * step + (p & 7)) // 8), p >> 3))[p & 7 : (p & 7) + most * step].reshape(most, step)
            weights = 1 << np.arange(step - 1, -1, -1)
            whole = bits @ weights
            same, value = (whole >> size) == code, whole & ((1 << size) - 1)
        n = int(np.argmin(same)) if not same.all() else most
        return value[:n].astype(np.int32)


def _signed(value, size: int):
    return np.where(value < (1 << (size - 1)), value - (1 << size) + 1, value) if isinstance(value, np.ndarray) else value if value >= 1 << (size - 1) else value - (1 << size) + 1


def _ac_first(bits: _Bits, coef: np.ndarray, order: np.ndarray, lookup: list[int], start: int, stop: int, low: int) -> None:
    at, run, wait, band = 0, 0, 0, stop - start + 1
    while at < len(order):
        if run:
            n = min(run, len(order) - at)
            at, run = at + n, run - n
            continue
        if wait:
            wait -= 1
        else:  # many equal codes in a row are read at once, by whole blocks
            p = bits.at
            symbol, length = bits.symbol(lookup)
            bits.at = p
            if 0 < symbol < 16:
                code = int.from_bytes(bits.padded[p >> 3 : (p >> 3) + 3], "big") >> (24 - length - (p & 7)) & ((1 << length) - 1)
                got = bits.uniform(code, length, symbol, band * (len(order) - at))
                n = len(got) // band
                if n:
                    coef[order[at : at + n], start : stop + 1] = (_signed(got[: n * band], symbol) << low).reshape(n, band)
                    bits.at += n * band * (length + symbol)
                    at += n
                    continue
            wait = 8
        k, row = start, coef[order[at]]
        while k <= stop:
            symbol, _ = bits.symbol(lookup)
            zeros, size = symbol >> 4, symbol & 15
            if size == 0:
                if zeros < 15:
                    run = (1 << zeros) - 1 + (bits.take(zeros) if zeros else 0)
                    break
                k += 16
                continue
            k += zeros
            if k > stop:
                raise JpegError("coefficient beyond its band")
            row[k] = _signed(bits.take(size), size) << low
            k += 1
        at += 1


def _ac_refine(bits: _Bits, coef: np.ndarray, order: np.ndarray, lookup: list[int], start: int, stop: int, low: int) -> None:
    def correct(block: np.ndarray) -> np.ndarray:
        known = block != 0
        n = int(np.count_nonzero(known))
        if n == block.size:
            return block + ((block >> 31) | 1) * (bits.many(n).reshape(block.shape).astype(block.dtype) << low)
        got = bits.many(n).astype(block.dtype) << low
        block[known] += np.sign(block[known]) * got
        return block

    at, run = 0, 0
    while at < len(order):
        if run:
            n = min(run, len(order) - at)
            coef[order[at : at + n], start : stop + 1] = correct(coef[order[at : at + n], start : stop + 1])
            at, run = at + n, run - n
            continue
        k, row = start, coef[order[at]]
        while k <= stop:
            symbol, _ = bits.symbol(lookup)
            zeros, size = symbol >> 4, symbol & 15
            new = 0
            if size:
                new = (1 if bits.take(1) else -1) << low if size == 1 else 0
                if not new:
                    raise JpegError("refined coefficient of more than one bit")
            elif zeros < 15:
                run = (1 << zeros) + (bits.take(zeros) if zeros else 0)
                break
            while k <= stop:
                if row[k]:
                    if bits.take(1):
                        row[k] += (1 << low) if row[k] > 0 else -(1 << low)
                elif zeros:
                    zeros -= 1
                else:
                    break
                k += 1
            if new and k <= stop:
                row[k] = new
            k += 1
        if run:
            row[k : stop + 1] = correct(row[k : stop + 1])
            run -= 1
        at += 1


_NEXT_MARKER, _RESTART = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]"), re.compile(rb"\xff[\xd0-\xd7]")


@lru_cache(maxsize=1024)
def _geometry(wide: int, high: int, sampling: tuple) -> tuple:
    """MCUs across and down, and for each component its size in blocks and the blocks' order in scans."""
    hm, vm = max(h for h, _ in sampling), max(v for _, v in sampling)
    across, down = -(-wide // (8 * hm)), -(-high // (8 * vm))
    places = []
    for h, v in sampling:
        w, t = across * h, down * v
        real_w, real_h = -(-(-(-wide * h // hm)) // 8), -(-(-(-high * v // vm)) // 8)
        own = (np.arange(real_h)[:, None] * w + np.arange(real_w)).reshape(-1)
        woven = np.arange(w * t).reshape(down, v, across, h).transpose(0, 2, 1, 3).reshape(across * down, v * h)
        places.append({"h": h, "v": v, "wide": w, "high": t, "own": own, "woven": woven, "plain": len(own) == w * t})
    return across, down, hm, vm, places


def read_coefficients(media: bytes) -> dict:
    """All scans of a progressive JPEG: frame, quantization tables and coefficients in zigzag order."""
    if media[:2] != b"\xff\xd8":
        raise JpegError("no start of image")
    quant, huff, frame, comment, interval, at = {}, {}, None, b"", 0, 2
    while at + 4 <= len(media):
        if media[at] != 0xFF:
            raise JpegError("marker expected")
        marker = media[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        size = int.from_bytes(media[at + 2 : at + 4], "big")
        body, at = media[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            while body:
                wide, n = body[0] >> 4, 128 if body[0] >> 4 else 64
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.float64)
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                huff[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xC2:
            high, wide, n = struct.unpack(">HHB", body[1:6])
            if body[0] != 8 or not high or not wide:
                raise JpegError("only 8-bit frames of stated size are read")
            across, down, hm, vm, places = _geometry(wide, high, tuple((body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15) for i in range(n)))
            parts = [{"id": body[6 + 3 * i], "q": body[8 + 3 * i], **places[i]} for i in range(n)]
            for c in parts:
                c["coef"] = np.zeros((c["wide"] * c["high"], 64), np.int32)
            frame = {"high": high, "wide": wide, "parts": parts, "mcus": across * down, "hm": hm, "vm": vm}
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise JpegError("not a progressive Huffman frame")
        elif marker == 0xDA:
            if frame is None:
                raise JpegError("scan before frame")
            end = _NEXT_MARKER.search(media, at)
            end = end.start() if end else len(media)
            n = body[0]
            chosen = [(next(c for c in frame["parts"] if c["id"] == body[1 + 2 * i]), body[2 + 2 * i]) for i in range(n)]
            start, stop, high_bit, low = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            raws = _RESTART.split(media[at:end]) if interval else [media[at:end]]
            at = end
            if start == 0:
                _dc_scan(raws, interval, frame, chosen, high_bit, low, huff)
            else:
                part, tables = chosen[0]
                step = interval or len(part["own"])
                lookup = _lookup(*huff[0x10 | tables & 15])
                for i, raw in enumerate(raws):
                    (_ac_refine if high_bit else _ac_first)(_Bits(raw), part["coef"], part["own"][i * step : (i + 1) * step], lookup, start, stop, low)
    if frame is None:
        raise JpegError("no frame")
    return {"frame": frame, "quant": quant, "comment": comment}


def _dc_scan(raws: list[bytes], interval: int, frame: dict, chosen: list, high_bit: int, low: int, huff: dict) -> None:
    orders = [c["woven"] if len(chosen) > 1 else c["own"][:, None] for c, _ in chosen]
    units = len(orders[0])
    step = interval or units
    for i, raw in enumerate(raws):
        bits, n = _Bits(raw), min(step, units - i * step)
        if n <= 0:
            break
        here = [o[i * step : i * step + n] for o in orders]
        widths = [o.shape[1] for o in here]
        if high_bit:
            got = bits.many(n * sum(widths)).reshape(n, -1).astype(np.int32) << low
            at = 0
            for (c, _), o, w in zip(chosen, here, widths):
                c["coef"][o, 0] |= got[:, at : at + w]
                at += w
            continue
        lookups = [lk for (_, t), w in zip(chosen, widths) for lk in [_lookup(*huff[t >> 4])] * w]
        out, padded, p, whole = [], bits.padded, bits.at, int.from_bytes
        for _ in range(n):
            for lk in lookups:
                word = whole(padded[p >> 3 : (p >> 3) + 5], "big") << (p & 7)
                x = lk[word >> 24 & 0xFFFF]
                size = x & 255
                p += (x >> 8) + size
                if size:
                    value = word >> (40 - (x >> 8) - size) & ((1 << size) - 1)
                    out.append(value if value >> (size - 1) else value - (1 << size) + 1)
                elif x:
                    out.append(0)
                else:
                    raise JpegError("bad code")
        if p > 8 * bits.size:
            raise JpegError("scan ends early")
        diffs, at = np.array(out, np.int32).reshape(n, -1), 0
        for (c, _), o, w in zip(chosen, here, widths):
            c["coef"][o.reshape(-1), 0] = np.cumsum(diffs[:, at : at + w].reshape(-1)) << low
            at += w


def render(image: dict) -> np.ndarray:
    """The full-resolution RGB tensor (height, width, 3) of what :func:`read_coefficients` returned."""
    frame, planes = image["frame"], []
    for c in frame["parts"]:
        spatial = (c["coef"] * image["quant"][c["q"]]) @ _BASIS
        plane = np.clip(np.floor((spatial + (1 << (_SCALE - 1))) / (1 << _SCALE)) + 128, 0, 255).astype(np.int32)
        plane = plane.reshape(c["high"], c["wide"], 8, 8).transpose(0, 2, 1, 3).reshape(c["high"] * 8, c["wide"] * 8)
        up, across = frame["vm"] // c["v"], frame["hm"] // c["h"]
        if up > 1:
            plane = np.repeat(plane, up, axis=0)
        if across > 1:
            plane = np.repeat(plane, across, axis=1)
        planes.append(plane[: frame["high"], : frame["wide"]])
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    # The YCbCr to RGB weights of JFIF, 1.402, 0.344136, 0.714136 and 1.772, times 65536.
    out = np.empty((*y.shape, 3), np.uint8)
    out[..., 0] = np.clip(y + ((91881 * cr + 32768) >> 16), 0, 255)
    out[..., 1] = np.clip(y - ((22554 * cb + 46802 * cr + 32768) >> 16), 0, 255)
    out[..., 2] = np.clip(y + ((116130 * cb + 32768) >> 16), 0, 255)
    return out


def stored_payload(image: dict) -> bytes | None:
    """The payload that :func:`encode_payload` stored; None for any other image."""
    m = re.match(rb"payload_bytes=(\d+)$", image["comment"])
    if not m:
        return None
    values = np.concatenate([c["coef"] for c in image["frame"]["parts"]]).reshape(-1)[: int(m[1])]
    return np.where(values > 0, values, values + 255).astype(np.uint8).tobytes()


def feature(rgb: np.ndarray) -> str:
    """Size, channel means and checksum of a tensor."""
    sums = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64)
    n = rgb.shape[0] * rgb.shape[1]
    return f"{rgb.shape[0]}x{rgb.shape[1]}:" + ",".join(f"{int(s) / n:.3f}" for s in sums) + f":{zlib.crc32(rgb.tobytes()):08x}"


def encode_texts(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_bytes and ``media``: each text's bytes, zero-padded to a positive multiple of 64, as progressive JPEG."""
    rows = bounded_batches(df).select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_payload"))
    schema = rows.drop("_payload").schema.add("n_bytes", "long").add("media", "binary")

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            buf, off = byte_views(column)
            for a, b in row_chunks(off, 4 << 20):
                sizes = np.diff(off[a : b + 1])
                media = [encode_payload((raw := buf[off[i] : off[i + 1]].tobytes()) + bytes(-len(raw) % 64 if raw else 64)) for i in range(a, b)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=[*keep, "n_bytes", "media"])

    return rows.mapInArrow(tidy(run), schema)


def decode_media(df: DataFrame, media: str = "media", keep: tuple[str, ...] = ("doc_id",), tensors: bool = True) -> DataFrame:
    """Decode progressive JPEGs: ``keep`` columns, height, width, ``rgb`` (bytes, row-major, 3 channels), feature, payload, media_error.

    ``tensors=False`` leaves rgb null: the tensor is rendered for the feature and not shipped.
    """
    rows = bounded_batches(df).select(*keep, F.col(media).alias("_media"))
    schema = rows.drop("_media").schema.add("height", "integer").add("width", "integer").add("rgb", "binary").add("feature", "string").add("payload", "binary").add("media_error", "string")
    names = schema.names

    def one(raw: bytes | None):
        if raw is None:
            return None, None, None, None, None, "no media"
        try:
            image = read_coefficients(raw)
            rgb = render(image)
        except (JpegError, KeyError, IndexError, StopIteration, ValueError, struct.error) as e:
            return None, None, None, None, None, str(e) or type(e).__name__
        return rgb.shape[0], rgb.shape[1], rgb.tobytes() if tensors else None, feature(rgb), stored_payload(image), None

    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.binary(), pa.string())

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            _, off = byte_views(column)
            for a, b in row_chunks(off, 4 << 20):
                got = list(zip(*(one(x.as_py()) for x in column.slice(a, b - a))))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)), *(pa.array(x, t) for x, t in zip(got, kinds))], names=names)

    return rows.mapInArrow(tidy(run), schema)


def digest(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the digests of each text's media, payload read back, and tensor."""
    media = encode_texts(df, text)
    media = media.withColumns({"media_bytes": F.length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    back = decode_media(media, keep=("doc_id", "n_bytes", "media_bytes", "media_sha256"))
    return back.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
        F.length("rgb").cast("long").alias("tensor_bytes"),
        F.sha2("rgb", 256).alias("tensor_sha256"),
    )


def op3_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text stored as a progressive JPEG and read back from the stored bytes, with its full-resolution RGB tensor."""
    return digest(table(spark, sf_dir, "documents").select("doc_id", "text"))
